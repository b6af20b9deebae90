"""Dense chunks (K5, K6, S13, S14) and levels by separable kernels on them.

A chunk is one block of one layer in one row: the block's values as packed little-endian arrays, row by row, NaN where
there is none, a bit mask of valid pixels, and the number and range of valid values. A pixel takes the bytes of its
values and one bit, where a row of a table of pixels takes its keys as well; what asks for masks or ranges only does not
read values. Tables of chunks lie in the order of a space-filling key of (by, bx).

A level is made without a row per pixel. Every method is a separable kernel: each chunk gives two one-dimensional passes,
along rows and along columns, over its values and over its mask, whose results on the level's cells are its partial
sums. Partial sums reach over the chunk's edges by as much as the kernel does, so what neighbours exchange are the
sums on these edges: one row per chunk and level block it weighs on, of about 20 / factor^2 bytes a pixel.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows of pixels that one Arrow batch of ``cells`` holds, about.
BATCH_CELLS = 1 << 20
PLACE = "by int, bx int, y0 int, x0 int, height int, width int"


@dataclass(frozen=True)
class Layout:
    """How chunks are cut: the grid's size, cells a side of a block, value columns (the first one is masked), their type."""

    height: int
    width: int
    block: int
    values: tuple[str, ...] = ("nmt", "res_src")
    kind: str = "f4"
    keys: tuple[str, ...] = ("rok",)

    @property
    def spark_kind(self) -> str:
        return {"f4": "float", "f8": "double"}[self.kind]

    @property
    def about(self) -> str:
        return f"n long, low {self.spark_kind}, high {self.spark_kind}, mask binary, {', '.join(f'{v} binary' for v in self.values)}"

    @property
    def columns(self) -> list[str]:
        return [*self.keys, "by", "bx", "y0", "x0", "height", "width", "n", "low", "high", "mask", *self.values]

    def schema(self, like: DataFrame) -> StructType:
        """Of chunks whose keys have the types they have in ``like``."""
        rest = StructType.fromDDL(f"{PLACE}, {self.about}")
        return StructType([*(StructField(k, like.schema[k].dataType) for k in self.keys), *rest.fields])

    def sides(self, by: int, bx: int) -> tuple[int, int, int, int]:
        """(y0, x0, height, width) of a block, clipped at the grid's edges."""
        y0, x0 = by * self.block, bx * self.block
        return y0, x0, min(self.block, self.height - y0), min(self.block, self.width - x0)

    def row(self, by: int, bx: int, arrays: list[np.ndarray]) -> tuple:
        """One chunk, but for its keys, from dense arrays; NaN where there is no value."""
        valid = ~np.isnan(arrays[0])
        n = int(np.count_nonzero(valid))
        low, high = (float(f(arrays[0][valid])) if n else None for f in (np.min, np.max))
        return (by, bx, *self.sides(by, bx), n, low, high, np.packbits(valid).tobytes(), *(a.astype(f"<{self.kind}").tobytes() for a in arrays))

    def batch(self, keys: list[pa.Array], rows: list[tuple]) -> pa.RecordBatch:
        real = pa.float32() if self.kind == "f4" else pa.float64()
        types = [*[pa.int32()] * 6, pa.int64(), real, real, *[pa.binary()] * (1 + len(self.values))]
        return pa.RecordBatch.from_arrays([*keys, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=self.columns)

    def array(self, raw: bytes, height: int, width: int) -> np.ndarray:
        return np.frombuffer(raw, f"<{self.kind}").reshape(height, width)


def along_curve(by: Column, bx: Column) -> Column:
    """The Morton number of a block: bits of both numbers in turn, so that near blocks are near in a file."""

    def spread(v: Column) -> Column:
        v = v.cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(by), 1).bitwiseOR(spread(bx))


#: Blocks a side that are packed in one task, so that near blocks come into one file; bytes of chunks that go out together.
NEAR, OUT_BYTES = 2, 1 << 23


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """One table per run of rows that agree in ``by``, wherever batches end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for c in by:
            v = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] |= v[1:] != v[:-1]
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in by):
            new[0] = True
        edge = np.flatnonzero(new).tolist()
        for start, stop in zip([0, *edge], [*edge, batch.num_rows], strict=True):
            if start in edge and held:
                yield pa.Table.from_batches(held)
                held = []
            if stop > start:
                held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def made(parts: Iterator[pa.Table], layout: Layout, one: Callable[[pa.Table], tuple]) -> Iterator[pa.RecordBatch]:
    """``one`` chunk of each part, some at a time."""
    keys, rows, size = [], [], 0
    for part in parts:
        keys.append([part.column(k)[0] for k in layout.keys])
        rows.append(one(part))
        size += sum(len(x) for x in rows[-1][9:])
        if size >= OUT_BYTES:
            yield layout.batch([pa.array([k.as_py() for k in column], column[0].type) for column in zip(*keys, strict=True)], rows)
            keys, rows, size = [], [], 0
    if rows:
        yield layout.batch([pa.array([k.as_py() for k in column], column[0].type) for column in zip(*keys, strict=True)], rows)


def packed(cells: DataFrame, layout: Layout) -> DataFrame:
    """Chunks of (keys, row, col, values), of blocks that have pixels. A block's pixels meet in one task, which the block's
    size bounds. Pixels outside the grid are dropped, NaN counts as missing, of pixels given twice one holds."""
    at = {"by": F.floor(F.col("row") / layout.block).cast("int"), "bx": F.floor(F.col("col") / layout.block).cast("int")}
    inside = cells.where((F.col("row") >= 0) & (F.col("col") >= 0) & (F.col("row") < layout.height) & (F.col("col") < layout.width))
    rows = inside.select(*layout.keys, *(c.alias(n) for n, c in at.items()), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *(F.col(v).cast(layout.spark_kind).alias(v) for v in layout.values))
    near = rows.repartition(*layout.keys, F.floor(F.col("by") / NEAR), F.floor(F.col("bx") / NEAR)).sortWithinPartitions(*layout.keys, along_curve(F.col("by"), F.col("bx")))

    def dense(part: pa.Table) -> tuple:
        by, bx = part.column("by")[0].as_py(), part.column("bx")[0].as_py()
        y0, x0, height, width = layout.sides(by, bx)
        at = (part.column("row").to_numpy() - y0) * width + part.column("col").to_numpy() - x0
        arrays = []
        for v in layout.values:
            whole = np.full(height * width, np.nan, layout.kind)
            whole[at] = part.column(v).to_numpy()
            arrays.append(whole.reshape(height, width))
        return layout.row(by, bx, arrays)

    return near.mapInArrow(lambda batches: made(runs(batches, [*layout.keys, "by", "bx"]), layout, dense), layout.schema(cells))


def cells(chunks: DataFrame, layout: Layout, values: tuple[str, ...] | None = None) -> DataFrame:
    """(keys, by, bx, row, col, values) of the valid pixels; only the values asked for are read."""
    asked = layout.values if values is None else values
    schema = StructType([*(chunks.schema[k] for k in (*layout.keys, "by", "bx")), *StructType.fromDDL(f"row int, col int, {', '.join(f'{v} {layout.spark_kind}' for v in asked)}").fields])
    real = pa.float32() if layout.kind == "f4" else pa.float64()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, size, start = [], 0, 0

            def out(stop: int) -> pa.RecordBatch:
                times = [len(d[0]) for d in done]
                index = pa.array(np.repeat(np.arange(start, stop), times))
                keys = [batch.column(k).take(index) for k in (*layout.keys, "by", "bx")]
                joined = [np.concatenate(c) for c in zip(*done, strict=True)]
                held = [pa.array(joined[0], pa.int32()), pa.array(joined[1], pa.int32()), *(pa.array(v, real, from_pandas=True) for v in joined[2:])]
                return pa.RecordBatch.from_arrays([*keys, *held], names=schema.names)

            places = [batch.column(c).to_pylist() for c in ("y0", "x0", "height", "width")]
            for i, (y0, x0, height, width) in enumerate(zip(*places, strict=True)):
                bits = np.unpackbits(np.frombuffer(batch.column("mask")[i].as_py(), np.uint8), count=height * width)
                at = np.flatnonzero(bits)
                done.append((at // width + y0, at % width + x0, *(np.frombuffer(batch.column(v)[i].as_py(), f"<{layout.kind}")[at] for v in asked)))
                size += len(at)
                if size >= BATCH_CELLS:
                    yield out(i + 1)
                    done, size, start = [], 0, i + 1
            if done:
                yield out(batch.num_rows)

    return chunks.select(*layout.keys, "by", "bx", "y0", "x0", "height", "width", "mask", *asked).mapInArrow(spread, schema)


def kernel(d: np.ndarray, method: str) -> np.ndarray:
    """Weight at a distance in level cells; cubic is Keys' convolution with a = -0.5."""
    d = np.abs(d)
    if method == "bilinear":
        return np.maximum(0.0, 1.0 - d)
    near = 1.5 * d * d * d - 2.5 * d * d + 1
    far = -0.5 * d * d * d + 2.5 * d * d - 4.0 * d + 2
    return np.where(d <= 1, near, np.where(d < 2, far, 0.0))


@functools.lru_cache(maxsize=256)
def pass_matrix(first: int, count: int, factor: int, method: str, limit: int) -> tuple[int, np.ndarray]:
    """(first level cell, weights by level cell and base cell) of one axis: base cells ``first`` ... of one chunk, and the
    level cells from 0 to ``limit`` - 1 that they weigh on. nearest takes child factor // 2 only, average all alike."""
    base = np.arange(first, first + count)
    if method in ("nearest", "average"):
        pairs = [(base // factor, np.where((base % factor == factor // 2) | (method == "average"), 1.0, 0.0))]
    else:
        place = (base + 0.5) / factor - 0.5
        reach = 1 if method == "bilinear" else 2
        pairs = [(t := np.floor(place).astype(int) + k, kernel(place - t, method)) for k in range(1 - reach, reach + 1)]
    low = max(0, min(int(t.min()) for t, _ in pairs))
    high = min(limit - 1, max(int(t.max()) for t, _ in pairs))
    out = np.zeros((max(0, high - low + 1), count))
    for t, w in pairs:
        good = (t >= low) & (t <= high)
        out[t[good] - low, np.flatnonzero(good)] += w[good]
    return low, out


def parent_maximum(values: np.ndarray, y0: int, x0: int, factor: int) -> tuple[int, int, np.ndarray]:
    """(first row, first column, greatest value of each level cell's own pixels), -inf where there is none."""
    filled = np.where(np.isnan(values), -np.inf, values)
    for axis, start in ((0, y0), (1, x0)):
        parent = (start + np.arange(filled.shape[axis])) // factor
        edge = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        filled = np.maximum.reduceat(filled, edge, axis=axis)
    return y0 // factor, x0 // factor, filled


def round_single(x: np.ndarray, places: int) -> np.ndarray:
    """Half to even in single precision, as ``numeric.round_float``."""
    return (np.rint((x.astype(np.float32) * np.float32(10**places)).astype(float)) / float(10**places)).astype(np.float32)


_PARTIAL = "by int, bx int, from_y int, from_x int, y int, x int, h int, w int, total binary, weight binary, top binary"


def level(chunks: DataFrame, base: Layout, factor: int, method: str, to: Layout, round_places: int | None = 2) -> DataFrame:
    """Chunks of layout ``to`` with cells of ``factor`` x ``factor`` pixels of the chunks of ``base``, one key list for both.

    The first value is resampled, weights renormalised over valid pixels; the others are the greatest of a cell's own
    pixels (A6). Partial sums are added in the order of their blocks, so that runs agree.
    """
    names = StructType([*(chunks.schema[k] for k in base.keys), *StructType.fromDDL(_PARTIAL).fields])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            places = [batch.column(c).to_pylist() for c in ("y0", "x0", "height", "width", "by", "bx")]
            for i, (y0, x0, h, w, from_y, from_x) in enumerate(zip(*places, strict=True)):
                first = base.array(batch.column(base.values[0])[i].as_py(), h, w).astype(float)
                (ty, rows), (tx, columns) = pass_matrix(y0, h, factor, method, to.height), pass_matrix(x0, w, factor, method, to.width)
                valid = ~np.isnan(first)
                total, weight = (rows @ np.where(valid, a, 0.0) @ columns.T for a in (first, valid.astype(float)))
                tops = []
                for v in base.values[1:]:
                    top = np.full(total.shape, -np.inf)
                    py, px, best = parent_maximum(base.array(batch.column(v)[i].as_py(), h, w).astype(float), y0, x0, factor)
                    best = best[: max(0, ty + len(rows) - py), : max(0, tx + len(columns) - px)]
                    top[py - ty : py - ty + best.shape[0], px - tx : px - tx + best.shape[1]] = best
                    tops.append(top)
                for by in range(ty // to.block, (ty + len(rows) - 1) // to.block + 1) if total.size else ():
                    for bx in range(tx // to.block, (tx + len(columns) - 1) // to.block + 1):
                        ys = slice(max(0, by * to.block - ty), min(len(rows), (by + 1) * to.block - ty))
                        xs = slice(max(0, bx * to.block - tx), min(len(columns), (bx + 1) * to.block - tx))
                        if weight[ys, xs].any() or any(np.isfinite(t[ys, xs]).any() for t in tops):
                            own = total[ys, xs]
                            found.append((i, by, bx, from_y, from_x, ty + ys.start, tx + xs.start, *own.shape, own.tobytes(), weight[ys, xs].tobytes(), b"".join(t[ys, xs].tobytes() for t in tops)))
            if found:
                columns_ = list(zip(*found, strict=True))
                keys = [batch.column(k).take(pa.array(columns_[0])) for k in base.keys]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(c, pa.int32()) for c in columns_[1:9]), *(pa.array(c, pa.binary()) for c in columns_[9:])], names=names.names)

    def summed(part: pa.Table) -> tuple:
        by, bx = part.column("by")[0].as_py(), part.column("bx")[0].as_py()
        y0, x0, height, width = to.sides(by, bx)
        total, weight = np.zeros((height, width)), np.zeros((height, width))
        tops = [np.full((height, width), -np.inf) for _ in base.values[1:]]
        for r in sorted(part.select(names.names[len(base.keys) + 2 :]).to_pylist(), key=lambda r: (r["from_y"], r["from_x"])):
            at = np.s_[r["y"] - y0 : r["y"] - y0 + r["h"], r["x"] - x0 : r["x"] - x0 + r["w"]]
            shape = (r["h"], r["w"])
            total[at] += np.frombuffer(r["total"]).reshape(shape)
            weight[at] += np.frombuffer(r["weight"]).reshape(shape)
            for top, held in zip(tops, np.frombuffer(r["top"]).reshape(len(tops), *shape), strict=True):
                np.maximum(top[at], held, out=top[at])
        some = np.abs(weight) > 1e-12
        first = np.full((height, width), np.nan)
        first[some] = total[some] / weight[some]
        if round_places is not None:
            first = round_single(first, round_places)
        rest = [np.where(some & np.isfinite(t), t, np.nan) for t in tops]
        return to.row(by, bx, [first, *rest])

    sums = chunks.where("n > 0").select(*base.keys, "by", "bx", "y0", "x0", "height", "width", *base.values).mapInArrow(partial, names)
    met = sums.repartition(*base.keys, "by", "bx").sortWithinPartitions(*base.keys, along_curve(F.col("by"), F.col("bx")))
    return met.mapInArrow(lambda batches: made(runs(batches, [*to.keys, "by", "bx"]), to, summed), to.schema(chunks)).where("n > 0")


def coverage(chunks: DataFrame, layer: str = "rok") -> DataFrame:
    """A10, A11 on masks alone: valid pixels of each layer over pixels valid in any of them. Masks of one block meet, values
    are not read and nothing is shuffled by pixel."""

    def united(part: pa.Table) -> pa.Table:
        masks = [np.frombuffer(m, np.uint8) for m in part.column("mask").to_pylist()]
        any_ = int(np.bitwise_count(np.bitwise_or.reduce(masks)).sum())
        n = [int(np.bitwise_count(m).sum()) for m in masks]
        return pa.table({"layer": part.column("layer"), "n": pa.array(n, pa.int64()), "any_": pa.array([any_] + [0] * (len(n) - 1), pa.int64())})

    told = chunks.select(F.col(layer).cast("long").alias("layer"), "by", "bx", "mask")
    each = told.groupBy("by", "bx").applyInArrow(united, "layer long, n long, any_ long")
    sums = each.groupBy("layer").agg(F.sum("n").alias("n"), F.sum("any_").alias("any_"))
    total = sums.agg(F.sum("any_").alias("total"))  # one row
    return sums.join(F.broadcast(total)).select(F.col("layer").cast(chunks.schema[layer].dataType).alias(layer), F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(0.0).alias("coverage"))


def layer_stats(chunks: DataFrame, layout: Layout, layer: str = "rok") -> DataFrame:
    """A8 on chunks: least, mean, greatest and number of values. Ranges and numbers are stored; means need each chunk's sum,
    and nothing but these is shuffled."""

    def sums(values: pa.Array) -> pa.Array:
        return pa.array([float(np.nansum(np.frombuffer(v.as_py(), f"<{layout.kind}").astype(float))) for v in values], pa.float64())

    total = F.sum(F.arrow_udf(sums, "double")(F.col(layout.values[0])))
    return chunks.groupBy(layer).agg(F.min("low").alias("z_min"), (total / F.sum("n")).alias("z_mean"), F.max("high").alias("z_max"), F.sum("n").alias("n"))


def change_shares(chunks: DataFrame, layout: Layout, layer: str = "indeks", thresholds: tuple[float, ...] = (0.005, 0.5, 2.0)) -> DataFrame:
    """A9, W2, J16 on chunks: per layer, the share of pixels in common with the layer stored just before that changed by more
    than each threshold. Chunks of one block and neighbouring layers meet by equi-join, two at a time."""
    value = layout.values[0]
    now = chunks.select(F.col(layer).cast("long").alias("layer"), "by", "bx", F.col(value).alias("now"))
    before = now.select((F.col("layer") + 1).alias("layer"), "by", "bx", F.col("now").alias("before"))
    names = ["layer", "n", *(f"c{k}" for k in range(len(thresholds)))]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                d = np.abs(np.subtract(*(np.frombuffer(batch.column(c)[i].as_py(), f"<{layout.kind}").astype(float) for c in ("now", "before"))))
                d = d[~np.isnan(d)]
                out.append((batch.column("layer")[i].as_py(), len(d), *(int((d > t).sum()) for t in thresholds)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    counts = now.join(before, ["layer", "by", "bx"]).select("layer", "now", "before").mapInArrow(compared, ", ".join(f"{n} long" for n in names))
    sums = counts.groupBy("layer").agg(*(F.sum(n).alias(n) for n in names[1:])).where("n > 0")
    return sums.select(F.col("layer").cast(chunks.schema[layer].dataType).alias(layer), F.col("n").alias("n_common"), *((F.col(f"c{k}").cast("double") / F.col("n")).alias(f"share_{k}") for k in range(len(thresholds))))
