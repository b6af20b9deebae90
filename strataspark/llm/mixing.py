"""Operator 3, mixing sources to target weights by pivotal dependent rounding.

Every source takes target/size copies of each of its documents: the whole copies at once, the fraction by rounding.
Two fractional copies of one source are paired and mass moves between them, in words, so that their summed words and
each one's expected copies stay as they were, until one of them is integral; the other goes on. A task leaves at most
one fractional document per source and bucket; these residuals are combined through a reduction tree of groups of
``FAN_IN`` until one per source is left, which is rounded to the nearer side. A source is thus off its target by at
most half of one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm.common import WORD, checkpointed, table

#: Documents of one first-level bucket, about; residuals that one task of the tree combines, at most; equal rows that
#: are numbered by one task.
BUCKET_ROWS, FAN_IN, RUN_ROWS = 2_000, 256, 1_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_filled(sizes: list[int], weights: list[float], cap: float = 3.0) -> list[float]:
    """Targets that share the sum of sizes by weight, none above ``cap`` times its size, the excess reshared by weight."""
    target = [0.0] * len(sizes)
    open_, left = [i for i, n in enumerate(sizes) if n > 0], float(sum(sizes))
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if share * weights[i] > cap * sizes[i]]
        if not full:
            for i in open_:
                target[i] = share * weights[i]
            break
        for i in full:
            target[i] = cap * sizes[i]
            left -= target[i]
        open_ = [i for i in open_ if i not in set(full)]
    return target


def source_targets(sized: DataFrame, source: str, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target): one row per source, null included, in code-point order with repeating weights.

    The recipe of a mix has one weight per source, so one row per source is brought to the driver.
    """
    spark = sized.sparkSession
    totals = sized.groupBy(source).agg(F.sum("size").cast("long").alias("size")).collect()
    rows = sorted(totals, key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8")))
    targets = water_filled([r[1] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], cap)
    out = [(r[0], int(r[1]), t, i) for i, (r, t) in enumerate(zip(rows, targets, strict=True))]
    return spark.createDataFrame(out, "mix_source string, source_size long, target double, source_no int")


_COLUMNS = ["key", "turn", "source_no", "grp", "draw", "p", "done", "size"]
_SCHEMA = "key long, turn long, source_no int, grp long, draw long, p double, done boolean, size long"


def _transfer(pa: float, sa: int, pb: float, sb: int, u: float) -> tuple[float, float, bool]:
    """New probabilities of a and b, one of them integral, and whether it is a's. Words pa*sa + pb*sb are kept."""
    to_a, to_b = min((1 - pa) * sa, pb * sb), min(pa * sa, (1 - pb) * sb)
    if u * (to_a + to_b) < to_b:  # expected copies stay: P(to a) = to_b / (to_a + to_b)
        return (1.0, pb - to_a / sb, True) if (1 - pa) * sa <= pb * sb else (pa + to_a / sa, 0.0, False)
    return (0.0, pb + to_b / sb, True) if pa * sa <= (1 - pb) * sb else (pa - to_b / sa, 1.0, False)


def _pivot(parts: Iterator[pd.DataFrame], last: bool) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (source_no, grp, draw). One row of each (source_no, grp) goes on; ``last`` rounds that too."""
    P, DONE = _COLUMNS.index("p"), _COLUMNS.index("done")
    held: list | None = None

    def left() -> list:
        if held is not None and last:
            held[P], held[DONE] = float(held[P] >= 0.5), True
        return [] if held is None else [held]

    for part in parts:
        out: list = []
        for row in map(list, part.itertuples(index=False, name=None)):
            if row[DONE]:
                out.append(row)
                continue
            if held is None or held[2:4] != row[2:4]:
                out += left()
                held = row
                continue
            u = (((held[4] * 0x9E3779B97F4A7C15) ^ row[4]) >> 8 & 0xFFFFFFFFFFFFF) / float(1 << 52)
            pa, pb, first = _transfer(held[P], held[7], row[P], row[7], u)
            held[P], row[P] = pa, pb
            settled, other = (held, row) if first else (row, held)
            settled[DONE] = True
            out.append(settled)
            held = other
            if min(other[P], 1 - other[P]) < 1e-12:
                other[P], other[DONE] = float(round(other[P])), True
                out.append(other)
                held = None
        yield pd.DataFrame(out, columns=_COLUMNS)
    yield pd.DataFrame(left(), columns=_COLUMNS)


def rounded_copies(rows: DataFrame, seed: int = 17, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """``rows``(key long, turn long, source_no int, size long, p double in [0, 1)) with p rounded to 0 or 1.

    (key, turn) names a row. Draws depend on it, on size and seed, and a source's buckets on its row count, so reruns
    agree whatever the partitioning and no bucket of a large source is larger than others. One row per source comes to
    the driver, as for the recipe.
    """
    counts = rows.groupBy("source_no").agg(F.ceil(F.count("*") / bucket_rows).cast("long").alias("buckets"))
    found = [tuple(r) for r in counts.orderBy("source_no").collect()]
    buckets = max((n for _, n in found), default=1)
    of_source = F.broadcast(rows.sparkSession.createDataFrame(found, "source_no int, buckets long"))
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    level = rows.join(of_source, "source_no").select(
        "key", "turn", "source_no", F.pmod(F.xxhash64("key", "turn", F.lit(seed + 1)), F.col("buckets")).cast("long").alias("grp"),
        F.xxhash64("key", "turn", "size", F.lit(seed)).alias("draw"), F.when(fractional, F.col("p")).otherwise(F.lit(0.0)).alias("p"), (~fractional).alias("done"), "size",
    )
    settled = []
    while True:
        last = buckets == 1
        dealt = level.repartition("source_no", "grp").sortWithinPartitions("source_no", "grp", "draw", "key", "turn")
        level = checkpointed(dealt.mapInPandas(lambda parts, last=last: _pivot(parts, last), _SCHEMA))
        settled.append(level.where("done"))
        if last:
            break
        buckets = -(-buckets // fan_in)
        level = level.where("not done").withColumn("grp", F.floor(F.col("grp") / F.lit(fan_in)).cast("long"))
    return reduce(DataFrame.union, settled).select("key", "turn", "source_no", "size", "p")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0, seed: int = 17, tag: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: (doc_id, mix_source, size, source_size, target, copies, taken, tag).

    Null or blank texts have size 0 and are never taken; a null source is a source of its own, the last. ``tag`` (the
    text's hash by default) tells rows of one doc_id, or of none, apart; rows that agree in doc_id, source and tag are
    interchangeable: they are counted, and the count is spread again before buckets are dealt, so neither null ids nor
    repeated rows fill one bucket. Texts of any length are counted whole; other columns are ignored, whatever their
    names. An empty table gives no rows.
    """
    known = docs.select(F.col(doc_id).cast("long").alias("uid"), F.col(source).alias("mix_source"), word_count(F.col(text)).alias("size"), (F.xxhash64(text) if tag is None else tag).alias("tag"))
    sized = checkpointed(known.groupBy("uid", "mix_source", "size", "tag").agg(F.count("*").alias("rows")))
    targets = source_targets(sized.select("mix_source", (F.col("size") * F.col("rows")).alias("size")), "mix_source", weights, cap)
    recipe = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    rated = sized.join(recipe.withColumnRenamed("mix_source", "of_source"), F.col("mix_source").eqNullSafe(F.col("of_source")))
    key = F.xxhash64(F.coalesce("uid", F.lit(0)), F.col("uid").isNull(), "source_no", "tag", "size").alias("key")
    named = checkpointed(rated.select(key, "uid", "tag", "source_no", "size", "rows", (F.col("rate") - F.floor("rate")).alias("p")))
    runs = named.select("key", "source_no", "size", "p", "rows", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / RUN_ROWS))).alias("run"))
    turn = F.explode(F.sequence(F.col("run") * RUN_ROWS, F.least(F.col("rows"), (F.col("run") + 1) * RUN_ROWS) - 1))
    start = runs.repartition("key", "run").select("key", "source_no", "size", "p", turn.alias("turn"))
    copies = F.when(F.col("size") > 0, F.floor("rate").cast("long") + F.col("p").cast("long")).otherwise(F.lit(0))
    return (
        rounded_copies(start, seed).select("key", "p")
        .join(named.drop("p"), "key")
        .join(recipe, "source_no")
        .withColumn("copies", copies)
        .select(F.col("uid").alias("doc_id"), "mix_source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "tag")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
