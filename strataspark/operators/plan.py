"""Update plan: index against manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataspark.functions.grid import SIDES, overlaps

KEY = ["plik", "akt_data"]


def _keyed(sheets: DataFrame) -> DataFrame:
    return sheets.withColumn("akt_data", F.coalesce(F.col("akt_data").cast("string"), F.lit("")))


def last_of_each(sheets: DataFrame, key: tuple[str, ...] = ("plik", "akt_data"), seq: str | None = None) -> DataFrame:
    """One row for each key, the last one by ``seq``; without it by the column ``lp`` that an index has, or else the
    greatest row, so that reruns agree."""
    seq = seq or ("lp" if "lp" in sheets.columns else None)
    rest = [c for c in sheets.columns if c not in key]
    by = F.struct(*([seq] if seq else rest or key))
    best = F.max_by(F.struct(*sheets.columns), by).alias("last_")
    keyed = sheets.groupBy(*(F.col(k).alias(f"key_{i}_") for i, k in enumerate(key))).agg(best)
    return keyed.select("last_.*")


def added(index: DataFrame, manifest: DataFrame, unsupported: DataFrame | None = None) -> DataFrame:
    """In the index, neither in the manifest nor known as unsupported."""
    rest = _keyed(index).join(_keyed(manifest), KEY, "left_anti")
    return rest if unsupported is None else rest.join(_keyed(unsupported), KEY, "left_anti")


def removed(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """U2."""
    return _keyed(manifest).join(_keyed(index), KEY, "left_anti")


def reissued(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """Files both added and removed."""
    return plus.select("plik").intersect(minus.select("plik"))


def dirty(plus: DataFrame, minus: DataFrame, columns: tuple[str, ...] = ("left", "bottom", "right", "top")) -> DataFrame:
    """U4: rectangles of added and of removed sheets."""
    return plus.select(*columns).unionAll(minus.select(*columns))


def diff(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """(plik, akt_data, change_type) by one full join; unchanged sheets are left out."""
    new, old = _keyed(index).select(*KEY).distinct().withColumn("new_", F.lit(1)), _keyed(manifest).select(*KEY).distinct().withColumn("old_", F.lit(1))
    kind = F.when(F.col("old_").isNull(), "added").when(F.col("new_").isNull(), "removed")
    return new.join(old, KEY, "full").select(*KEY, kind.alias("change_type")).where("change_type is not null")


def label(known: Column, complete: Column, changed: Column) -> Column:
    """Nowa, przebudowa, aktualna or zmiana."""
    return F.when(~known, "nowa").when(~complete, "przebudowa").when(changed, "zmiana").otherwise("aktualna")


def actions(index: DataFrame, manifest: DataFrame, records: DataFrame, unsupported: DataFrame | None = None, force: bool = False) -> DataFrame:
    """L1 for all years at once: (rok, akcja, dodane, usuniete) of the years in ``index``.

    ``index``, ``manifest``, ``unsupported``: rok, plik, akt_data; ``records``: rok, status.
    """
    key = ["rok", *KEY]
    new, old = _keyed(index).select(*key).distinct(), _keyed(manifest).select(*key).distinct()
    plus = new.join(old, key, "left_anti")
    plus = plus if unsupported is None else plus.join(_keyed(unsupported).select(*key), key, "left_anti")
    minus = old.join(new, key, "left_anti")
    counts = plus.select("rok", F.lit(1).alias("p"), F.lit(0).alias("m")).unionAll(minus.select("rok", F.lit(0), F.lit(1))).groupBy("rok").agg(F.sum("p").alias("p"), F.sum("m").alias("m"))
    told = new.select("rok").distinct().join(records.select("rok", "status"), "rok", "left").join(counts, "rok", "left")
    p, m = F.coalesce("p", F.lit(0)), F.coalesce("m", F.lit(0))
    known = F.col("status").isNotNull()
    done = (F.col("status") == "kompletna") & F.lit(not force)
    return told.select("rok", label(known, done, p + m > 0).alias("akcja"), p.alias("dodane"), F.when(known, m).otherwise(0).cast("long").alias("usuniete"))


def action(index: DataFrame, manifest: DataFrame | None, status: str | None, unsupported: DataFrame | None = None, force: bool = False) -> dict:
    """L1 for one year's sheets: the action, with the sorted keys and rectangles of the change."""
    old = manifest if manifest is not None else index.limit(0)
    plus, minus = added(index, old, unsupported), removed(index, old)
    p, m = ([tuple(r) for r in df.select(*KEY).distinct().orderBy(*KEY).collect()] for df in (plus, minus))  # one year's sheets
    told = index.sparkSession.range(1).select(label(F.lit(manifest is not None), F.lit(status == "kompletna" and not force), F.lit(bool(p or m)))).head()[0]
    again = sorted(r[0] for r in reissued(plus, minus).collect())
    return {"akcja": told, "dodane": p, "usuniete": [] if told == "nowa" else m, "zmienione": again, "brudne": dirty(plus, minus) if told == "zmiana" else None}


def used(tiles: DataFrame, sheets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tiles whose source file is in the current list, and the foreign ones."""
    return tiles.join(sheets.select("plik").distinct(), "plik", "left_semi"), tiles.join(sheets.select("plik").distinct(), "plik", "left_anti")


def unused(sheets: DataFrame, tiles: DataFrame, archives_without_ascii: DataFrame) -> DataFrame:
    """Sheets without a tile: ``nieobslugiwane`` if their archive holds no sheet text, else ``pominiete``."""
    none = archives_without_ascii.select(F.col("archive").alias("plik")).distinct().withColumn("none_", F.lit(True))
    rest = sheets.join(tiles.select("plik").distinct(), "plik", "left_anti").join(none, "plik", "left")
    return rest.withColumn("powod", F.when(F.col("none_"), "nieobslugiwane").otherwise("pominiete")).drop("none_")


def stale(converted: DataFrame, expected: DataFrame) -> DataFrame:
    """P20: conversions whose stored date differs from the expected one. (One that cannot be read has no row: ``convert``.)"""
    want = expected.select("plik", F.col("akt_data").alias("expected_"))
    return converted.join(want, "plik").where("akt_data is not null and expected_ is not null and akt_data <> expected_").drop("expected_")


def not_yet(inputs: DataFrame, converted: DataFrame) -> DataFrame:
    """Inputs without a finished conversion."""
    return inputs.join(converted.select("plik").distinct(), "plik", "left_anti")


#: Sides of boxes that count as one size at least; a point has it.
LEAST_SIDE = 2.0**-20


def meeting(boxes: DataFrame, others: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of ``boxes`` with those of ``others`` (columns ``d_...``) that they overlap, or touch unless ``strict``.

    An equi-join on lattices by powers of two. A box's own lattice is the first whose cells are as large as it is. A pair
    meets on the greater of its two own lattices, in the cell of its common corner: boxes are listed in the cells they meet,
    at most four, on their own lattice and on those of greater boxes of the other side. Two boxes that are both smaller than
    the cells never meet there, so a few large boxes do not bring small ones together.
    """
    level = lambda p: F.ceil(F.log2(F.greatest(F.col(f"{p}right") - F.col(f"{p}left"), F.col(f"{p}top") - F.col(f"{p}bottom"), F.lit(LEAST_SIDE)))).cast("int")
    renamed = others.select(*(F.col(c).alias(f"d_{c}") for c in others.columns))
    sides = {"": boxes.withColumn("level_", level("")), "d_": renamed.withColumn("d_level_", level("d_"))}
    sizes = sides[""].select(F.lit("").alias("side"), "level_").union(sides["d_"].select(F.lit("d_"), "d_level_")).where("level_ is not null").distinct().collect()  # a few dozen at most
    have = {p: sorted(r.level_ for r in sizes if r.side == p) for p in sides}

    def listed(p: str, other: str) -> DataFrame:
        # Roles tell who is as large as the cell: 0 both, 1 the left side only, 2 the right side only.
        own, mine = F.col(f"{p}level_"), 1 if p == "" else 2
        greater = F.transform(F.filter(F.array(*map(F.lit, have[other])) if have[other] else F.array().cast("array<int>"), lambda x: x > own), lambda x: F.struct(x.alias("at"), F.lit(3 - mine).alias("role")))
        places = F.concat(F.array(F.struct(own.alias("at"), F.lit(0).alias("role")), F.struct(own.alias("at"), F.lit(mine).alias("role"))), greater)
        at = sides[p].withColumn("place_", F.explode(places)).select(*sides[p].columns, F.col("place_.at").alias("at_"), F.col("place_.role").alias("role_"))
        cell = lambda c: F.floor(F.col(f"{p}{c}") / F.pow(F.lit(2.0), F.col("at_")))
        return at.withColumn("cx_", F.explode(F.sequence(cell("left"), cell("right")))).withColumn("cy_", F.explode(F.sequence(cell("bottom"), cell("top"))))

    both = listed("", "d_").join(listed("d_", ""), ["at_", "role_", "cx_", "cy_"]).where(overlaps("", "d_", strict))
    side = F.pow(F.lit(2.0), F.col("at_"))
    corner = (F.col("cx_") == F.floor(F.greatest("left", "d_left") / side)) & (F.col("cy_") == F.floor(F.greatest("bottom", "d_bottom") / side))
    return both.where(corner).select(*boxes.columns, *renamed.columns)


def touched_blocks(blocks: DataFrame, rectangles: DataFrame) -> DataFrame:
    """Blocks that strictly overlap a dirty rectangle, each once."""
    return meeting(blocks, rectangles.select(*SIDES)).select(*blocks.columns).distinct()
