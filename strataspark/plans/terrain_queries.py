"""Operators of the engine over the driver's tables: lineitem as pixels, orders as sheet index, embeddings as 8x8 chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.functions import crs, geometry, grid
from strataspark.functions.numeric import round_half_even
from strataspark.operators import catalog, chunks, convert, levels, mosaic, plan, stats, warp
from strataspark.plans.mosaic_queries import PIXELS_SQL, mosaic_first_wins, pixels
from strataspark.sources import archive
from strataspark.sources import ascii as texts
from strataspark.sources import index as sheet_index

RING = [(3.0, 2.0), (50.0, 10.0), (60.0, 45.0), (30.0, 58.0), (8.0, 40.0)]
HOLE = [(20.0, 20.0), (30.0, 20.0), (30.0, 30.0), (20.0, 30.0)]
RINGS = [RING, HOLE]


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sheets(spark, sf) -> DataFrame:
    return _read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("s"), F.col("o_custkey")).alias("plik"), F.to_date("o_orderdate").alias("akt_data"), F.col("o_custkey").alias("nr_zglosz"),
        F.col("o_orderpriority").alias("format"), F.col("o_orderstatus").alias("uklad_xy"), F.col("o_totalprice").alias("price"),
    )


SHEETS_SQL = "SELECT o_orderkey AS seq, concat('s', o_custkey) AS plik, CAST(o_orderdate AS DATE) AS akt_data, o_custkey AS nr_zglosz, o_orderpriority AS format, o_orderstatus AS uklad_xy, o_totalprice AS price FROM orders"


def _split(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two sheet lists that share some sheets: the index and the manifest of one year."""
    s = _sheets(spark, sf).select(F.concat("plik", F.lit("-"), F.col("seq") % 7).alias("plik"), F.col("akt_data").cast("string").alias("akt_data"), (F.col("seq") % 5).alias("kind")).distinct()
    return s.where("kind <> 0").select("plik", "akt_data").distinct(), s.where("kind <> 1").select("plik", "akt_data").distinct()


SPLIT_SQL = f"""
s AS (SELECT DISTINCT concat(plik, '-', seq % 7) AS plik, CAST(akt_data AS VARCHAR) AS akt_data, seq % 5 AS kind FROM ({SHEETS_SQL})),
idx AS (SELECT DISTINCT plik, akt_data FROM s WHERE kind <> 0), man AS (SELECT DISTINCT plik, akt_data FROM s WHERE kind <> 1),
plus AS (SELECT * FROM idx EXCEPT SELECT * FROM man), minus AS (SELECT * FROM man EXCEPT SELECT * FROM idx)
"""


def _chunks(spark, sf) -> DataFrame:
    return _read(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "z")).select("vec_id", F.floor(F.col("p") / 8).cast("int").alias("row"), (F.col("p") % 8).alias("col"), "z")


CHUNKS_SQL = "SELECT vec_id, CAST((p - 1) // 8 AS INTEGER) AS row, CAST((p - 1) % 8 AS INTEGER) AS col, z FROM (SELECT vec_id, unnest(embedding) AS z, generate_subscripts(embedding, 1) AS p FROM embeddings)"


def _layers(spark, sf) -> DataFrame:
    return mosaic_first_wins(spark, sf)


LAYERS_SQL = f"SELECT rok, col, row, z, res_src FROM (SELECT *, row_number() OVER (PARTITION BY rok, col, row ORDER BY akt_data DESC, plik DESC, line_no DESC, price DESC, res_src DESC) AS n FROM ({PIXELS_SQL})) WHERE n = 1"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        ORACLE_SQL[name] = sql
        return f

    return add


@_query("catalog_dedup_first", f"SELECT nr_zglosz, seq, format FROM (SELECT *, row_number() OVER (PARTITION BY nr_zglosz ORDER BY seq) AS n FROM ({SHEETS_SQL})) WHERE n = 1")
def catalog_dedup_first(spark, sf):
    return catalog.first_of(_sheets(spark, sf), ["nr_zglosz"], [F.col("seq")]).select("nr_zglosz", "seq", "format")


@_query("catalog_filter_crs", f"SELECT seq, uklad_xy, CASE uklad_xy WHEN 'F' THEN 2180 ELSE 2178 END::INTEGER AS epsg FROM ({SHEETS_SQL}) WHERE uklad_xy IN ('F', 'O') AND NOT contains(upper(trim(format)), 'URGENT')")
def catalog_filter_crs(spark, sf):
    known, _ = catalog.known_crs(_sheets(spark, sf), names={"F": 2180, "O": 2178})
    return known.where(~catalog.to_be_done(F.col("format"), "URGENT")).select("seq", "uklad_xy", "epsg")


@_query("catalog_unknown_crs", f"SELECT uklad_xy, count(*) AS n FROM ({SHEETS_SQL}) WHERE uklad_xy NOT IN ('F', 'O') GROUP BY 1")
def catalog_unknown_crs(spark, sf):
    return catalog.known_crs(_sheets(spark, sf), names={"F": 2180, "O": 2178})[1].groupBy("uklad_xy").agg(F.count("*").alias("n"))


@_query("catalog_counters", f"SELECT count_if(contains(upper(trim(format)), 'URGENT'))::BIGINT AS tbd, count_if(uklad_xy NOT IN ('F', 'O'))::BIGINT AS unknown_crs, count(*) AS all_rows FROM ({SHEETS_SQL})")
def catalog_counters(spark, sf):
    return catalog.counters(_sheets(spark, sf), names={"F": 2180, "O": 2178}, mark="URGENT")


@_query("campaign_distinct", f"SELECT DISTINCT nr_zglosz, format FROM ({SHEETS_SQL})")
def campaign_distinct(spark, sf):
    return catalog.campaign_formats(_sheets(spark, sf))


@_query("campaign_select", f"SELECT seq FROM ({SHEETS_SQL}) WHERE nr_zglosz = (SELECT min(nr_zglosz) FROM ({SHEETS_SQL})) AND format = '1-URGENT'")
def campaign_select(spark, sf):
    sheets = _sheets(spark, sf)
    return catalog.of_campaign(sheets, sheets.agg(F.min("nr_zglosz")).head()[0], "1-URGENT").select("seq")


@_query("last_of_each", f"SELECT nr_zglosz, format, max(seq) AS seq FROM ({SHEETS_SQL}) GROUP BY ALL")
def last_of_each(spark, sf):
    return plan.last_of_each(_sheets(spark, sf), ("nr_zglosz", "format"), "seq").select("nr_zglosz", "format", "seq")


@_query("campaign_ordinal", f"SELECT nr_zglosz, first_seq, CAST(dense_rank() OVER (ORDER BY first_seq) - 1 AS INTEGER) AS ordinal FROM (SELECT nr_zglosz, min(seq) AS first_seq FROM ({SHEETS_SQL}) GROUP BY 1)")
def campaign_ordinal(spark, sf):
    return catalog.campaigns(_sheets(spark, sf), "nr_zglosz", "seq")


@_query("lookup_default", """
SELECT o_orderkey, coalesce(c.c_nationkey, s.s_nationkey, -1)::INTEGER AS nation FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c ON o_custkey = c_custkey LEFT JOIN supplier s ON o_custkey = s_suppkey""")
def lookup_default(spark, sf):
    o = _read(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k1"), F.col("o_custkey").alias("k2"))
    first = _read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k1"), F.col("c_nationkey").alias("nation"))
    second = _read(spark, sf, "supplier").select(F.col("s_suppkey").alias("k2"), F.col("s_nationkey").alias("nation"))
    return catalog.lookup_with_default(o, first, second, "k1", "k2", "nation", -1).select("o_orderkey", "nation")


@_query("last_archive", "SELECT l_partkey AS member, arg_max(l_orderkey, struct_pack(o := l_orderkey, l := l_linenumber)) AS archive FROM lineitem GROUP BY 1")
def last_archive(spark, sf):
    return catalog.last_archive(_read(spark, sf, "lineitem").select(F.col("l_partkey").alias("member"), F.col("l_orderkey").alias("archive"), F.struct("l_orderkey", "l_linenumber").alias("seq")))


@_query("total_bounds", "SELECT min(l_partkey % 64)::DOUBLE AS left, min(l_suppkey % 64)::DOUBLE AS bottom, max(l_partkey % 64)::DOUBLE AS right, max(l_suppkey % 64)::DOUBLE AS top FROM lineitem")
def total_bounds(spark, sf):
    x, y = F.col("col").cast("double"), F.col("row").cast("double")
    return catalog.total_bounds(pixels(spark, sf).select(x.alias("left"), y.alias("bottom"), x.alias("right"), y.alias("top")))


@_query("resolution_histogram", f"SELECT res_src AS res, count(*) AS n FROM ({PIXELS_SQL}) GROUP BY 1")
def resolution_histogram(spark, sf):
    return catalog.resolution_histogram(pixels(spark, sf).withColumnRenamed("res_src", "res"))


@_query("finest_coarsest", f"SELECT rok, min(res_src) AS finest, max(round_even(res_src * 100.0::DOUBLE, 0) / 100.0::DOUBLE) AS coarsest FROM ({PIXELS_SQL}) GROUP BY 1")
def finest_coarsest(spark, sf):
    p = pixels(spark, sf)
    return catalog.finest(p, ("rok",), "res_src", rounded=False).join(catalog.coarsest(p, ("rok",), "res_src"), "rok")


@_query("resolution_counters", f"SELECT count_if(round_even(res_src * 100.0::DOUBLE, 0) / 100.0::DOUBLE > 0.040001::DOUBLE)::BIGINT AS grubsze, count_if(round_even(res_src * 100.0::DOUBLE, 0) / 100.0::DOUBLE < 0.039999::DOUBLE)::BIGINT AS drobniejsze FROM ({PIXELS_SQL})")
def resolution_counters(spark, sf):
    return catalog.resolution_counters(pixels(spark, sf), 0.04, "res_src")


@_query("plan_diff", f"WITH {SPLIT_SQL} SELECT *, 'added' AS change_type FROM plus UNION ALL SELECT *, 'removed' FROM minus")
def plan_diff(spark, sf):
    return plan.diff(*_split(spark, sf))


@_query("plan_added_known", f"WITH {SPLIT_SQL} SELECT * FROM plus WHERE NOT ends_with(plik, '3')")
def plan_added_known(spark, sf):
    index, manifest = _split(spark, sf)
    return plan.added(index, manifest, index.where("endswith(plik, '3')"))


@_query("reissued_intersect", f"WITH {SPLIT_SQL} SELECT plik FROM plus INTERSECT SELECT plik FROM minus")
def reissued_intersect(spark, sf):
    index, manifest = _split(spark, sf)
    return plan.reissued(plan.added(index, manifest), plan.removed(index, manifest))


@_query("dirty_union", f"WITH {SPLIT_SQL} SELECT plik, akt_data FROM plus UNION ALL SELECT plik, akt_data FROM minus")
def dirty_union(spark, sf):
    index, manifest = _split(spark, sf)
    return plan.dirty(plan.added(index, manifest), plan.removed(index, manifest), ("plik", "akt_data"))


@_query("plan_action_by_year", f"""
WITH {SPLIT_SQL}, p AS (SELECT substr(akt_data, 1, 4) AS rok, count(*) AS n FROM plus GROUP BY 1), m AS (SELECT substr(akt_data, 1, 4) AS rok, count(*) AS n FROM minus GROUP BY 1),
years AS (SELECT DISTINCT substr(akt_data, 1, 4) AS rok FROM idx), old AS (SELECT DISTINCT substr(akt_data, 1, 4) AS rok FROM man WHERE substr(akt_data, 1, 4) <> '1993')
SELECT rok, CASE WHEN old.rok IS NULL THEN 'nowa' WHEN rok = '1994' THEN 'przebudowa' WHEN p.n IS NULL AND m.n IS NULL THEN 'aktualna' ELSE 'zmiana' END AS akcja,
coalesce(p.n, 0)::BIGINT AS dodane, (CASE WHEN old.rok IS NULL THEN 0 ELSE coalesce(m.n, 0) END)::BIGINT AS usuniete
FROM years LEFT JOIN old USING (rok) LEFT JOIN p USING (rok) LEFT JOIN m USING (rok)""")
def plan_action_by_year(spark, sf):
    index, manifest = (df.withColumn("rok", F.substring("akt_data", 1, 4)) for df in _split(spark, sf))
    status = F.when(F.col("rok") == "1994", "w_toku").otherwise("kompletna")  # one year was cut off, one has no record
    records = manifest.select("rok").distinct().where("rok <> '1993'").withColumn("status", status)
    return plan.actions(index, manifest, records)


@_query("tiles_semi", "SELECT l_orderkey AS plik, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def tiles_semi(spark, sf):
    tiles = _read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("plik"), "l_linenumber")
    return plan.used(tiles, _read(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("plik")))[0]


@_query("sheets_anti_split", """
SELECT o_orderkey AS plik, CASE WHEN o_orderkey % 3 = 0 THEN 'nieobslugiwane' ELSE 'pominiete' END AS powod FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30)""")
def sheets_anti_split(spark, sf):
    sheets = _read(spark, sf, "orders").select(F.col("o_orderkey").alias("plik"))
    tiles = _read(spark, sf, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("plik"))
    return plan.unused(sheets, tiles, sheets.where("plik % 3 = 0").select(F.col("plik").alias("archive")))


@_query("stale_conversions", "SELECT o_orderkey AS plik FROM orders JOIN (SELECT l_orderkey, max(l_shipdate)::DATE AS d FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE o_orderdate::DATE <> d")
def stale_conversions(spark, sf):
    have = _read(spark, sf, "orders").select(F.col("o_orderkey").alias("plik"), F.to_date("o_orderdate").alias("akt_data"))
    want = _read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("plik")).agg(F.to_date(F.max("l_shipdate")).alias("akt_data"))
    return plan.stale(have, want).select("plik")


@_query("not_converted", "SELECT o_orderkey AS plik FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def not_converted(spark, sf):
    return plan.not_yet(_read(spark, sf, "orders").select(F.col("o_orderkey").alias("plik")), _read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("plik")))


def _boxes(spark, sf) -> DataFrame:
    return _read(spark, sf, "supplier").select(
        "s_suppkey", (F.col("s_suppkey") % 61).cast("double").alias("left"), (F.col("s_suppkey") % 47).cast("double").alias("bottom"),
        (F.col("s_suppkey") % 61 + 1 + F.col("s_suppkey") % 3).cast("double").alias("right"), (F.col("s_suppkey") % 47 + 2).cast("double").alias("top"))


BOXES_SQL = "SELECT s_suppkey, (s_suppkey % 61)::DOUBLE AS l, (s_suppkey % 47)::DOUBLE AS b, (s_suppkey % 61 + 1 + s_suppkey % 3)::DOUBLE AS r, (s_suppkey % 47 + 2)::DOUBLE AS t FROM supplier"
GRID = grid.Grid(0.0, 64.0, 1.0, 64, 64)
BLOCKS_SQL = 'SELECT y::INTEGER AS "by", x::INTEGER AS bx, (x * 10)::DOUBLE AS l, (64 - least(y * 10 + 10, 64))::DOUBLE AS b, least(x * 10 + 10, 64)::DOUBLE AS r, (64 - y * 10)::DOUBLE AS t FROM range(7) a(y), range(7) c(x)'


@_query("block_dirty_semi", f'WITH d AS ({BOXES_SQL} WHERE s_acctbal < 0), k AS ({BLOCKS_SQL}) SELECT "by", bx FROM k WHERE EXISTS (SELECT 1 FROM d WHERE k.r > d.l AND k.l < d.r AND k.t > d.b AND k.b < d.t)')
def block_dirty_semi(spark, sf):
    overdrawn = _read(spark, sf, "supplier").where("s_acctbal < 0").select("s_suppkey")
    return plan.touched_blocks(GRID.blocks(spark, 10), _boxes(spark, sf).join(overdrawn, "s_suppkey", "left_semi")).select("by", "bx")


@_query("block_sheet_range", f'WITH d AS ({BOXES_SQL}), k AS ({BLOCKS_SQL}) SELECT "by", bx, s_suppkey FROM k JOIN d ON k.r >= d.l AND k.l <= d.r AND k.t >= d.b AND k.b <= d.t')
def block_sheet_range(spark, sf):
    return plan.meeting(GRID.blocks(spark, 10), _boxes(spark, sf), strict=False).select("by", "bx", F.col("d_s_suppkey").alias("s_suppkey"))


EDGES_SQL = "(VALUES " + ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for a, b, c, d in geometry.edges(RINGS)) + ") e(x1, y1, x2, y2)"


@_query("point_in_polygon", f"""
SELECT DISTINCT col, row FROM ({PIXELS_SQL}) p WHERE (SELECT count(*) FROM {EDGES_SQL}
  WHERE ((y1 > row + 0.5::DOUBLE) <> (y2 > row + 0.5::DOUBLE)) AND col + 0.5::DOUBLE < (x2 - x1) * (row + 0.5::DOUBLE - y1) / (y2 - y1) + x1) % 2 = 1""")
def point_in_polygon(spark, sf):
    return geometry.inside(pixels(spark, sf).select("col", "row").distinct(), RINGS, F.col("col") + F.lit(0.5), 0.0, 1.0)


@_query("level_max_2x2", f"SELECT vec_id, (row // 2)::INTEGER AS row, (col // 2)::INTEGER AS col, max(z) AS z FROM ({CHUNKS_SQL}) GROUP BY ALL")
def level_max_2x2(spark, sf):
    return levels.coarsest(_chunks(spark, sf), 2, ("vec_id",), "z")


@_query("level_average", f"SELECT vec_id, (row // 2)::INTEGER AS row, (col // 2)::INTEGER AS col, round_even(avg(z::DOUBLE) * 1000000.0::DOUBLE, 0) / 1000000.0::DOUBLE AS z FROM ({CHUNKS_SQL}) GROUP BY ALL")
def level_average(spark, sf):
    return levels.resample(_chunks(spark, sf), 2, "average", ("vec_id",), round_places=None).withColumn("z", round_half_even(F.col("z"), 6))


@_query("level_nearest", f"SELECT vec_id, (row // 2)::INTEGER AS row, (col // 2)::INTEGER AS col, z::DOUBLE AS z FROM ({CHUNKS_SQL}) WHERE row % 2 = 1 AND col % 2 = 1")
def level_nearest(spark, sf):
    return levels.resample(_chunks(spark, sf), 2, "nearest", ("vec_id",), round_places=None)


def _kernel_sql(weight: str) -> str:
    return f"""
WITH c AS ({CHUNKS_SQL}), t AS (SELECT a::INTEGER AS tr, b::INTEGER AS tc FROM range(4) x(a), range(4) y(b)),
d AS (SELECT vec_id, tr, tc, z::DOUBLE AS z, abs((row + 0.5::DOUBLE) / 2 - 0.5::DOUBLE - tr) AS dr, abs((col + 0.5::DOUBLE) / 2 - 0.5::DOUBLE - tc) AS dc FROM c, t),
w AS (SELECT vec_id, tr, tc, z, ({weight.replace('#', 'dr')}) * ({weight.replace('#', 'dc')}) AS w FROM d)
SELECT vec_id, tr AS row, tc AS col, round_even(sum(w * z) / sum(w) * 1000000.0::DOUBLE, 0) / 1000000.0::DOUBLE AS z FROM w WHERE w <> 0 GROUP BY ALL"""


@_query("level_bilinear", _kernel_sql("greatest(0.0::DOUBLE, 1.0::DOUBLE - #)"))
def level_bilinear(spark, sf):
    return levels.resample(_chunks(spark, sf), 2, "bilinear", ("vec_id",), height=4, width=4, round_places=None).withColumn("z", round_half_even(F.col("z"), 6))


@_query("level_cubic", _kernel_sql("CASE WHEN # <= 1 THEN 1.5::DOUBLE * # * # * # - 2.5::DOUBLE * # * # + 1 WHEN # < 2 THEN -0.5::DOUBLE * # * # * # + 2.5::DOUBLE * # * # - 4.0::DOUBLE * # + 2 ELSE 0.0::DOUBLE END"))
def level_cubic(spark, sf):
    return levels.resample(_chunks(spark, sf), 2, "bicubic", ("vec_id",), height=4, width=4, round_places=None).withColumn("z", round_half_even(F.col("z"), 6))


@_query("layer_stats", f"SELECT rok, min(z) AS z_min, avg(z) AS z_mean, max(z) AS z_max, count(z) AS n FROM ({LAYERS_SQL}) GROUP BY 1")
def layer_stats(spark, sf):
    return stats.layer_stats(_layers(spark, sf))


@_query("year_change_share", f"""
WITH l AS ({LAYERS_SQL}) SELECT a.rok, count(*) AS n_common, sum(CASE WHEN abs(a.z - b.z) > 0.005::DOUBLE THEN 1 ELSE 0 END)::DOUBLE / count(*) AS share_0,
sum(CASE WHEN abs(a.z - b.z) > 0.5::DOUBLE THEN 1 ELSE 0 END)::DOUBLE / count(*) AS share_1, sum(CASE WHEN abs(a.z - b.z) > 2.0::DOUBLE THEN 1 ELSE 0 END)::DOUBLE / count(*) AS share_2
FROM l a JOIN l b ON a.rok = b.rok + 1 AND a.col = b.col AND a.row = b.row GROUP BY 1""")
def year_change_share(spark, sf):
    return stats.change_shares(_layers(spark, sf), "rok")


@_query("resolution_share", f"SELECT round_even(res_src * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE AS res, round_even(count(*)::DOUBLE / sum(count(*)) OVER () * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE AS share FROM ({LAYERS_SQL}) GROUP BY 1")
def resolution_share(spark, sf):
    return stats.resolution_shares(_layers(spark, sf))


@_query("coverage_by_year", f"WITH l AS ({LAYERS_SQL}) SELECT rok, count(*)::DOUBLE / (SELECT count(*) FROM (SELECT DISTINCT col, row FROM l)) AS coverage FROM l GROUP BY 1")
def coverage_by_year(spark, sf):
    return stats.coverage(_layers(spark, sf))


@_query("cover_prefix", f"""
WITH p AS ({PIXELS_SQL}), r AS (SELECT plik, dense_rank() OVER (ORDER BY max(akt_data) DESC, plik DESC) AS rank FROM p GROUP BY plik),
f AS (SELECT col, row, min(rank) AS first FROM p JOIN r USING (plik) GROUP BY ALL) SELECT max(first)::BIGINT AS n_sheets, true AS complete FROM f""")
def cover_prefix(spark, sf):
    p = pixels(spark, sf)
    newest = catalog.dense_ordinals(p.groupBy("plik").agg(F.max("akt_data").alias("d")), ["d", "plik"], "rank", descending=True).select("plik", F.col("rank") + 1)
    return stats.covering_prefix(p.join(newest.toDF("plik", "rank"), "plik"), p.select("row", "col"))


@_query("block_assign", f'SELECT (row // 16)::INTEGER AS "by", (col // 16)::INTEGER AS bx, count(*) AS n FROM ({PIXELS_SQL}) GROUP BY ALL')
def block_assign(spark, sf):
    level = grid.Level(GRID, 1, 16)
    return pixels(spark, sf).groupBy(*(c.alias(n) for n, c in level.block_columns().items())).agg(F.count("*").alias("n"))


@_query("block_count", f'SELECT count(DISTINCT (row // 16, col // 16)) AS blocks FROM ({PIXELS_SQL})')
def block_count(spark, sf):
    return stats.block_count(pixels(spark, sf).withColumns(grid.Level(GRID, 1, 16).block_columns()))


@_query("grid_snap", "SELECT o_orderkey, floor(o_totalprice / 0.5::DOUBLE) * 0.5::DOUBLE AS lo, ceil(o_totalprice / 0.5::DOUBLE) * 0.5::DOUBLE AS hi FROM orders")
def grid_snap(spark, sf):
    half, price = grid.Lattice(0.5), F.col("o_totalprice")
    return _read(spark, sf, "orders").select("o_orderkey", half.at(half.before_column(price)).alias("lo"), half.at(half.after_column(price)).alias("hi"))


@_query("step_infer", """
WITH v AS (SELECT DISTINCT l_suppkey AS plik, round_even(l_extendedprice * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE AS v FROM lineitem),
g AS (SELECT plik, v - lag(v) OVER (PARTITION BY plik ORDER BY v) AS gap FROM v)
SELECT plik, round_even(min(gap) * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS step FROM g WHERE gap > 0.05::DOUBLE GROUP BY 1""")
def step_infer(spark, sf):
    return texts.infer_step(_read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("plik"), F.col("l_extendedprice").alias("x"), F.lit(1.0).alias("y")))


@_query("xyz_parse", "SELECT l_orderkey AS plik, l_linenumber AS line_no, l_partkey::DOUBLE AS x, l_suppkey::DOUBLE AS y, l_quantity AS z FROM lineitem WHERE l_returnflag <> 'A'")
def xyz_parse(spark, sf):
    text = F.concat_ws(" ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.when(F.col("l_returnflag") == "A", F.lit("none")).otherwise(F.col("l_quantity").cast("string")))
    return texts.xyz_points(_read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("plik"), F.col("l_linenumber").alias("line_no"), text.alias("text")))


@_query("variant_suffix", "SELECT p_partkey FROM part WHERE p_partkey % 3 <> 1")
def variant_suffix(spark, sf):
    name = F.concat(F.lit("N-33-"), F.col("p_partkey").cast("string"), F.element_at(F.array(F.lit(""), F.lit("_l"), F.lit("_P")), (F.col("p_partkey") % 3 + 1).cast("int")), F.lit(".asc"))
    return _read(spark, sf, "part").where(texts.kept_variant(name)).select("p_partkey")


@_query("file_names", "SELECT page_id, regexp_extract(url, '[^/]*$') AS plik FROM pages")
def file_names(spark, sf):
    return _read(spark, sf, "pages").select("page_id", catalog.file_name(F.col("url")).alias("plik"))


@_query("index_xml", """SELECT o_orderkey, concat('N-', o_custkey) AS godlo, o_orderpriority AS format, (o_orderkey % 64)::DOUBLE AS "left", o_totalprice AS top FROM orders WHERE o_orderstatus <> 'P'""")
def index_xml(spark, sf):
    corner = lambda tag, x, y: F.concat(F.lit(f"<g:{tag}>"), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(f"</g:{tag}>"))
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    box = F.concat(F.lit("<g:boundedBy><g:Envelope>"), corner("lowerCorner", key % 64, F.lit(0)), corner("upperCorner", key, price), F.lit("</g:Envelope></g:boundedBy>"))
    text = F.concat(F.lit('<w:S xmlns:w="u" xmlns:g="v">'), F.when(F.col("o_orderstatus") != "P", box).otherwise(""), F.lit("<w:godlo>N-"), F.col("o_custkey").cast("string"), F.lit("</w:godlo><w:format>"), F.col("o_orderpriority"), F.lit("</w:format></w:S>"))
    rows = sheet_index.parse_index(_read(spark, sf, "orders").select("o_orderkey", text.alias("text")), "text", "o_orderkey")
    return rows.select("o_orderkey", "godlo", "format", "bounds.left", "bounds.top")


@_query("clean_lists", "SELECT p_partkey, [trim(x) for x in string_split(concat(p_type, ', ,', p_brand, ','), ',') if trim(x) <> ''] AS names FROM part")
def clean_lists(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", sheet_index.clean_list_column(F.concat("p_type", F.lit(", ,"), "p_brand", F.lit(","))).alias("names"))


@_query("iso_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS akt_data FROM orders")
def iso_dates(spark, sf):
    return _read(spark, sf, "orders").select("o_orderkey", catalog.iso_date(F.col("o_orderdate")).alias("akt_data"))


@_query("time_bounds", f"SELECT DISTINCT rok, epoch(make_timestamp(rok, 7, 1, 0, 0, 0.0))::BIGINT AS time, epoch(make_timestamp(rok, 1, 1, 0, 0, 0.0))::BIGINT AS start, epoch(make_timestamp(rok, 12, 31, 23, 59, 59.0))::BIGINT AS stop FROM ({PIXELS_SQL})")
def time_bounds(spark, sf):
    at, start, end = stats.time_axis(F.col("rok"))
    return pixels(spark, sf).select("rok").distinct().select("rok", at.alias("time"), start.alias("start"), end.alias("stop"))


CELL_SQL = "CAST(CAST(round_even(CAST(CAST(z AS FLOAT) * 100::FLOAT AS DOUBLE), 0) AS DOUBLE) / 100.0::DOUBLE AS FLOAT)"


@_query("grid_read", f"SELECT vec_id::VARCHAR AS plik, row, col, {CELL_SQL} AS z, 500003.5::DOUBLE AS \"right\" FROM ({CHUNKS_SQL}) WHERE CAST(z AS FLOAT) >= 0")
def grid_read(spark, sf):
    head = "ncols 8\nnrows 8\nxllcenter 499996\nyllcenter 0.5\ncellsize 1\nnodata_value -9999\n"
    shown = F.transform("embedding", lambda v: F.when(v >= 0, v.cast("string")).otherwise("-9999"))
    files = _read(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("plik"), F.concat(F.lit(head), F.array_join(shown, " ")).alias("text"))
    meta, cells = texts.read_grid(files)
    return cells.join(meta.select("plik", "right"), "plik").select("plik", "row", "col", "z", "right")


LINES_SQL = "SELECT l_suppkey::VARCHAR AS plik, (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS line_no, l_partkey % 64 + 0.5::DOUBLE AS x, l_orderkey % 64 + 0.5::DOUBLE AS y, l_quantity + l_tax AS z FROM lineitem"


@_query("xyz_raster", f"""
WITH p AS ({LINES_SQL}), v AS (SELECT DISTINCT plik, x FROM p), gaps AS (SELECT plik, x - lag(x) OVER (PARTITION BY plik ORDER BY x) AS gap FROM v),
step AS (SELECT plik, min(gap) AS step FROM gaps WHERE gap > 0.05::DOUBLE GROUP BY 1), box AS (SELECT plik, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p GROUP BY 1),
c AS (SELECT plik, CAST(round_even((y1 - y) / step, 0) AS INTEGER) AS row, CAST(round_even((x - x0) / step, 0) AS INTEGER) AS col, arg_max(z, line_no) AS z FROM p JOIN step USING (plik) JOIN box USING (plik) GROUP BY ALL)
SELECT plik, row, col, CAST(round_even(z * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS FLOAT) AS z, step AS res, x0 - step / 2 AS "left", y1 + step / 2 AS top,
CAST(round_even((x1 - x0) / step, 0) + 1 AS INTEGER) AS ncols, CAST(round_even((y1 - y0) / step, 0) + 1 AS INTEGER) AS nrows FROM c JOIN step USING (plik) JOIN box USING (plik)""")
def xyz_raster(spark, sf):
    number = lambda c: (F.col(c) % 64 + F.lit(0.5)).cast("string")
    text = F.concat_ws("\t ", number("l_partkey"), number("l_orderkey"), (F.col("l_quantity") + F.col("l_tax")).cast("string"))
    lines = _read(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("plik"), ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")).alias("line_no"), text.alias("text"))
    meta, cells = texts.read_xyz(lines)
    return cells.join(meta.select("plik", "res", "left", "top", "ncols", "nrows"), "plik")


@_query("sheet_on_grid", f"""
WITH c AS (SELECT vec_id::VARCHAR AS plik, (vec_id % 50)::DOUBLE + col * 1.5::DOUBLE AS x0, 60.0::DOUBLE - vec_id % 7 - row * 1.5::DOUBLE AS y1, z FROM ({CHUNKS_SQL})),
x AS (SELECT plik, y1, z, CAST(k AS INTEGER) AS col FROM c, range(64) r(k) WHERE k + 0.5::DOUBLE >= x0 AND k + 0.5::DOUBLE < x0 + 1.5::DOUBLE)
SELECT plik, CAST(k AS INTEGER) AS row, col, z, 1.5::FLOAT AS res_src FROM x, range(64) r(k) WHERE 64 - (k + 0.5::DOUBLE) <= y1 AND 64 - (k + 0.5::DOUBLE) > y1 - 1.5::DOUBLE""")
def sheet_on_grid(spark, sf):
    cells = _chunks(spark, sf).select(F.col("vec_id").cast("string").alias("plik"), "row", "col", "z")
    at = F.col("vec_id")
    meta = _read(spark, sf, "embeddings").select(at.cast("string").alias("plik"), F.lit(1.5).alias("res"), (at % 50).cast("double").alias("left"), (F.lit(60.0) - at % 7).alias("top"), F.lit(None).cast("string").alias("akt_data"))
    return mosaic.on_grid(meta, cells, GRID).select("plik", "row", "col", "z", "res_src")


@_query("crs_detect", """
WITH l AS (SELECT l_orderkey AS plik, l_linenumber AS line_no, struct_pack(a := -l_linenumber, b := l_partkey, c := l_suppkey, d := l_extendedprice) AS place, l_returnflag AS flag, (l_partkey % 10) * 1000000 + l_extendedprice AS a, l_suppkey * 3000.0::DOUBLE AS b FROM lineitem),
v AS (SELECT plik, place, CASE WHEN flag = 'R' THEN a WHEN a < 100000 THEN b ELSE a END AS x, CASE WHEN flag = 'R' THEN b WHEN a < 100000 THEN 7.0::DOUBLE ELSE b END AS y FROM l WHERE flag <> 'A'),
z AS (SELECT *, substr(CAST(CAST(floor(CASE WHEN x > 4000000 THEN x WHEN y > 4000000 THEN y END) AS BIGINT) AS VARCHAR), 1, 1) AS zone FROM v WHERE x >= 100000 AND y >= 100000),
e AS (SELECT plik, place, CASE WHEN zone IN ('5', '6', '7', '8') THEN 2171 + zone::INTEGER WHEN x > 100000 AND x < 1000000 AND y > 100000 AND y < 1000000 THEN 2180 END AS epsg FROM z)
SELECT plik, arg_max(epsg, place)::INTEGER AS epsg FROM (SELECT DISTINCT l_orderkey AS plik FROM lineitem) LEFT JOIN (SELECT * FROM e WHERE epsg IS NOT NULL) USING (plik) GROUP BY plik""")
def crs_detect(spark, sf):
    a, b = (F.col("l_partkey") % 10) * 1_000_000 + F.col("l_extendedprice"), F.col("l_suppkey") * F.lit(3000.0)
    fields = F.concat_ws("; ", a.cast("decimal(18,6)").cast("string"), b.cast("decimal(18,1)").cast("string"), F.lit("7.0"))
    text = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("  # "), fields)).when(F.col("l_returnflag") == "R", F.concat(F.col("l_linenumber").cast("string"), F.lit(" "), fields)).otherwise(fields)
    # Numbers repeat within an order; part, supplier and price make the order of lines total.
    lines = _read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("plik"), F.col("l_linenumber").alias("line_no"), text.alias("text"), "l_partkey", "l_suppkey", "l_extendedprice")
    return crs.detect(lines, places=("l_partkey", "l_suppkey", "l_extendedprice"))


def _plane_sql(epsg: int) -> str:
    """The forward projection over columns lon and lat, from the same series."""
    lon0, scale, fe, fn = crs.PROJECTIONS[epsg]
    number = lambda x: f"{x!r}::DOUBLE"
    terms = lambda outer, f, g: " + ".join([outer, *(f"{f}({2 * j} * xi) * {g}({2 * j} * eta) * {number(a)}" for j, a in enumerate(crs._ALPHA, 1))])
    return f"""SELECT c_custkey, ({terms("eta", "cos", "sinh")}) * {number(scale * crs._R)} + {number(fe)} AS east, ({terms("xi", "sin", "cosh")}) * {number(scale * crs._R)} + {number(fn)} AS north
FROM (SELECT c_custkey, atan2(t, cos(lam)) AS xi, asinh(sin(lam) / sqrt(t * t + cos(lam) * cos(lam))) AS eta
FROM (SELECT c_custkey, sinh(atanh(sin(phi)) - {number(crs._E)} * atanh({number(crs._E)} * sin(phi))) AS t, lam FROM (SELECT c_custkey, radians(lat) AS phi, radians(lon - {number(lon0)}) AS lam FROM places)))"""


PLACES_SQL = "places AS (SELECT c_custkey, 14.2::DOUBLE + (c_custkey % 97) / 10.0::DOUBLE AS lon, 49.1::DOUBLE + (c_custkey % 53) / 10.0::DOUBLE AS lat FROM customer)"


@_query("crs_round_trip", f"WITH {PLACES_SQL} SELECT c_custkey, round(east, 3) AS east, round(north, 3) AS north, true AS returns FROM ({_plane_sql(2180)})")
def crs_round_trip(spark, sf):
    """Customers spread over the country, to the plane and back."""
    lon, lat = F.lit(14.2) + (F.col("c_custkey") % 97) / 10.0, F.lit(49.1) + (F.col("c_custkey") % 53) / 10.0
    m = crs.COLUMNS
    east, north = crs.to_plane(lon, lat, 2180, m)
    back = crs.to_degrees(east, north, 2180, m)
    off = F.greatest(F.abs(back[0] - lon), F.abs(back[1] - lat))
    return _read(spark, sf, "customer").select("c_custkey", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"), (off < 1e-10).alias("returns"))


def _transform_sql(rows: str, source: int, target: int) -> str:
    """``rows``, with columns x and y of one system, with tx and ty of another: the inverse series and the forward one."""
    number = lambda x: f"{x!r}::DOUBLE"
    lon0, k, fe, fn = crs.PROJECTIONS[source]
    minus = lambda f, g: "".join(f" - {f}({2 * j} * xi) * {g}({2 * j} * eta) * {number(b)}" for j, b in enumerate(crs._BETA, 1))
    sql = f"SELECT *, (y - {number(fn)}) / {number(k * crs._R)} AS xi, (x - {number(fe)}) / {number(k * crs._R)} AS eta FROM ({rows})"
    sql = f"SELECT * REPLACE (xi{minus('sin', 'cosh')} AS xi, eta{minus('cos', 'sinh')} AS eta) FROM ({sql})"
    sql = f"SELECT * EXCLUDE (xi, eta), atan2(sinh(eta), cos(xi)) AS lam, sin(xi) / sqrt(sinh(eta) * sinh(eta) + cos(xi) * cos(xi)) AS goal FROM ({sql})"
    sql, e = f"SELECT *, goal AS tau FROM ({sql})", number(crs._E)
    for _ in range(3):
        sql = f"SELECT *, sqrt(tau * tau + 1) AS root, sinh(atanh(tau / sqrt(tau * tau + 1) * {e}) * {e}) AS s FROM ({sql})"
        sql = f"SELECT * EXCLUDE s, tau * sqrt(s * s + 1) - s * root AS t FROM ({sql})"
        sql = f"SELECT * EXCLUDE (root, t) REPLACE (tau + (goal - t) / sqrt(t * t + 1) * ((tau * tau * {number(1 - crs._E**2)} + 1) / (root * {number(1 - crs._E**2)})) AS tau) FROM ({sql})"
    far, k, fe, fn = crs.PROJECTIONS[target]
    sql = f"SELECT * EXCLUDE (goal, tau, lam), atan(tau) AS phi, lam + radians({number(lon0 - far)}) AS lam FROM ({sql})"
    sql = f"SELECT * EXCLUDE phi, sinh(atanh(sin(phi)) - {e} * atanh({e} * sin(phi))) AS t FROM ({sql})"
    sql = f"SELECT * EXCLUDE (t, lam), atan2(t, cos(lam)) AS xi, asinh(sin(lam) / sqrt(t * t + cos(lam) * cos(lam))) AS eta FROM ({sql})"
    plus = lambda f, g: "".join(f" + {f}({2 * j} * xi) * {g}({2 * j} * eta) * {number(a)}" for j, a in enumerate(crs._ALPHA, 1))
    return f"SELECT * EXCLUDE (xi, eta), (eta{plus('cos', 'sinh')}) * {number(k * crs._R)} + {number(fe)} AS tx, (xi{plus('sin', 'cosh')}) * {number(k * crs._R)} + {number(fn)} AS ty FROM ({sql})"


def _zone_sheets(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Suppliers as sheets of EPSG 2178, 8 x 8 cells of 25 m; lines as their cells."""
    left, bottom = (F.lit(7_400_000.0) + F.col("s_suppkey") % 199 * 1000), (F.lit(5_450_000.0) + F.col("s_suppkey") % 601 * 1000)
    meta = _read(spark, sf, "supplier").select(F.col("s_suppkey").alias("plik"), F.lit(25.0).alias("res"), left.alias("left"), bottom.alias("bottom"), (left + 200).alias("right"), (bottom + 200).alias("top"))
    line = _read(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("plik"), (F.col("l_partkey") % 8).cast("int").alias("row"), (F.col("l_orderkey") % 8).cast("int").alias("col"))
    return meta, line.agg(F.max("l_quantity").alias("z"))


ZONE_SQL = f"""zone AS (SELECT s_suppkey AS plik, 7400000.0::DOUBLE + s_suppkey % 199 * 1000 AS l, 5450000.0::DOUBLE + s_suppkey % 601 * 1000 AS b FROM supplier),
edge AS (SELECT plik, CASE side WHEN 0 THEN l WHEN 1 THEN l + 200 ELSE l + 25.0::DOUBLE * i END AS x, CASE side WHEN 2 THEN b WHEN 3 THEN b + 200 ELSE b + 25.0::DOUBLE * i END AS y FROM zone, range(9) p(i), range(4) q(side)),
box AS (SELECT plik, floor(min(tx) / 25) * 25 AS nl, floor(min(ty) / 25) * 25 AS nb, ceil(max(tx) / 25) * 25 AS nr, ceil(max(ty) / 25) * 25 AS nt FROM ({_transform_sql("FROM edge", 2178, 2180)}) GROUP BY 1),
pixel AS (SELECT plik, row::INTEGER AS row, col::INTEGER AS col, nl + (col + 0.5::DOUBLE) * 25 AS x, nt - (row + 0.5::DOUBLE) * 25 AS y FROM box, range(20) p(row), range(20) q(col) WHERE row < (nt - nb) / 25 AND col < (nr - nl) / 25)"""


@_query("raster_reproject", f"""
WITH {ZONE_SQL}, back AS ({_transform_sql("FROM pixel", 2180, 2178)}), cell AS (SELECT l_suppkey AS plik, l_partkey % 8 AS srow, l_orderkey % 8 AS scol, max(l_quantity) AS z FROM lineitem GROUP BY ALL)
SELECT plik, row, col, z FROM (SELECT plik, row, col, floor((b + 200 - ty) / 25) AS srow, floor((tx - l) / 25) AS scol FROM back JOIN zone USING (plik)) JOIN cell USING (plik, srow, scol)""")
def raster_reproject(spark, sf):
    """Sheets of a zone on grids of the country's system, by the full series."""
    return mosaic.reprojected(*_zone_sheets(spark, sf), 2178, 2180, tolerance=None)[1]


@_query("raster_mesh", f"WITH {ZONE_SQL} SELECT plik, row, col, true AS near FROM pixel")
def raster_mesh(spark, sf):
    """J14 between the nodes of a mesh: every pixel is within the tolerance (here 1/100,000 of one) of its place by the series."""
    grids = mosaic.reprojected(*_zone_sheets(spark, sf), 2178, 2180)[0]
    placed = warp.centres(warp.mesh(grids, 2178, 2180, 1e-5), 2178, 2180, ("res", "left", "top"))
    exact = placed.withColumn("e", crs.moved_in_batches(F.col("left") + (F.col("col") + 0.5) * F.col("res"), F.col("top") - (F.col("row") + 0.5) * F.col("res"), 2180, 2178))
    return exact.select("plik", "row", "col", (F.greatest(F.abs(F.col("sx") - F.col("e.a")), F.abs(F.col("sy") - F.col("e.b"))) <= F.col("res") * 1e-5).alias("near"))


LAYOUT = chunks.Layout(64, 64, 16, ("z", "res_src"), "f8")


def _dense(spark, sf) -> DataFrame:
    """The yearly layers as dense chunks of 16 x 16 pixels."""
    return chunks.packed(_layers(spark, sf), LAYOUT)


@_query("chunk_read", f"SELECT rok, (row // 16)::INTEGER AS \"by\", (col // 16)::INTEGER AS bx, row, col, z::DOUBLE AS z, res_src::DOUBLE AS res_src FROM ({LAYERS_SQL})")
def chunk_read(spark, sf):
    """Pixels packed into chunks, and read back."""
    return chunks.cells(_dense(spark, sf), LAYOUT)


@_query("chunk_ranges", f"SELECT rok, (row // 16)::INTEGER AS \"by\", (col // 16)::INTEGER AS bx, count(*) AS n, min(z)::DOUBLE AS low, max(z)::DOUBLE AS high FROM ({LAYERS_SQL}) GROUP BY ALL")
def chunk_ranges(spark, sf):
    return _dense(spark, sf).select("rok", "by", "bx", "n", "low", "high")


@_query("chunk_coverage", f"WITH l AS ({LAYERS_SQL}) SELECT rok, count(*)::DOUBLE / (SELECT count(*) FROM (SELECT DISTINCT col, row FROM l)) AS coverage FROM l GROUP BY 1")
def chunk_coverage(spark, sf):
    """A10, A11 from masks."""
    return chunks.coverage(_dense(spark, sf))


@_query("chunk_changes", ORACLE_SQL["year_change_share"])
def chunk_changes(spark, sf):
    """A9, J16 from chunks of neighbouring layers."""
    return chunks.change_shares(_dense(spark, sf), LAYOUT, "rok")


@_query("chunk_level", f"""
WITH l AS ({LAYERS_SQL}), t AS (SELECT DISTINCT rok, tr::INTEGER AS tr, tc::INTEGER AS tc FROM l, range(4) a(i), range(4) b(j), LATERAL (SELECT row // 4 + i - 2 AS tr, col // 4 + j - 2 AS tc) WHERE tr BETWEEN 0 AND 15 AND tc BETWEEN 0 AND 15),
d AS (SELECT l.rok, tr, tc, z, abs((row + 0.5::DOUBLE) / 4 - 0.5::DOUBLE - tr) AS dr, abs((col + 0.5::DOUBLE) / 4 - 0.5::DOUBLE - tc) AS dc FROM l JOIN t ON l.rok = t.rok AND row BETWEEN tr * 4 - 4 AND tr * 4 + 7 AND col BETWEEN tc * 4 - 4 AND tc * 4 + 7),
w AS (SELECT rok, tr, tc, sum((1 - dr) * (1 - dc) * z) AS wz, sum((1 - dr) * (1 - dc)) AS w FROM d WHERE dr < 1 AND dc < 1 GROUP BY ALL),
m AS (SELECT rok, row // 4 AS tr, col // 4 AS tc, max(res_src) AS res_src FROM l GROUP BY ALL)
SELECT rok, w.tr AS row, w.tc AS col, round_even(wz / w * 1000000.0::DOUBLE, 0) / 1000000.0::DOUBLE AS z, m.res_src FROM w LEFT JOIN m USING (rok, tr, tc)""")
def chunk_level(spark, sf):
    """A level of 4 x 4 pixels, blocks of 8 x 8 cells, kernels over the edges of chunks."""
    to = chunks.Layout(16, 16, 8, ("z", "res_src"), "f8")
    return chunks.cells(chunks.level(_dense(spark, sf), LAYOUT, 4, "bilinear", to, None), to).select("rok", "row", "col", round_half_even(F.col("z"), 6).alias("z"), "res_src")


@_query("mosaic_ranked", f"""
WITH p AS (SELECT l_partkey % 64 AS col, l_suppkey % 64 AS row, o_orderdate AS d, o_orderkey AS k, min(l_quantity) AS z FROM lineitem JOIN (SELECT o_orderkey, min(o_orderdate) AS o_orderdate FROM orders GROUP BY 1) ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT row::INTEGER AS row, col::INTEGER AS col, arg_max(z, struct_pack(d := d, k := k)) AS z FROM p GROUP BY ALL""")
def mosaic_ranked(spark, sf):
    """W1 as the layer is built: orders are sheets, ranked once by date and key; pixels carry ranks."""
    sheets = _read(spark, sf, "orders").groupBy("o_orderkey").agg(F.min("o_orderdate").alias("d"))
    ranks = catalog.dense_ordinals(sheets, ["d", "o_orderkey"], "rank_").select(F.col("o_orderkey").alias("l_orderkey"), F.col("rank_").cast("long"))
    cell = _read(spark, sf, "lineitem").select("l_orderkey", (F.col("l_partkey") % 64).cast("int").alias("col"), (F.col("l_suppkey") % 64).cast("int").alias("row"), F.col("l_quantity").alias("z"))
    once = cell.groupBy("l_orderkey", "row", "col").agg(F.min("z").alias("z"))
    return mosaic.first_ranked(once.join(ranks, "l_orderkey"), ["row", "col"])


@_query("box_classes", f"""
WITH k AS ({BOXES_SQL}), e AS (SELECT *, least(x1, x2) AS el, greatest(x1, x2) AS er, least(y1, y2) AS eb, greatest(y1, y2) AS et FROM {EDGES_SQL}),
c AS (SELECT s_suppkey, l, b, r, t, (x2 - x1) * (b - y1) - (y2 - y1) * (l - x1) AS p, (x2 - x1) * (t - y1) - (y2 - y1) * (l - x1) AS q, (x2 - x1) * (b - y1) - (y2 - y1) * (r - x1) AS u, (x2 - x1) * (t - y1) - (y2 - y1) * (r - x1) AS v
  FROM k JOIN e ON el <= r AND er >= l AND eb <= t AND et >= b),
m AS (SELECT DISTINCT s_suppkey FROM c WHERE least(p, q, u, v) <= 0 AND greatest(p, q, u, v) >= 0)
SELECT s_suppkey, CASE WHEN s_suppkey IN (FROM m) THEN 'boundary' WHEN (SELECT count(*) FROM {EDGES_SQL} WHERE (y1 > (b + t) / 2) <> (y2 > (b + t) / 2) AND (l + r) / 2 < (x2 - x1) * ((b + t) / 2 - y1) / (y2 - y1) + x1) % 2 = 1 THEN 'inside' ELSE 'outside' END AS place FROM k""")
def box_classes(spark, sf):
    """Boxes inside, outside and on the boundary of the polygon."""
    return geometry.classed(_boxes(spark, sf), RINGS, ["s_suppkey"]).select("s_suppkey", "place")


@_query("archives_without", "SELECT l_orderkey AS archive FROM lineitem GROUP BY 1 HAVING bool_and(l_returnflag <> 'N')")
def archives_without(spark, sf):
    """Orders are archives, their lines members, whose names end as sheet texts do where nothing came back."""
    ending = F.when(F.col("l_returnflag") == "N", F.concat("l_linestatus", F.lit(".ASC"))).otherwise(F.lit("scan.pdf"))
    found = _read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("archive"), ending.alias("member"), F.lit(None).cast("string").alias("error"))
    return archive.without_ascii(found)


@_query("sheet_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, coalesce(p.p_size, s.n, 2180)::INTEGER AS epsg, coalesce(p.p_brand, s.s_name) AS akt_data FROM lineitem
LEFT JOIN (SELECT p_partkey, p_size, p_brand FROM part WHERE p_size <= 25) p ON p_partkey = l_partkey LEFT JOIN (SELECT s_suppkey, s_nationkey AS n, s_name FROM supplier WHERE s_acctbal > 0) s ON s_suppkey = l_suppkey""")
def sheet_lookup(spark, sf):
    """CRS and date of a line by its part, else by its supplier, else 2180 and none."""
    part = _read(spark, sf, "part").where("p_size <= 25").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("plik"), F.col("p_size").cast("int").alias("epsg"), F.col("p_brand").alias("akt_data"))
    supplier = _read(spark, sf, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("plik"), F.col("s_nationkey").cast("int").alias("epsg"), F.col("s_name").alias("akt_data"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = _read(spark, sf, "lineitem").select(*keys, F.concat(F.lit("p"), F.col("l_partkey")).alias("member"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("archive"))
    return convert.described(rows, part.union(supplier)).select(*keys, "epsg", "akt_data")
