"""Operator 7, URL filter [native]: pattern rules indexed by their rarest literal token.

A rule is ``host/path``: it fits the host and its subdomains when the path starts with the rule's; ``*`` stands for
any characters. Its literal tokens are the host labels and the complete path segments without ``*``. All URLs are
counted once for the tokens that occur in rules, each rule is filed under its rarest one, and the tokens of a URL
fetch candidates; only these run regular expressions. Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm.common import fresh_name, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rule lists above this many entries are joined by shuffle instead of broadcast (about 200 bytes an entry).
BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    """``tier`` 0 outranks tier 1; inside a tier the longest rule wins, then block, then the rule's text."""

    pattern: str
    verdict: str
    tier: int = 0


CONTRACT_RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)
#: The method's own verdict where no rule above fits: these patterns block, everything else is allowed.
METHOD_RULES = (
    Rule("spam-farm.*/", "block", 1),
    Rule("cheap-pills.*/", "block", 1),
    Rule("casino-*/", "block", 1),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def _tokens(host: Column, path: Column, whole_last: bool) -> Column:
    """``h:`` labels and ``p:`` segments; a rule's last segment is a prefix and so no token."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.split(path, "/")
    if not whole_last:
        parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.array_distinct(F.concat(labels, F.transform(parts, lambda x: F.concat(F.lit("p:"), x))))


def _quoted(pattern: Column) -> Column:
    return F.replace(F.regexp_replace(pattern, r"([\p{Punct}&&[^*]])", r"\\$1"), F.lit("*"), F.lit(".*"))


def _rule_frame(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    rows = spark.createDataFrame([(r.pattern, r.verdict, r.tier) for r in rules], "rule string, rule_verdict string, tier int")
    host, path = F.substring_index("rule", "/", 1), F.substr(F.col("rule"), F.instr("rule", "/"))
    return rows.select(
        "rule", "rule_verdict", "tier",
        F.filter(_tokens(host, path, whole_last=False), lambda t: (F.length(t) > 2) & ~t.contains("*")).alias("literals"),
        F.concat(F.lit(r"(?s)^(.*\.)?"), _quoted(host), F.lit("$")).alias("host_regex"),
        F.concat(F.lit("(?s)^"), _quoted(path)).alias("path_regex"),
    )


def filter_urls(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = CONTRACT_RULES + METHOD_RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, ``tier`` to every row; clashing names get an underscore.

    ``rule`` is the winning pattern of either tier and null if none fits, which allows the page. Null, empty and
    malformed urls have empty host and path and no rule; they take no part in the join, and neither does a long url's
    query or fragment. Equal urls get equal results, so rows may repeat; each distinct (host, path) is judged once,
    after a combining distinct, which keeps a hot url from weighing on one task. Ties of rules: see ``Rule``. An empty
    table gives no rows.
    """
    spark = pages.sparkSession
    names = {n: fresh_name(pages, n) for n in ("host", "path", "rule", "verdict", "tier")}
    # Rows without a host get keys that no host has, so that they do not meet in one task.
    nowhere = F.concat(F.lit("/"), F.pmod(F.xxhash64(*pages.columns), F.lit(10_000)).cast("string"))
    found = fresh_name(pages, "found")
    keys = [f"{found}_host", f"{found}_path"]
    source = pages.withColumns({names["host"]: host_of(F.col(url)), names["path"]: path_of(F.col(url))})
    source = source.withColumns({keys[0]: F.when(F.col(names["host"]) != "", F.col(names["host"])).otherwise(nowhere), keys[1]: F.col(names["path"])})
    kinds = source.where(F.col(names["host"]) != "").select(F.col(names["host"]).alias("host"), F.col(names["path"]).alias("path")).distinct()
    tokens = kinds.select("host", "path", F.explode(F.concat(_tokens(F.col("host"), F.col("path"), True), F.array(F.lit("")))).alias("token"))
    small = F.broadcast if len(rules) <= BROADCAST_RULES else lambda df: df
    frame = _rule_frame(spark, rules)
    literals = frame.select(F.explode("literals").alias("token")).distinct()
    counts = tokens.join(small(literals), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        frame.select("rule", "tier", F.explode_outer("literals").alias("token"))
        .join(counts, "token", "left")
        .groupBy("rule", "tier")
        .agg(F.coalesce(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")), F.lit("")).alias("token"))
    )
    index = frame.join(rarest, ["rule", "tier"]).drop("literals")
    fits = F.rlike("host", "host_regex") & F.rlike("path", "path_regex")
    best = F.max(F.struct(-F.col("tier"), F.length("rule"), F.col("rule_verdict") == "block", "rule", "rule_verdict", "tier"))
    judged = tokens.join(small(index), "token").where(fits).groupBy("host", "path").agg(best.alias(found)).withColumnsRenamed({"host": keys[0], "path": keys[1]})
    return source.join(judged, keys, "left").select(
        *pages.columns, names["host"], names["path"],
        F.col(f"{found}.rule").alias(names["rule"]), F.coalesce(F.col(f"{found}.rule_verdict"), F.lit("allow")).alias(names["verdict"]), F.col(f"{found}.tier").alias(names["tier"]),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of ``pages``; ``rule`` names only the contract's rules, the method's own patterns leave it null."""
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", F.when(F.col("tier") == 0, F.col("rule")).alias("rule"), "verdict")


SQL = r"""
WITH split_url AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM split_url
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN starts_with(path, '/') AND (host LIKE 'spam-farm.%' OR host LIKE '%.spam-farm.%' OR host LIKE 'cheap-pills.%'
                 OR host LIKE '%.cheap-pills.%' OR host LIKE 'casino-%' OR host LIKE '%.casino-%') THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""
