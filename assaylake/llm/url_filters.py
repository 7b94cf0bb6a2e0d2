"""URL filters: host suffixes and path prefixes against a rule table.

Each URL is expanded into (host suffix, path prefix) expressions. Their digests meet the rules in
an equi-join on a short hash prefix; the full digest then confirms a hit, and the longest rule wins.
Only prefix lengths and label counts that some rule has are expanded, so a URL yields at most
(rule label counts) x (rule path lengths) expressions, whatever its own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import LOWER, UPPER
from assaylake.sources.tables import table

PREFIX_HEX = 8  # characters of the digest that the join compares
BROADCAST_RULES = 50_000  # up to so many rules go to every executor; more are joined by a shuffle
ALLOW, BLOCK = "allow", "block"

# The rules of the registered query (verdict, host, path).
RULES = [
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without `://`."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """One row per (host, path) with its digest; NULL parts are empty, `block` wins over `allow`."""
    part = lambda name: F.coalesce(F.col(name), F.lit("")).alias(f"rule_{name}")
    unique = rules.select(part("host"), part("path"), "verdict").groupBy("rule_host", "rule_path")
    return unique.agg(F.max("verdict").alias("rule_verdict")).withColumn(
        "rule_digest", _digest(F.col("rule_host"), F.col("rule_path"))
    )


def judge(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
    default: str = ALLOW, broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of `pages`.

    `rules` has (host, path, verdict). A rule fits its host and all subdomains if the path starts
    with the rule's path. Of several the longest expression wins, then the longer host, then `block`.
    NULL and unparsable URLs have an empty host and path and get `default`; so do pages without a
    rule. Repeated rows come back as often as they were given; other columns are ignored. An empty
    table gives an empty result.
    """
    known = rule_table(rules)
    shape = known.select(
        F.length("rule_path").alias("n"), F.size(F.split("rule_host", r"\.")).alias("labels")
    ).distinct().collect()  # one row per pair of lengths that rules have
    path_lengths = sorted({r["n"] for r in shape}) or [0]
    labels = max((r["labels"] for r in shape), default=1)
    count = known.count()

    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    rows = rows.withColumns({"host": host, "path": path})
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(parts) - labels + 1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, path_lengths)), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(
        h.alias("host"), p.alias("path")))))
    nothing = F.struct(F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))
    expressions = rows.select("*", F.explode(F.concat(F.array(nothing), pairs)).alias("e"))
    expressions = expressions.withColumn("digest", _digest(F.col("e.host"), F.col("e.path")))
    short = lambda name: F.substring(name, 1, PREFIX_HEX)
    candidates = known.withColumn("rule_short", short("rule_digest"))
    if count <= broadcast_rules:
        candidates = F.broadcast(candidates)
    joined = expressions.withColumn("short", short("digest")).join(
        candidates, F.col("short") == F.col("rule_short"), "left")
    sure = (F.col("digest") == F.col("rule_digest")) & (F.col("e.host") == F.col("rule_host"))
    text = F.concat("rule_host", "rule_path")
    found = F.when(sure & (F.col("e.path") == F.col("rule_path")), F.struct(
        F.length(text).alias("n"), F.length("rule_host").alias("h"), F.col("rule_verdict").alias("verdict"),
        text.alias("rule")))
    best = joined.groupBy("id", "url", "host", "path").agg(
        F.max(found).alias("best"), F.count_if(F.col("e.host").isNull()).alias("copies"))
    return best.select(
        F.col("id").alias(id_column), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge(table(spark, folder, "pages"), rules)


OP3_SQL = """
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rest AS (
  SELECT row_number() OVER () AS n, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT n, page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
SELECT p.page_id, p.host, p.path, q.host || q.path AS rule, coalesce(q.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN rules q
  ON (p.host = q.host OR ends_with(p.host, '.' || q.host)) AND starts_with(p.path, q.path)
QUALIFY row_number() OVER (PARTITION BY p.n ORDER BY length(q.host) + length(q.path) DESC NULLS LAST) = 1
"""
