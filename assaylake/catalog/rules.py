"""One query per rule of the library, and the ways a rule can be written."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.catalog.inputs import (
    CATALOG_RULES,
    LINES_SQL,
    VIOLATION,
    check,
    lines,
    union_sql,
    violation_sql,
)
from assaylake.sources.metadata import Feed, Rule, frame
from assaylake.sources.tables import table


def _one(df, feed: Feed, **kwargs):
    return check(df, [feed], **kwargs).results.select(*VIOLATION)


def labelled(spark, folder):
    """Documents with their quality label; many documents have none."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return table(spark, folder, "documents").select("doc_id", "source", "lang").join(labels, "doc_id", "left")


def not_null(spark, folder):
    feed = Feed(1, "BRONZE", "TEXTS", 2, "documents", "doc_id", None, "quality", "Y")
    return _one(labelled(spark, folder), feed)


def length(spark, folder):
    feeds = [
        Feed(2, "BRONZE", "PARTS", 4, "part", "p_partkey", None, "p_size", "N"),
        Feed(3, "BRONZE", "PARTS", 5, "part", "p_partkey", None, "p_name", "N"),
        Feed(4, "BRONZE", "PARTS", 6, "part", "p_partkey", None, "p_name", "Y"),
    ]
    return check(table(spark, folder, "part"), feeds).results.select(*VIOLATION)


def taxed(spark, folder):
    """Customers with a tax number in the usual form, without dashes, or missing."""
    digits = [F.substring("c_name", *at) for at in ((10, 3), (13, 2), (15, 4))]
    number = (
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(*digits))
        .otherwise(F.concat_ws("-", *digits))
    )
    return table(spark, folder, "customer").select("c_custkey", number.alias("tin"))


def tax_format(spark, folder):
    return _one(taxed(spark, folder), Feed(5, "BRONZE", "CUSTOMERS", 7, "customer", "c_custkey", None, "tin", "Y"))


def upper(spark, folder):
    feeds = [
        Feed(6, "BRONZE", "PARTS", 8, "part", "p_partkey", None, "p_name", "N"),
        Feed(7, "BRONZE", "PARTS", 8, "part", "p_partkey", None, "p_type", "Y"),
    ]
    return check(table(spark, folder, "part"), feeds).results.select(*VIOLATION)


def timeliness(spark, folder):
    feed = Feed(8, "BRONZE", "SALES", 9, "orders", "o_orderkey", None, "o_orderdate", "N")
    return _one(table(spark, folder, "orders"), feed)


def in_list(spark, folder):
    feed = Feed(9, "BRONZE", "PARTS", 101, "part", "p_partkey", None, "p_brand", "Y",
                dq_rule_input_where_col="'Brand#1','Brand#2','Brand#3'")
    return _one(table(spark, folder, "part"), feed)


def like(spark, folder):
    """E-mail form of a contact text; customers in debt left only their name."""
    name = F.lower("c_name")
    contact = F.when(F.col("c_acctbal") < 0, name).otherwise(F.concat(name, F.lit("@"), "c_mktsegment", F.lit(".example")))
    df = table(spark, folder, "customer").select("c_custkey", contact.alias("contact"))
    return _one(df, Feed(10, "BRONZE", "CUSTOMERS", 102, "customer", "c_custkey", None, "contact", "N"))


def pattern(spark, folder):
    feed = Feed(11, "BRONZE", "WEB", 111, "pages", "page_id", None, "url", "Y",
                dq_rule_input_where_col="'^https://[a-z.]+/[a-z]{2}/[0-9]+$'")
    return _one(table(spark, folder, "pages"), feed)


DUPLICATE = Feed(12, "BRONZE", "SALES", 1, "lineitem", "row_key", "l_shipdate", "l_orderkey,l_linenumber", "Y")


def duplicate(spark, folder):
    return _one(lines(spark, folder), DUPLICATE)


def duplicate_text(spark, folder):
    """Documents that repeat the text of a document with a higher id."""
    df = table(spark, folder, "documents").select("doc_id", F.md5("text").alias("text_hash"))
    return _one(df, Feed(13, "BRONZE", "TEXTS", 1, "documents", "doc_id", None, "text_hash", "N"))


def lookup(spark, folder):
    feed = Feed(14, "BRONZE", "TEXTS", 3, "documents", "doc_id", None, "doc_id", "N",
                dq_rule_input_join_tbl="labels", dq_rule_input_join_col="doc_id", dq_rule_input_where_col="quality")
    return _one(table(spark, folder, "documents"), feed, tables={"labels": table(spark, folder, "labels")})


def ref_integrity(spark, folder):
    """Orders must belong to a customer without debt."""
    solvent = table(spark, folder, "customer").filter("c_acctbal >= 0")
    feed = Feed(15, "BRONZE", "SALES", 10, "orders", "o_orderkey", None, "o_custkey", "Y",
                dq_rule_input_join_tbl="customer", dq_rule_input_join_col="c_custkey")
    return _one(table(spark, folder, "orders"), feed, tables={"customer": solvent})


def multi_column(spark, folder):
    feeds = [
        Feed(16, "BRONZE", "SALES", 112, "lineitem", "row_key", None, "l_quantity,l_discount", "Y"),
        Feed(17, "BRONZE", "SALES", 113, "lineitem", "row_key", None, "l_returnflag,l_linestatus", "N"),
    ]
    found = check(lines(spark, folder), feeds).results
    shown = F.when(F.col("feed_id") == 17, F.col("record_value")).alias("record_value")  # no text of doubles
    return found.select(*[shown if c == "record_value" else c for c in VIOLATION])


def sql_feed(spark, folder):
    feed = Feed(18, "BRONZE", "SALES", 114, "lineitem", "row_key", None, "l_orderkey", "N",
                dq_rule_input_join_tbl="orders")
    return _one(lines(spark, folder), feed, tables={"orders": table(spark, folder, "orders")})


def sql_template(spark, folder):
    feed = Feed(19, "BRONZE", "PARTS", 116, "part", "p_partkey", None, "p_brand", "Y")
    return check(table(spark, folder, "part"), [feed]).results.select(*VIOLATION, "dq_check_sql")


BROKEN_RULES = [
    *CATALOG_RULES,
    Rule(901, 6, "BAD_Function", "", "no_such_function(${INPUT1})", "SIMPLE"),
    Rule(902, 6, "BAD_Token", "", "${NO_TOKEN} = 1", "SIMPLE"),
    Rule(903, 6, "BAD_Kind", "", "true", "STRANGE"),
]
BROKEN_FEEDS = [
    Feed(21, "BRONZE", None, 101, "part", "p_partkey", None, "p_brand", "Y",
         dq_rule_input_where_col="'Brand#1','Brand#2'"),
    Feed(22, "BRONZE", None, 2, "part", "p_partkey", None, "no_such_column", "Y"),
    Feed(23, "BRONZE", None, 901, "part", "p_partkey", None, "p_brand", "Y"),
    Feed(24, "BRONZE", None, 902, "part", "p_partkey", None, "p_brand", "Y"),
    Feed(25, "BRONZE", None, 903, "part", "p_partkey", None, "p_brand", "Y"),
    Feed(26, "BRONZE", None, 3, "part", "p_partkey", None, "p_brand", "Y", dq_rule_input_join_tbl="absent",
         dq_rule_input_join_col="x"),
]


def feed_errors(spark, folder):
    """Bad feeds are logged as failed, the good one still counts its violations."""
    outcome = check(table(spark, folder, "part"), BROKEN_FEEDS, rules=BROKEN_RULES)
    good = outcome.results.groupBy("feed_id").agg(F.count(F.lit(1)).alias("violation_count"))
    bad = frame(spark, [(c.feed.feed_id, "Fail", 0) for c, _ in outcome.errors],
                "feed_id bigint, status string, violation_count bigint")
    return good.select("feed_id", F.lit("Success").alias("status"), "violation_count").unionByName(bad)


_EVIDENCE = (
    "SELECT * FROM part WHERE TRUE AND ((CASE WHEN length(trim(CAST(`p_brand` AS STRING))) > 7 "
    "THEN 'FAIL' ELSE 'PASS' END) = 'FAIL')"
).replace("'", "''")
_LABELLED = "documents LEFT JOIN labels USING (doc_id)"
_TAXED = (
    "(SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN substr(c_name, 10, 9) "
    "ELSE substr(c_name, 10, 3) || '-' || substr(c_name, 13, 2) || '-' || substr(c_name, 15, 4) END AS tin "
    "FROM customer) AS c"
)
_CONTACT = (
    "(SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lower(c_name) "
    "ELSE lower(c_name) || '@' || c_mktsegment || '.example' END AS contact FROM customer) AS c"
)

QUERIES = {
    "dq_not_null": (not_null, violation_sql(
        "documents", 2, 1, "doc_id", "quality", "FAIL", _LABELLED, "trim(coalesce(CAST(quality AS VARCHAR), '')) = ''")),
    "dq_length": (length, union_sql(
        violation_sql("part", 4, 2, "p_partkey", "p_size", "PASS-SOFT", "part",
                      "length(trim(CAST(p_size AS VARCHAR))) <> 2"),
        violation_sql("part", 5, 3, "p_partkey", "p_name", "PASS-SOFT", "part", "length(trim(p_name)) <> 9"),
        violation_sql("part", 6, 4, "p_partkey", "p_name", "FAIL", "part", "length(trim(p_name)) <> 10"))),
    "dq_format": (tax_format, violation_sql(
        "customer", 7, 5, "c_custkey", "tin", "FAIL", _TAXED,
        "NOT coalesce(substr(tin, 4, 1) = '-' AND substr(tin, 7, 1) = '-' "
        "AND length(replace(tin, '-', '')) = 9, false)")),
    "dq_upper": (upper, union_sql(
        violation_sql("part", 8, 6, "p_partkey", "p_name", "PASS-SOFT", "part", "p_name <> upper(p_name)"),
        violation_sql("part", 8, 7, "p_partkey", "p_type", "FAIL", "part", "p_type <> upper(p_type)"))),
    "dq_timeliness": (timeliness, violation_sql(
        "orders", 9, 8, "o_orderkey", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "PASS-SOFT", "orders",
        "date_diff('day', o_orderdate, TIMESTAMP '2001-12-01 00:00:00') > 365")),
    "dq_in_list": (in_list, violation_sql(
        "part", 101, 9, "p_partkey", "p_brand", "FAIL", "part", "p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')")),
    "dq_like": (like, violation_sql(
        "customer", 102, 10, "c_custkey", "contact", "PASS-SOFT", _CONTACT, "contact NOT LIKE '%@%.%'")),
    "dq_pattern": (pattern, violation_sql(
        "pages", 111, 11, "page_id", "url", "FAIL", "pages",
        "NOT regexp_matches(url, '^https://[a-z.]+/[a-z]{2}/[0-9]+$')")),
    "dq_duplicate": (duplicate, violation_sql(
        "lineitem", 1, 12, "row_key", "l_orderkey || ', ' || l_linenumber", "FAIL", LINES_SQL,
        "true QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY l_shipdate DESC, row_key DESC) > 1")),
    "dq_duplicate_text": (duplicate_text, violation_sql(
        "documents", 1, 13, "doc_id", "md5(text)", "PASS-SOFT", "documents",
        "true QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id DESC) > 1")),
    "dq_lookup": (lookup, violation_sql(
        "documents", 3, 14, "doc_id", "doc_id", "PASS-SOFT", _LABELLED, "quality IS NULL")),
    "dq_ref_integrity": (ref_integrity, violation_sql(
        "orders", 10, 15, "o_orderkey", "o_custkey", "FAIL",
        "orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) AS c ON o_custkey = c_custkey",
        "c_custkey IS NULL")),
    "dq_multi_column": (multi_column, union_sql(
        violation_sql("lineitem", 112, 16, "row_key", "NULL", "FAIL", LINES_SQL, "l_quantity * l_discount > 4"),
        violation_sql("lineitem", 113, 17, "row_key", "l_returnflag || ', ' || l_linestatus", "PASS-SOFT", LINES_SQL,
                      "l_returnflag = 'R' AND l_linestatus = 'O'"))),
    "dq_sql_feed": (sql_feed, violation_sql(
        "lineitem", 114, 18, "row_key", "l_orderkey", "PASS-SOFT",
        LINES_SQL + " JOIN orders ON l_orderkey = o_orderkey", "l_shipdate < o_orderdate")),
    "dq_sql_template": (sql_template, "SELECT *, '" + _EVIDENCE + "' AS dq_check_sql FROM (" + violation_sql(
        "part", 116, 19, "p_partkey", "p_brand", "FAIL", "part", "length(trim(p_brand)) > 7") + ")"),
    "dq_feed_errors": (feed_errors, (
        "SELECT CAST(21 AS BIGINT) AS feed_id, 'Success' AS status, count(*) AS violation_count FROM part "
        "WHERE p_brand NOT IN ('Brand#1', 'Brand#2') UNION ALL "
        "SELECT CAST(f AS BIGINT), 'Fail', CAST(0 AS BIGINT) FROM (VALUES (22), (23), (24), (25), (26)) AS v(f)")),
}
