"""Benchmark decontamination: test n-grams against every window of the training documents.

The benchmark's distinct windows form a hash set that is broadcast if its counted size is within a
bound. Documents become rows of ten neighbouring words inside generated code; a 64-bit key finds
candidate windows, and the windows' exact words then decide. Only header rows and hits are shuffled.
No Python runs here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import LOWER, UPPER, fields, matching, small, text_of, whole_rows
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000  # windows, and
BROADCAST_BYTES = 64_000_000  # bytes of their words, up to which the set goes to every executor

# Everything in ASCII that is not a digit or letter separates words. Listed one by one,
# so that the regular expression engine uses a bit table.
_BETWEEN = [i for i in range(128) if not chr(i).isalnum()]
BETWEEN = "[" + "".join(f"\\x{i:02X}" for i in _BETWEEN) + "]+"


def words_of(text: Column) -> Column:
    """Words in their own case; the contract's A-Z lower-casing changes no border between words."""
    return F.array_remove(F.split(text_of(text), BETWEEN), "")


def plain(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _key(words: list[Column]) -> Column:
    """Candidate key: lower() is much cheaper than translating and only merges more."""
    return F.xxhash64(*[F.lower(w) for w in words])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, n, words): each item's windows, lower-cased and joined by spaces, n words each.

    An item of fewer than `window` words is one window; an item without words has none.
    """
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    places = items.select("item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i"))
    own = F.slice("w", F.col("i"), F.col("n"))
    key = _key([F.get(own, F.lit(k)) for k in range(window)])
    return places.select("item_id", "n", key.alias("key"), plain(F.array_join(own, " ")).alias("words"))


def hits(docs: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, h, n_words, copies, spans, found): one row per different (doc_id, text).

    `spans` has (place, words) of every window hit, `found` the windows, `copies` the number of equal rows.
    """
    sizes = windows.groupBy("n").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("words")).alias("bytes")).collect()
    lengths = sorted(r["n"] for r in sizes) or [window]
    known = windows.select("n", "key", "words").distinct().groupBy("n", "key").agg(F.collect_list("words").alias("windows"))
    known = known.select(F.col("n").alias("known_n"), F.col("key").alias("known_key"), "windows")
    if sum(r["rows"] for r in sizes) <= BROADCAST_WINDOWS and sum(r["bytes"] for r in sizes) <= BROADCAST_BYTES:
        known = F.broadcast(known)

    shortest = lengths[0]
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), words_of(F.col("text")).alias("w"))
    count = F.greatest(F.size("w") - (shortest - 1), F.lit(0))
    # Column k holds the words k places on; where a column is shorter it is padded with NULL.
    zipped = F.arrays_zip(*[F.slice("w", k + 1, F.least(count, F.greatest(F.size("w") - k, F.lit(0)))).alias(f"w{k}")
                            for k in range(lengths[-1])])
    placed = rows.select("doc_id", "h", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(zipped).alias("place", "v"))
    words = [F.col(f"v.w{k}") for k in range(lengths[-1])]
    if len(lengths) == 1:
        keyed = placed.select("*", F.lit(shortest).alias("n"), _key(words[:shortest]).alias("key"))
    else:
        keys = F.array(*[F.struct(F.lit(n).alias("n"), _key(words[:n]).alias("key")) for n in lengths])
        keyed = placed.select("*", F.inline(keys))
    joined = keyed.join(known, (F.col("key") == F.col("known_key")) & (F.col("n") == F.col("known_n")), "left")
    own = plain(F.array_join(F.slice(F.array(*words), F.lit(1), F.col("n")), " "))
    enough = F.size(F.filter(F.slice(F.array(*words), F.lit(1), F.col("n")), lambda x: x.isNotNull())) == F.col("n")
    match = F.when(F.col("windows").isNotNull(), F.when(enough & F.array_contains("windows", own), own))
    header = F.coalesce(F.col("place"), F.lit(0)) == 0
    marked = joined.filter(header | F.col("windows").isNotNull()).select(
        "doc_id", "h", "n_words", match.alias("match"), "n", F.col("place").cast("long").alias("place"),
        (header & (F.col("n") == shortest)).alias("header"))
    return marked.groupBy("doc_id", "h", "n_words").agg(
        F.count_if("header").alias("copies"),
        F.collect_set(F.when(F.col("match").isNotNull(), F.struct("place", "n"))).alias("spans"),
        F.collect_set("match").alias("found"),
    )


def covered(spans: Column) -> Column:
    """Words inside the union of (place, n) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(state, span):
        stop = span.place + span.n
        fresh = F.greatest(stop - F.greatest(state.end, span.place), F.lit(0).cast("long"))
        return F.struct(F.greatest(state.end, stop).alias("end"), (state.total + fresh).alias("total"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda s: s.total)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated; and h, the text's hash.

    A word inside any occurrence of a benchmark window is hit. NULL and empty texts have no words.
    Items with a NULL id hit words but are not listed. Repeated rows come back as often as given; an
    empty benchmark hits nothing, empty documents give an empty result, other columns are ignored.
    """
    windows = written_table(benchmark_windows(benchmark, window).distinct())
    found = written_table(hits(docs, windows, window))  # read twice below
    items = found.select("doc_id", "h", F.explode("found").alias("words")).join(
        windows.filter("item_id is not null").select("words", F.col("item_id").cast("string").alias("item")), "words")
    listed = items.groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    joined = found.join(listed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    names = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = covered("spans")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "h",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without the contaminated ones, all columns kept.

    NULL and empty texts stay, as do NULL ids; rows that repeat an id and text stay or go together, all of
    them. An empty benchmark takes nothing away, empty documents give an empty result.
    """
    bad = report(docs, benchmark, window).filter("contaminated").select("doc_id", "h").distinct()
    return matching(whole_rows(docs), small(written_table(bad)), "left_anti").select(*fields(docs))


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with the hit words removed from `text`, each with what separates it from the word before.

    A text without a hit word, NULL and empty ones too, is as it was, and so are the other columns. Repeated
    rows all come back, cut alike; an empty table gives an empty result.
    """
    windows = written_table(benchmark_windows(benchmark, window).distinct())
    spans = hits(docs, windows, window).filter(F.size("spans") > 0).select("doc_id", "h", F.col("spans").alias("found"))
    joined = matching(whole_rows(docs), written_table(spans), "left")
    whole = F.col("row").getField("text")
    outside = "[^" + BETWEEN[1:-2] + "]+"
    tokens = F.regexp_extract_all(whole, F.lit(f"(?:{BETWEEN})?{outside}"), F.lit(0))
    kept = F.filter(tokens, lambda _, i: ~F.exists("found", lambda s: (i >= s.place) & (i < s.place + s.n)))
    text = F.when(F.col("found").isNull(), whole).otherwise(F.array_join(kept, ""))
    return joined.select(*fields(docs, text))


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return report(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("h")


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP1_SQL = f"""
WITH items AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
hits AS (
  SELECT DISTINCT p.r, p.i, s.n, s.item_id FROM (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM places, (SELECT DISTINCT n FROM windows) WHERE i + n - 1 <= len(w)) p
  JOIN windows s ON p.n = s.n AND p.words = s.words),
hit_words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (
  SELECT r, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""
