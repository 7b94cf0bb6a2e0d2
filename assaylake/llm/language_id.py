"""Language identification by Bayesian evidence fusion.

A naive Bayes model of byte trigrams gives text likelihoods. Grouped counts over all rows then give the
other evidence: how often a declared (markup) language and an address suffix go with each language, and
host priors that are smoothed towards the domain's, and those towards the whole corpus's. The posterior
is their product; rows without letters or without a clear winner are rejected.

Only the model is fitted on a sample: at most `sample` labelled documents per language, those with the
smallest hashes of their ids and texts. Counts and decisions cover every row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.llm.common import buffers, fields, matching, small, small_batches, steps, text_of, whole_rows
from assaylake.llm.url_filters import url_parts
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
SAMPLE = 400  # labelled documents per language for the text model
FIT_TASKS = 8  # tasks that count the sample's trigrams
CELLS = 1 << 14  # hashed trigrams
TEXT_WEIGHT = 60  # trigrams' worth of evidence that a text has at most: neighbours are not independent
SMOOTHING = 20.0  # rows' worth of the wider level's distribution
LEAST_POSTERIOR = 0.5

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_FOLD[48:58] = 48


def _cells(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram cell at each byte, and whether it lies within one text and has a letter."""
    codes = _FOLD[raw]
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 128)
    n = max(len(raw) - 2, 0)
    cells = (codes[:n] * np.uint32(0x9E3779B1) + codes[1 : n + 1] * np.uint32(0x85EBCA77)
             + codes[2 : n + 2] * np.uint32(0xC2B2AE3D))
    cells = (cells ^ (cells >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    usable = letter[:n] | letter[1 : n + 1] | letter[2 : n + 2]
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    return (cells >> np.uint32(18)).astype(np.int64), usable & (np.arange(n) + 2 < ends)


def fit(labelled: DataFrame, languages=LANGUAGES, sample: int = SAMPLE) -> np.ndarray:
    """log p(trigram | language), one column per language, from (doc_id, text, lang).

    Rows with another or no label are not used; of rows that repeat an id and text one is, and rows
    without an id are like others. A language without rows, like an empty table, gets an even distribution.
    """
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("place")
    marked = labelled.filter(F.col("lang").isin(*languages)).select("doc_id", "lang", "text", place)
    placed = written_table(marked.drop("text"))
    # Three times the sample by hash, of which the smallest are taken: few rows are ranked in one place.
    limit = F.lit(0).cast("long")
    for r in placed.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).collect():  # one row per language
        share = min(1.0, 3 * sample / r["n"])
        limit = F.when(F.col("lang") == r["lang"], F.lit(int(share * (2**63 - 1024)))).otherwise(limit)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    chosen = placed.filter(F.col("place") <= limit).distinct().withColumn("rank", rank).filter(F.col("rank") <= sample)
    # A fixed number of documents; each is used with all its text.
    small_batches(labelled.sparkSession)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("place").alias("_place"))
    same = (F.col("place") == F.col("_place")) & (F.col("lang") == F.col("_lang")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = marked.join(F.broadcast(chosen), same).dropDuplicates(["doc_id", "lang", "place"]).select("lang", "text")

    def count(batches):
        total = np.zeros((len(languages), CELLS), np.int64)
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for i, name in enumerate(languages):
                data, offsets = buffers(batch.column(1).filter(pa.array(names == name)))
                for a, b in steps(offsets):
                    cells, usable = _cells(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    total[i] += np.bincount(cells[usable], minlength=CELLS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(languages))), pa.array([t.tobytes() for t in total])], ["i", "counts"])

    counts = np.full((len(languages), CELLS), 0.5)
    # Each task of the sample sends counts of a fixed size, so there are only a few of them.
    for row in rows.coalesce(FIT_TASKS).mapInArrow(count, "i long, counts binary").collect():
        counts[row["i"]] += np.frombuffer(row["counts"], np.int64)
    return np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)


def text_scores(text: Column, model: np.ndarray) -> Column:
    """Array of log likelihoods per language (weighed by TEXT_WEIGHT); NULL for a text without letters."""

    @F.arrow_udf("array<double>")
    def apply(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        parts = []
        for a, b in steps(offsets):
            own = offsets[a : b + 1] - offsets[a]
            cells, usable = _cells(data[offsets[a] : offsets[b]], own)
            doc = np.repeat(np.arange(b - a), np.diff(own))[: len(cells)][usable]
            n = np.bincount(doc, minlength=b - a)
            weight = np.where(n > 0, np.minimum(n, TEXT_WEIGHT) / np.maximum(n, 1), np.nan)
            values = model[cells[usable]]
            parts.append(np.stack([np.bincount(doc, values[:, i], b - a) for i in range(model.shape[1])], axis=1) * weight[:, None])
        scores = np.concatenate(parts) if parts else np.zeros((0, model.shape[1]))
        missing = np.isnan(scores[:, 0]) if len(scores) else np.zeros(0, bool)
        k = model.shape[1]
        ends = np.arange(len(scores) + 1, dtype=np.int32) * k
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(scores.ravel()), mask=pa.array(missing))

    return apply(text_of(text))


def _posterior(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _sums(rows: DataFrame, key: str, k: int) -> DataFrame:
    """Per value of `key`: soft counts per language, combined before the shuffle."""
    return rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{key}")).agg(
        F.array(*[F.sum(F.col("p")[i]) for i in range(k)]).alias(f"n_{key}"))


def decide(scored: DataFrame, languages=LANGUAGES, least: float = LEAST_POSTERIOR) -> DataFrame:
    """`scored` has scores, declared, host, domain, suffix besides its own columns; adds language,
    confidence, text_language and kept. Missing evidence says nothing either way."""
    k = len(languages)
    soft = scored.filter("scores is not null").withColumn("p", _posterior(F.col("scores")))
    whole = [float(x or 0) for x in soft.agg(*[F.sum(F.col("p")[i]) for i in range(k)]).first()]
    share = [(x + 1) / (sum(whole) + k) for x in whole]
    corpus = F.array(*map(F.lit, share))

    rate = lambda n, prior: F.zip_with(n, prior, lambda a, b: (a + SMOOTHING * b) / (
        F.aggregate(n, F.lit(0.0), lambda s, x: s + x) + SMOOTHING))
    domains = _sums(soft, "domain", k).withColumn("domain_prior", rate(F.col("n_domain"), corpus)).drop("n_domain")
    hosts = _sums(soft.filter("host is not null"), "host", k)
    result = scored
    for name, values in (("domain", domains), ("host", hosts), ("declared", _sums(soft, "declared", k)),
                         ("suffix", _sums(soft, "suffix", k))):
        # Written first: Spark then knows the real size and broadcasts only what is small.
        result = result.join(written_table(values), F.col(name) == F.col(f"_{name}"), "left").drop(f"_{name}")
    domain_prior = F.coalesce("domain_prior", corpus)
    prior = F.when(F.col("n_host").isNotNull(), rate(F.col("n_host"), domain_prior)).otherwise(domain_prior)
    # p(language | value) over p(language): what the value adds to the corpus's distribution.
    adds = lambda n: F.zip_with(rate(n, corpus), corpus, lambda a, b: F.log(a / b))
    nothing = F.array(*[F.lit(0.0)] * k)
    total = F.transform(prior, lambda x: F.log(x))
    for part in (F.col("scores"), adds(F.col("n_declared")), adds(F.col("n_suffix"))):
        total = F.zip_with(total, F.coalesce(part, nothing), lambda a, b: a + b)
    names = F.array(*map(F.lit, languages))
    best = lambda p: F.get(names, (F.array_position(p, F.array_max(p)) - 1).cast("int"))
    fused = result.withColumn("_post", _posterior(total))
    sure = F.col("scores").isNotNull() & (F.array_max("_post") >= least)
    return fused.select(
        *[c for c in scored.columns if c not in ("scores", "domain")],
        F.when(sure, best(F.col("_post"))).otherwise(F.lit(UNKNOWN)).alias("language"),
        F.round(F.array_max("_post"), 4).alias("confidence"),
        F.when(F.col("scores").isNotNull(), best(F.col("scores"))).alias("text_language"), sure.alias("kept"))


def identify_documents(docs: DataFrame, model: np.ndarray, languages=LANGUAGES, least: float = LEAST_POSTERIOR) -> DataFrame:
    """(doc_id, h, declared, host, suffix, language, confidence, text_language, kept), one row per document.

    A document's `lang` is its declared language and its `source` its host; it has no address. NULLs
    there are missing evidence. A text without letters (NULL, empty, digits only) is rejected, as is one
    whose best language has a posterior under `least`. Repeated rows and ids are judged one by one, other
    columns are ignored; an empty table gives an empty result.
    """
    nothing = F.lit(None).cast("string")
    scored = docs.select(
        "doc_id", F.xxhash64("text", "lang", "source").alias("h"), F.col("lang").alias("declared"),
        F.col("source").alias("host"), nothing.alias("domain"), nothing.alias("suffix"),
        text_scores(F.col("text"), model).alias("scores"))
    return decide(written_table(scored), languages, least)


def page_text(html: Column) -> Column:
    """Text of a page: without comments, scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*+>", " "), r"&[A-Za-z#0-9]{1,10};", " ")


def identify_pages(pages: DataFrame, model: np.ndarray, languages=LANGUAGES, least: float = LEAST_POSTERIOR) -> DataFrame:
    """(page_id, declared, host, suffix, language, confidence, text_language, kept), one row per page.

    Declared is the primary part of the `lang` attribute of the html element, the suffix the host's last
    label, the domain its last two. Missing parts, like NULL pages and URLs, are missing evidence. Repeated
    rows are judged one by one; an empty table gives an empty result.
    """
    host = F.nullif(url_parts(F.col("url"))[0], F.lit(""))
    attribute = F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    rows = pages.select("page_id", F.nullif(F.lower(attribute), F.lit("")).alias("declared"), host.alias("host"),
                        page_text(F.col("html")).alias("text"))
    scored = rows.select(
        "page_id", "declared", "host", F.substring_index("host", ".", -2).alias("domain"),
        F.substring_index("host", ".", -1).alias("suffix"), text_scores(F.col("text"), model).alias("scores"))
    return decide(written_table(scored), languages, least)


def accepted(docs: DataFrame, languages=LANGUAGES, sample: int = SAMPLE) -> DataFrame:
    """`docs` (doc_id, text, lang, source) without the rejected ones, all columns kept.

    A text without letters goes, NULL and empty ones too. Rows that repeat an id, text, language and source
    stay or go together; NULLs in these are values. An empty table gives an empty result. Of languages with
    the same chance the one that is listed first counts.
    """
    found = identify_documents(docs, fit(docs, languages, sample), languages)
    bad = written_table(found.filter("not kept").select("doc_id", "h").distinct())
    return matching(whole_rows(docs, "text", "lang", "source"), small(bad), "left_anti").select(*fields(docs))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return identify_documents(docs, fit(docs)).drop("h", "suffix")


def pages_language(spark: SparkSession, folder: str) -> DataFrame:
    """The same operator on the pages, where markup and addresses speak as well."""
    return identify_pages(table(spark, folder, "pages"), fit(table(spark, folder, "documents")))
