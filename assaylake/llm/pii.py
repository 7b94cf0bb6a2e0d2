"""Information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Each valid one is a protected
entity. The corpus then says which terms give an entity away: for a term t near an entity e, the
pointwise mutual information log p(e,t) / (p(e) p(t)) is compared with the entity's own information
-log p(e). A term that carries nearly all of it is a span as well wherever it occurs. Most values come
once, so their evidence is pooled: by address domain, network, number prefix and issuer. How surely a term
names an entity is a smoothed estimate: it starts from the entity's own rate, or from PART_CHANCE for a
term that is a word of the mailbox, and different texts move it. No Python runs here.

Offsets come from the pieces between matches, summed per document; so a text may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.llm.common import fields, matching, text_of, whole_rows
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

# The kinds in their order. The patterns are the contract's; a match may start where a run
# of its first characters starts or where the match before ended, and repetitions do not give back, which
# changes no match but keeps the time in proportion to the text.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = "term"

CONTEXT = 80  # characters on each side of an entity whose terms count as near it
TERM_LETTERS = 4  # shortest term
PRIOR_TEXTS = 2.0  # texts' worth of the estimate to start from
PART_CHANCE = 0.5  # p(entity | term) to start from for a term that is part of the entity
LEAST_CHANCE = 0.5  # p(entity | term)
LEAST_SHARE = 0.9  # mutual information over the entity's own information
BROADCAST_TERMS = 100_000

_NOT_LETTERS = "[" + "".join(f"\\x{i:02X}" for i in range(128) if not chr(i).isalpha()) + "]+"
_LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"


def terms_of(text: Column) -> Column:
    """Lower-cased runs of letters (all characters outside ASCII count as letters)."""
    return F.filter(F.split(F.lower(text), _NOT_LETTERS), lambda w: F.length(w) >= TERM_LETTERS)


def _matches(text: Column, pattern: Column, number: int, possible: Column) -> Column:
    """Array of (kind, i, gap, hit, before, after) for one kind; empty where a cheap test excludes it."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    before, after = F.slice(gaps, F.lit(1), F.size(found)), F.slice(gaps, F.lit(2), F.size(found))
    rows = F.transform(F.arrays_zip(before.alias("b"), found.alias("h"), after.alias("a")), lambda r, i: F.struct(
        F.lit(number).alias("kind"), i.alias("i"), F.length(r.b).alias("gap"), r.h.alias("hit"),
        F.right(r.b, F.lit(CONTEXT + 1)).alias("before"), F.left(r.a, F.lit(CONTEXT + 1)).alias("after")))
    return F.when(possible & (F.size(found) > 0), rows)


def _valid(kind: Column, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]+", "")
    small = lambda p: (F.length(p) <= 2) | ((F.length(p) == 3) & (p <= "255"))
    byte_parts = F.forall(F.split(hit, r"\."), lambda p: small(F.ltrim(p, F.lit("0"))))
    card = F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return (F.when(kind == 1, byte_parts).when(kind == 2, F.coalesce(card, F.lit(False)))
            .when(kind == 3, F.length(digits).between(9, 15)).otherwise(True))


def _around(window: Window) -> tuple[Column, Column]:
    """The characters before and after a match, CONTEXT and one more, over neighbouring matches of its kind.

    Those are blanks here: they are spans of their own. A match and the gap after it have two characters at least."""
    most = CONTEXT // 2 + 1
    blank = F.repeat(F.lit(" "), F.least(F.length("hit"), F.lit(CONTEXT + 1)))
    earlier = F.array_join(F.collect_list(F.concat("before", blank)).over(window.rowsBetween(-most, -1)), "")
    later = F.array_join(F.collect_list(F.concat(blank, "after")).over(window.rowsBetween(1, most)), "")
    return (F.right(F.concat(earlier, "before"), F.lit(CONTEXT + 1)).alias("before"),
            F.left(F.concat("after", later), F.lit(CONTEXT + 1)).alias("after"))


def _located(docs: DataFrame, pattern: str | None = None) -> DataFrame:
    """(doc_id, h, kind, start, end, hit, before, after): valid spans of each different (doc_id, text).

    `docs` has doc_id, h, text and perhaps a column of own patterns per document.
    """
    text = F.col("text")
    digit, at = text.rlike("[0123456789]"), F.contains(text, F.lit("@"))
    tests = (at, digit & F.contains(text, F.lit(".")), digit, digit & F.contains(text, F.lit("+")))
    parts = [_matches(text, F.lit(PATTERNS[k]), n, tests[n]) for n, k in enumerate(KINDS)]
    if pattern:
        parts.append(_matches(text, F.col(pattern), len(KINDS), F.col(pattern).isNotNull()))
    arrays = F.flatten(F.filter(F.array(*parts), lambda x: x.isNotNull()))
    # Each task keeps one of its equal rows' matches before any is moved.
    rows = docs.select("doc_id", "h", F.inline(arrays)).dropDuplicates(["doc_id", "h", "kind", "i"])
    ordered = Window.partitionBy("doc_id", "h", "kind").orderBy("i")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("hit")
    start = F.coalesce(F.sum(F.col("gap") + length).over(before), F.lit(0)) + F.col("gap")
    placed = rows.select("doc_id", "h", "kind", "hit", start.cast("long").alias("start"), *_around(ordered))
    return placed.select("doc_id", "h", "kind", "start", (F.col("start") + length).alias("end"), "hit", "before",
                         "after").filter(_valid(F.col("kind"), F.col("hit")))


def _near(before: Column, after: Column) -> Column:
    """Terms of the context; a word that the context's border may cut is left out."""
    cut = lambda side, pattern: F.when(F.length(side) > CONTEXT, F.regexp_replace(side, pattern, "")).otherwise(side)
    return F.array_distinct(F.concat(terms_of(cut(before, f"^{_LETTER}+")), terms_of(cut(after, f"{_LETTER}+$"))))


def _entities(kind: Column, hit: Column) -> Column:
    """Names of the entity and of the wider one that pools it with others."""
    value, digits = F.lower(hit), F.regexp_replace(hit, "[^0-9]+", "")
    wider = (F.when(kind == 0, F.substring_index(value, "@", -1)).when(kind == 1, F.substring_index(value, ".", 3))
             .otherwise(F.left(digits, F.lit(6))))
    named = lambda mark, name: F.concat(kind.cast("string"), F.lit(mark), name)
    return F.array(named(":", value), named("/", wider))


def disclosing_terms(
    docs: DataFrame, prior_texts: float = PRIOR_TEXTS, least_chance: float = LEAST_CHANCE, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(term, entities, share) of the terms that give an entity away; counts are over all documents."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), text_of(F.col("text")).alias("text"))
    mailbox = F.when(F.col("kind") == 0, terms_of(F.substring_index("hit", "@", 1)))
    mentions = _located(keyed).select("doc_id", "h", F.explode(_entities(F.col("kind"), F.col("hit"))).alias("entity"),
                                      mailbox.alias("parts"), _near(F.col("before"), F.col("after")).alias("terms"))
    mentions = written_table(mentions)
    copies = docs.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    counted = mentions.join(copies.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "copies"),
                            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    counted = counted.select("doc_id", "h", "entity", "parts", "terms", F.coalesce("copies", F.lit(1)).alias("copies"))
    entities = counted.dropDuplicates(["doc_id", "h", "entity"]).groupBy("entity").agg(F.sum("copies").alias("n_e"))
    pairs = counted.select("doc_id", "h", "entity", "parts", "copies", F.explode("terms").alias("term"))
    part = F.coalesce(F.array_contains("parts", F.col("term")), F.lit(False))
    pairs = pairs.groupBy("term", "entity", "doc_id", "h").agg(F.max("copies").alias("copies"), F.max(part).alias("part"))
    pairs = pairs.groupBy("term", "entity", "h").agg(F.sum("copies").alias("copies"), F.max("part").alias("part"))
    pairs = pairs.groupBy("term", "entity").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("n_te"), F.max("part").alias("part"))
    n = docs.count()
    start = F.when(F.col("part"), F.lit(PART_CHANCE)).otherwise(F.col("n_e") / F.lit(float(max(n, 1))))
    chance = lambda texts: (F.col("texts") + prior_texts * start) / (texts + prior_texts)
    # The term is in these texts at least: a pair whose chance is too small even so is not looked at further.
    pairs = written_table(pairs.join(entities, "entity").filter(chance(F.col("texts")) >= least_chance))
    # Counted before the join: near an entity there are also terms that most documents have.
    words = keyed.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
    totals = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    information = F.log(F.lit(float(max(n, 1))) / F.col("n_e"))
    mutual = F.log(F.col("n_te") * F.lit(float(max(n, 1))) / (F.col("n_t") * F.col("n_e")))
    share = F.when(information > 0, mutual / information)
    judged = pairs.join(totals, "term").withColumn("share", share)
    # Copies of a text are no further evidence: of the term's documents only their rate counts.
    sure = chance(F.col("texts") * F.col("n_t") / F.col("n_te")) >= least_chance
    revealing = judged.filter(sure & (F.col("share") >= least_share))
    return revealing.groupBy("term").agg(F.count(F.lit(1)).alias("entities"), F.max("share").alias("share"))


def find_spans(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, h, spans): the sorted (start, kind, end) spans of each different (doc_id, text) that has any.

    Kinds are numbered as in `KINDS`, terms come after them. Start and end count code points.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), text_of(F.col("text")).alias("text"))
    terms = written_table(disclosing_terms(docs, **limits).select("term"))
    count, pattern = terms.count(), None
    if count:
        known = F.broadcast(terms) if count <= BROADCAST_TERMS else terms
        words = keyed.select("doc_id", "h", F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
        own = words.join(known, "term").groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("term"), False).alias("terms"))
        edge = lambda look: f"(?{look}{_LETTER})"
        pattern = F.concat(F.lit("(?iu)" + edge("<!") + "(?:"), F.array_join("terms", "|"), F.lit(")" + edge("!")))
        own = written_table(own.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), pattern.alias("pattern")))
        keyed = keyed.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    found = _located(keyed, "pattern" if count else None)
    return found.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, (*KINDS, TERM)))
    one = lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: counts of base spans, the digest of their list, and all spans.

    A NULL text is empty and has none. Rows with equal id and text are judged alike and all come back;
    NULL ids are kept, other columns ignored; an empty table gives an empty result.
    """
    found = find_spans(docs, **limits).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "spans")
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    number = lambda kind: F.size(F.filter("s", lambda x: x.kind == kind)).cast("long")
    counts = [number(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    base = F.filter("s", lambda x: x.kind < len(KINDS))
    return joined.select("doc_id", spans.alias("s")).select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("s")).alias("spans"))


def sanitised(docs: DataFrame, **limits) -> DataFrame:
    """`docs` with base spans generalised to their kind in brackets and disclosing terms removed.

    Of overlapping spans the one that starts first is taken, then the kind listed first. A text without a
    span, NULL and empty ones too, is as it was, and so are the other columns. Repeated rows all come back,
    treated alike; an empty table gives an empty result.
    """
    found = written_table(find_spans(docs, **limits)).select("doc_id", "h", F.col("spans").alias("found"))
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS], F.lit(""))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<string>").alias("parts"))
    whole = F.col("row").getField("text")

    def add(state, span):
        gap = F.substr(whole, (state.end + 1).cast("int"), (span.start - state.end).cast("int"))
        more = F.struct(span.end.alias("end"), F.concat(state.parts, F.array(gap, F.get(marks, span.kind))).alias("parts"))
        return F.when(span.start >= state.end, more).otherwise(state)

    joined = matching(whole_rows(docs), found, "left").withColumn("state", F.aggregate("found", zero, add))
    text = F.concat(F.array_join("state.parts", ""), F.substr(whole, (F.col("state.end") + 1).cast("int")))
    return joined.select(*fields(docs, F.when(F.col("found").isNull(), whole).otherwise(text)))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return report(table(spark, folder, "documents"))
