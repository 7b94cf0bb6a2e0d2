"""Mixing sources to target weights.

Every source's documents form one stream of words, cut into blocks of a fixed length. Output shards
draw multinomial source counts; the draws of all shards are then settled to the exact quota of each
source. A source's k-th slot takes block permutation(k), one pseudorandom permutation per source and
pass over it, so no block comes twice before every block of its source came once. Slots and blocks
meet in a join by (source, block). Everything follows from the seed and the rows: reruns agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import (
    SPACE_BYTES,
    buckets_for,
    fields,
    matching,
    mix,
    numbered_copies,
    others_hash,
    running_sum,
    small,
    whole_rows,
    word_count,
    word_spans,
)
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

WEIGHTS = (3, 1, 2)  # by source in code point order, repeating; NULL last
SHARE = 1.5  # words of the mix, in parts of all words
REPEATS = 2  # a source is taken at most so many times
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
SEED = 7
SHARDS_PER_BUCKET = 4096
SLOTS_PER_TASK = 200_000
IDENTITY = ("doc_id", "h", "rest", "copy")  # a document of the mix: id, hashes of the text and of the other columns


def targets(sizes: list[int], weights: list[float], total: float, repeats: float = REPEATS) -> list[float]:
    """Words per source: by weight, at most `repeats` times its size, the excess reshared by weight."""
    result, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / weight for i in open_}
        full = [i for i in open_ if share[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                result[i] = share[i]
            break
        for i in full:
            result[i] = float(repeats * sizes[i])
            left -= result[i]
        open_ = [i for i in open_ if i not in set(full)]
    return result


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of `index` under a keyed permutation of 0 .. size-1 (Feistel rounds, walked into range)."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    result, live, at = index.astype(np.uint64), np.arange(len(index)), index.astype(np.uint64)
    while len(live):
        h, m = half[live], mask[live]
        left, right = at >> h, at & m
        for turn in range(4):
            left, right = right, left ^ (mix(right + key[live] + np.uint64(turn * 0x9E3779B9)) & m)
        at = (left << h) | right
        inside = at < size[live].astype(np.uint64)
        result[live[inside]] = at[inside]
        live, at = live[~inside], at[~inside]
    return result.astype(np.int64)


@dataclass
class Mixture:
    documents: DataFrame  # doc_id, h, rest, copy, source, number, size, start (place in the source's stream)
    sources: DataFrame  # number, source, source_size, target
    slots: DataFrame  # shard, slot, number, pass, block
    pieces: DataFrame  # number, block, doc_id, h, rest, copy, start, size, from_word, to_word


def _drawn(spark, quota, shard_slots, seed):
    """(shard, number, count, slot): multinomial counts of each output shard."""
    total = int(quota.sum())
    shards = -(-total // shard_slots)
    chance = quota / max(total, 1)

    def draw(batches):
        for batch in batches:
            shard, number, count, slot = [], [], [], []
            for s in batch.column(0).to_pylist():
                n = min(shard_slots, total - s * shard_slots)
                counts = np.random.default_rng([seed, s]).multinomial(n, chance)
                taken = np.flatnonzero(counts)
                shard.append(np.full(len(taken), s))
                number.append(taken)
                count.append(counts[taken])
                slot.append(np.cumsum(counts[taken]) - counts[taken])
            if shard:
                columns = [np.concatenate(x).astype(np.int64) for x in (shard, number, count, slot)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "number", "count", "slot"])

    return spark.range(shards).mapInArrow(draw, "shard long, number long, count long, slot long")


def _mapped(quota, drawn, blocks, seed):
    """Turns counts into slots: surplus draws go to sources that drew too few, then blocks are looked up."""
    surplus, lack = np.maximum(drawn - quota, 0), np.maximum(quota - drawn, 0)
    surplus_before, lack_ends = np.cumsum(surplus) - surplus, np.cumsum(lack)

    def apply(batches):
        for batch in batches:
            shard, number, count, slot, start = (np.asarray(c) for c in batch.columns)
            repeat = lambda x: np.repeat(x, count)
            step = np.arange(int(count.sum())) - repeat(np.cumsum(count) - count)
            source, k = repeat(number), repeat(start) + step
            over = k >= quota[source]
            rank = surplus_before[source[over]] + k[over] - quota[source[over]]
            other = np.searchsorted(lack_ends, rank, side="right")
            source[over] = other
            k[over] = drawn[other] + rank - (lack_ends[other] - lack[other])
            n = blocks[source]
            turn = k // n
            key = mix((source * 1_000_003 + turn * 7919 + seed).astype(np.uint64))
            columns = (repeat(shard), repeat(slot) + step, source, turn, permuted(k % n, n, key))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], ["shard", "slot", "number", "pass", "block"])

    return apply


def mixture(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
) -> Mixture:
    """Plan of the mix over (doc_id, text, source); see `Mixture`.

    The table of sources is metadata and is held by the driver (their names and sizes, one row each);
    documents, blocks and slots are not. Documents without words are in no block. Repeated rows are
    separate documents of the stream: rows that differ in any column lie in the order of a hash, equal ones
    are counted first and numbered. An empty table, or one without words, gives a mix without slots.
    """
    spark = docs.sparkSession
    sized = written_table(docs.select(
        "doc_id", F.xxhash64("text").alias("h"), others_hash(docs).alias("rest"), F.col("source").alias("source"),
        word_count(F.col("text")).alias("size")))
    found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    each = [weights[i % len(weights)] for i in range(len(found))]
    wanted = targets(sizes, each, share * sum(sizes), repeats)
    blocks = np.array([-(-s // block_words) for s in sizes], np.int64)
    quota = np.array([min(repeats * b, round(t * b / s)) if s else 0 for t, b, s in zip(wanted, blocks, sizes)], np.int64)

    schema = "number long, source string, source_size long, target double"
    listed = [(i, r["source"], r["size"], t) for i, (r, t) in enumerate(zip(found, wanted))]
    sources = spark.createDataFrame(listed, schema)
    nb = buckets_for(max((r["rows"] for r in found), default=0))
    alike = sized.groupBy("doc_id", "h", "rest", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    every = numbered_copies(alike, "n", "copy")
    named = every.join(F.broadcast(sources.select("number", F.col("source").alias("_source"))),
                       F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # Copies of one row share a bucket by the thousand only.
    named = named.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "h", "rest", F.expr("copy div 1000")), F.lit(nb)))
    documents = written_table(
        running_sum(named, ["number"], "bucket", ["doc_id", "h", "rest", "copy"], "size", "start").drop("bucket"))

    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    low, high = F.col("block") * block_words - F.col("start"), (F.col("block") + 1) * block_words - F.col("start")
    pieces = documents.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last))).select(
        "number", "block", *IDENTITY, "start", "size", F.greatest(low, F.lit(0)).alias("from_word"),
        F.least(high, F.col("size")).alias("to_word"))

    counts = written_table(_drawn(spark, quota, shard_slots, seed))
    drawn = np.zeros(len(found), np.int64)
    for r in counts.groupBy("number").agg(F.sum("count").alias("n")).collect():
        drawn[r["number"]] = r["n"]
    counts = counts.withColumn("bucket", F.expr(f"shard div {SHARDS_PER_BUCKET}"))
    placed = running_sum(counts, ["number"], "bucket", ["shard"], "count", "first")
    # Counts are few, what they unroll to is not: they are dealt out by the number of slots.
    dealt = placed.repartition(max(1, math.ceil(int(quota.sum()) / SLOTS_PER_TASK)), "shard", "number")
    slots = dealt.select("shard", "number", "count", "slot", "first").mapInArrow(
        _slots_of(_mapped(quota, drawn, blocks, seed)), "shard long, slot long, number long, pass long, block long")
    return Mixture(documents, sources, slots, pieces)


def _slots_of(apply):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from apply([batch])

    return run


def taken_blocks(mix_: Mixture) -> DataFrame:
    """(number, block, passes): the passes in which a block is taken, as a written table, whose size Spark knows."""
    return written_table(mix_.slots.groupBy("number", "block").agg(F.sort_array(F.collect_list("pass")).alias("passes")))


def mixed_words(mix_: Mixture) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document: `taken` counts words in all passes."""
    used = mix_.pieces.join(taken_blocks(mix_), ["number", "block"])
    known = ["number", *IDENTITY, "size"]
    taken = used.select(*known, (F.size("passes") * (F.col("to_word") - F.col("from_word"))).alias("taken"))
    rest = mix_.documents.select(*known, F.lit(0).cast("long").alias("taken"))
    summed = taken.unionByName(rest).groupBy(*known).agg(F.sum("taken").alias("taken"))
    return summed.join(F.broadcast(mix_.sources), "number").select("doc_id", "size", "source_size", "target", "taken")


def _cut(text: Column, first: Column, last: Column) -> Column:
    """The given ranges of a text's words with the white space between; NULL where none are given."""

    @F.arrow_udf("string")
    def apply(texts: pa.Array, firsts: pa.Array, lasts: pa.Array) -> pa.Array:
        result = []
        for text, a, b in zip(texts, firsts, lasts):
            if not a.is_valid:
                result.append(None)
                continue
            raw = text.as_buffer().to_pybytes()
            starts, _, _ = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            edges = np.append(starts, len(raw))
            pieces = [raw[edges[x] : edges[y]] for x, y in zip(a.as_py(), b.as_py())]
            result.append(b"".join(pieces).strip(bytes(SPACE_BYTES)).decode())
        return pa.array(result, pa.string())

    return apply(text, first, last)


def mixed_documents(docs: DataFrame, mix_: Mixture) -> DataFrame:
    """The mix as documents: the columns of `docs`, one row per document and pass that took words of it.

    `text` holds the words taken in that pass with their white space; a document taken whole is
    unchanged. `n_chars`, if there, is set to the new length. Rows that repeat an id and text keep their own
    other columns. Documents without words (NULL, empty) are in no row; without slots the result is empty.
    """
    used = mix_.pieces.join(taken_blocks(mix_), ["number", "block"]).withColumn("pass", F.explode("passes"))
    spans = used.groupBy("number", *IDENTITY, "size", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("spans"))
    named = spans.select("doc_id", "h", F.col("rest").alias("own"), "size", "spans")
    # Equal rows are one row here, which meets the spans of all of them. Texts move once, in the join.
    again = written_table(mix_.documents.filter("copy > 0").select("doc_id", "h", F.col("rest").alias("own")).distinct())
    rows = whole_rows(docs)
    if not again.isEmpty():
        again, own = small(again), F.col("rest") == F.col("own")
        id_, hash_ = F.col("id").eqNullSafe(F.col("doc_id")), F.col("hash") == F.col("h")
        once = rows.join(again, id_ & hash_ & own, "left_anti")
        rows = once.unionByName(rows.join(again, id_ & hash_ & own, "left_semi").dropDuplicates(["id", "hash", "rest"]))
    joined = matching(rows, named, "inner").filter(F.col("rest") == F.col("own"))
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.to_word - s.from_word)
    part = lambda name: F.when(covered < F.col("size"), F.transform("spans", lambda s: s[name]))
    whole = F.col("row").getField("text")
    cut = joined.withColumn("cut", F.coalesce(_cut(whole, part("from_word"), part("to_word")), whole))
    columns = fields(docs, F.col("cut"))
    if "n_chars" in docs.columns:
        at = docs.columns.index("n_chars")
        columns[at] = F.length("cut").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return cut.select(*columns)


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_words(mixture(table(spark, folder, "documents")))
