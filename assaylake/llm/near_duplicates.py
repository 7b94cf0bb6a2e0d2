"""N-gram Jaccard join by chosen paths.

Texts with equal shingle sets become one representative. Each representative follows one path per run:
it is dealt to a bucket by a sampled minimum of its tokens (shingles); a bucket that is still too large
is split again by a further one, sampled by the bucket's name. Two sets of similarity s share a bucket
of depth d with chance s^d, and runs repeat until a pair at the threshold is missed less than once in
10,000. Small buckets are compared by brute force; what is still large at the last depth is compared in
blocks, block against block, so no task holds a whole bucket and no case is cut off.

Sketches name the rows of a bucket that have a partner; only their sets are then compared exactly. A pair
that meets in several buckets counts in the first. Tasks return counts and one edge per row, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import (
    buffers,
    fields,
    gram_names,
    matching,
    mix,
    odd_multipliers,
    small,
    small_batches,
    steps,
    whole_rows,
    word_names,
    word_spans,
)
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

SHINGLE = 5
THRESHOLD = (4, 5)  # similarity of at least 4/5, compared in whole numbers
RUNS = 16
DEPTH = 3
MINIMA = RUNS * DEPTH
BLOCK = 256  # rows that are compared by brute force
LEAST_EQUAL = 24  # of the 48 sketch bytes; a pair at the threshold has fewer with a chance below 1e-6
RANGE_NAMES = 200_000  # shingles that are put into columns at a time
NO_KEY = 0

_GRAM = odd_multipliers(SHINGLE, 11)
_MINIMA = odd_multipliers(MINIMA, 12)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names of the distinct shingles, sorted per document; each document's first place and the total).

    A document of fewer than five words, but not none, has one shingle of all its words.
    """
    starts, ends, first = word_spans(data, offsets)
    words = word_names(data, starts, ends)
    counts = np.diff(first)
    grams = gram_names(words, SHINGLE, _GRAM)
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(grams))
    whole = place + SHINGLE <= first[1:][doc[: len(grams)]] if len(grams) else np.zeros(0, bool)
    grams, doc = grams[whole], doc[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        own = [mix((words[first[i] : first[i + 1]] * _GRAM[: counts[i]]).sum(keepdims=True) + np.uint64(counts[i])) for i in short]
        grams, doc = np.concatenate((grams, *own)), np.concatenate((doc, short))
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, np.searchsorted(doc, np.arange(len(counts) + 1))


def _each(texts: pa.Array):
    data, offsets = buffers(texts)
    for a, b in steps(offsets):
        yield shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def features(text: Column) -> Column:
    """Struct of n (shingles), rid and check (names of the set), minima (32 bits each, packed) and their low bytes."""

    @F.arrow_udf("n int, rid long, check long, minima binary, sketch binary")
    def apply(texts: pa.Array) -> pa.Array:
        n, rid, check, minima, sketch = [], [], [], [], []
        for grams, first in _each(texts):
            counts = np.diff(first)
            filled = np.flatnonzero(counts)
            at = first[:-1][filled]
            lows = np.zeros((len(counts), MINIMA), np.uint32)
            one, two = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
            if len(at):
                for k in range(MINIMA):
                    lows[filled, k] = (np.minimum.reduceat(grams * _MINIMA[k], at) >> np.uint64(32)).astype(np.uint32)
                one[filled] = np.add.reduceat(mix(grams), at)
                two[filled] = np.add.reduceat(mix(grams + np.uint64(0x1234567)), at)
            n.append(counts)
            rid.append(mix(one + counts.astype(np.uint64)).view(np.int64))
            check.append(mix(two).view(np.int64))
            minima += [row.tobytes() for row in lows]
            sketch += [row.tobytes() for row in (lows & np.uint32(255)).astype(np.uint8)]
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(join(n).astype(np.int32)), pa.array(join(rid).astype(np.int64)), pa.array(join(check).astype(np.int64)),
             pa.array(minima, pa.binary()), pa.array(sketch, pa.binary())], ["n", "rid", "check", "minima", "sketch"])

    return apply(text)


def packed_sets(text: Column) -> Column:
    @F.arrow_udf("binary")
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array([grams[first[i] : first[i + 1]].tobytes() for grams, first in _each(texts)
                         for i in range(len(first) - 1)], pa.binary())

    return apply(text)


def _paths(reps: DataFrame) -> DataFrame:
    """(rid, run, k1, k2, k3): the buckets on each run's path, one per depth. Each run has minima of its own."""

    def walk(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            lows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, MINIMA).astype(np.uint64)
            keys = []
            for run in range(RUNS):
                key = mix(lows[:, run] + np.uint64((run + 1) << 40))
                path = [key]
                for depth in range(1, DEPTH):
                    key = mix(key ^ mix(lows[:, depth * RUNS + run] + np.uint64(depth << 36)))
                    path.append(key)
                keys.append(np.stack(path))
            paths = np.stack(keys, axis=1).reshape(DEPTH, -1).view(np.int64)  # run-major
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column(0)] * RUNS), pa.array(np.repeat(np.arange(RUNS), n).astype(np.int32)),
                 *[pa.array(p) for p in paths]], ["rid", "run", "k1", "k2", "k3"])

    return reps.select("rid", "minima").mapInArrow(walk, "rid long, run int, k1 long, k2 long, k3 long")


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """`rows` of the buckets with more than one row, with the bucket's size, as a written table."""
    sizes = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return written_table(rows.join(small(written_table(sizes)), F.col(key) == F.col("_key")).drop("_key"))


def leaves(reps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rid, run, leaf, blocks): each representative's last bucket in each run in which it is not alone."""
    rows, parts = _paths(reps), []
    for depth in range(1, DEPTH + 1):
        counted = _counted(rows, f"k{depth}")
        few = F.col("size") <= block if depth < DEPTH else F.lit(True)
        blocks = F.ceil(F.col("size") / block).cast("int")
        parts.append(counted.filter(few).select("rid", "run", F.col(f"k{depth}").alias("leaf"), blocks.alias("blocks")))
        rows = counted.filter(~few).drop("size")  # few rows usually go deeper
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows dealt to their comparison groups (leaf, a, b), in order; a row of a bucket of several blocks
    goes to a group for each block that its own is compared with."""
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    dealt = rows.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    named = dealt.select("*", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).drop("other")
    return named.repartition("leaf", "a", "b").sortWithinPartitions("leaf", "a", "b", "rid")


def _groups(batches, names):
    """Whole groups of (leaf, a, b) from sorted batches; a group may reach over batches."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([np.asarray(batch.column(names.index(c))).astype(np.int64) for c in ("leaf", "a", "b")])
        cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for x, y in zip(edges[:-1], edges[1:]):
            now = tuple(at[:, x])
            if held and now != key:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            key = now
            held.append(batch.slice(x, y - x))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(group: pa.Table, name: str) -> np.ndarray:
    column = group.column(name)
    if not pa.types.is_list(column.type):
        return column.to_numpy()
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(len(column), -1)


def _candidates(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of a group whose sketches and sizes allow the threshold and that meet here first."""
    rid, n, own = _column(group, "rid"), _column(group, "n").astype(np.int64), _column(group, "own")
    sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(rid), MINIMA)
    meets = _column(group, "leaves")
    equal = np.zeros((len(rid), len(rid)), np.int16)
    for k in range(MINIMA):
        equal += sketch[:, k, None] == sketch[None, :, k]
    fits = np.triu(equal >= LEAST_EQUAL, 1)
    i, j = np.nonzero(fits)
    low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    same_block = group.column("a")[0].as_py() == group.column("b")[0].as_py()
    ok = (low * THRESHOLD[1] >= high * THRESHOLD[0]) & (same_block | (own[i] != own[j])) & (rid[i] != rid[j])
    i, j = i[ok], j[ok]
    together = (meets[i] == meets[j]) & (meets[i] != NO_KEY)
    here = meets[i, np.argmax(together, axis=1)] == group.column("leaf")[0].as_py()
    return i[here], j[here]


def _flagged(rows: DataFrame) -> DataFrame:
    """The rows of each group that have a candidate partner in it."""
    names, schema = rows.columns, rows.schema

    def find(batches):
        for group in _groups(batches, names):
            if group.num_rows > 1:
                i, j = _candidates(group)
                if len(i):
                    yield from group.take(pa.array(np.union1d(i, j))).to_batches()

    return rows.mapInArrow(find, schema)


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs of sorted sets."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    # Many pairs: a product of 0/1 matrices over the shingles that come more than once, for one range of
    # names after the other, so that long texts take no more memory.
    total = np.zeros((len(sets), len(sets)), np.float32)
    ranges = 1 + sum(map(len, sets)) // RANGE_NAMES
    borders = [np.uint64(min(k * (2**64 // ranges), 2**64 - 1)) for k in range(1, ranges)]
    cuts = [np.concatenate(([0], np.searchsorted(s, np.array(borders, np.uint64)), [len(s)])) for s in sets]
    for k in range(ranges):
        parts = [s[c[k] : c[k + 1]] for s, c in zip(sets, cuts)]
        rows = np.repeat(np.arange(len(sets)), [len(p) for p in parts])
        _, column, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = times[column] > 1
        names, column = np.unique(column[shared], return_inverse=True)
        rows, order = rows[shared], np.argsort(column, kind="stable")
        rows, column = rows[order], column[order]
        for low in range(0, len(names), 1024):
            a, b = np.searchsorted(column, (low, low + 1024))
            part = np.zeros((len(sets), min(1024, len(names) - low)), np.float32)
            part[rows[a:b], column[a:b] - low] = 1
            total += part @ part.T
    return total[i, j].astype(np.int64)


def _verified(rows: DataFrame) -> DataFrame:
    """(rid, texts, docs, to): exact links of each row in its group, and an edge to its local component."""
    names = rows.columns

    def compare(batches):
        for group in _groups(batches, names):
            i, j = _candidates(group)
            if not len(i):
                continue
            rid, m = _column(group, "rid"), _column(group, "m").astype(np.int64)
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("set")]
            n = np.array([len(s) for s in sets], np.int64)
            common = _common(sets, i, j)
            linked = common * THRESHOLD[1] >= (n[i] + n[j] - common) * THRESHOLD[0]
            i, j = i[linked], j[linked]
            if not len(i):
                continue
            texts, docs, label = np.zeros(len(rid), np.int64), np.zeros(len(rid), np.int64), np.arange(len(rid))
            for x, y in ((i, j), (j, i)):
                np.add.at(texts, x, 1)
                np.add.at(docs, x, m[y])
            while True:  # labels of the local components
                least = label.copy()
                np.minimum.at(least, i, label[j])
                np.minimum.at(least, j, label[i])
                least = least[least]
                if (least == label).all():
                    break
                label = least
            own = np.flatnonzero(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[own]), pa.array(texts[own]), pa.array(docs[own]), pa.array(rid[label[own]])],
                ["rid", "texts", "docs", "to"])

    return rows.mapInArrow(compare, "rid long, texts long, docs long, to long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of (rid, to).

    Rounds of taking the smallest neighbouring label and then that label's own; each round is written,
    so lineage stays short and a lost executor repeats one round.
    """
    both = edges.select(F.col("rid").alias("node"), F.col("to").alias("next")).unionByName(
        edges.select(F.col("to").alias("node"), F.col("rid").alias("next")))
    both = written_table(both.distinct())
    labels = written_table(both.groupBy("node").agg(F.least("node", F.min("next")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "next"), "next").groupBy("node").agg(F.min("label").alias("near"))
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        moved = written_table(taken.join(jump, F.col("label") == F.col("_node"), "left").select(
            "node", "old", F.least("label", F.coalesce("_label", "label")).alias("label")))
        if not moved.filter("label <> old").limit(1).count():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, h, class_id, n_links, n_texts, label): one row per document.

    Words are separated by white space and compared as they are; a shingle is five of them. Documents
    whose sets have a similarity of at least 4/5 are linked, and a class is a connected component, named
    by its smallest id (NULL if none of its documents has one). An id that repeats may name several classes;
    `label` is theirs alone. `n_links` counts linked documents,
    copies included, `n_texts` linked different sets. A text without words (NULL, empty) is a class of
    its own without links, repeated rows link to each other, other columns are ignored; an empty table
    gives an empty result. `h` is the text's hash.
    """
    small_batches(docs.sparkSession)
    found = docs.select("doc_id", F.xxhash64("text").alias("h"), features(F.col("text")).alias("f"))
    found = written_table(found.select("doc_id", "h", "f.*"))
    full = found.filter("n > 0")
    reps = written_table(full.groupBy("rid", "check").agg(
        F.count(F.lit(1)).alias("m"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("minima").alias("minima"),
        F.first("sketch").alias("sketch"), F.min(F.struct("doc_id", "h")).alias("one")))

    own = leaves(reps)
    at_run = lambda k: F.coalesce(F.max(F.when(F.col("run") == k, F.col("leaf"))), F.lit(NO_KEY))
    by_rid = own.groupBy("rid").agg(
        F.array(*[at_run(k) for k in range(RUNS)]).alias("leaves"), F.collect_list(F.struct("leaf", "blocks")).alias("meets"))
    by_rid = by_rid.join(reps.select("rid", "n", "m", "sketch"), "rid")
    spread = by_rid.select("rid", "n", "m", "sketch", "leaves", F.explode("meets").alias("x")).select(
        "rid", "n", "m", "sketch", "leaves", "x.leaf", "x.blocks")
    flagged = written_table(_flagged(_grouped(spread)))

    rids = flagged.select("rid").distinct()
    wanted = reps.join(rids, "rid").select("rid", F.col("one.doc_id").alias("_id"), F.col("one.h").alias("_h"))
    wanted = small(written_table(wanted.dropDuplicates(["_id", "_h"])))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h"))
    texts = docs.select("doc_id", "text").join(wanted, same)
    sets = texts.select("rid", packed_sets(F.col("text")).alias("set")).dropDuplicates(["rid"])
    joined = flagged.join(sets, "rid").repartition("leaf", "a", "b").sortWithinPartitions("leaf", "a", "b", "rid")
    links = written_table(_verified(joined))

    labels = components(links.select("rid", "to"))
    counts = links.groupBy("rid").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    placed = reps.select("rid", "m", "least").join(labels.withColumnRenamed("node", "rid"), "rid", "left").join(counts, "rid", "left")
    placed = placed.withColumn("label", F.coalesce("label", "rid"))
    names = placed.groupBy("label").agg(F.min("least").alias("class_id"))
    by_set = written_table(placed.join(names, "label").select(
        F.col("rid").alias("_rid"), "class_id", "label", (F.coalesce("docs", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_texts")))
    own_rid = F.when(F.col("n") > 0, F.col("rid"))
    result = found.select("doc_id", "h", own_rid.alias("rid")).join(by_set, F.col("rid") == F.col("_rid"), "left")
    return result.select(
        "doc_id", "h", F.when(F.col("_rid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("n_texts", F.lit(0).cast("long")).alias("n_texts"),
        F.coalesce("label", F.xxhash64("doc_id", "h")).alias("label"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each class: the one whose id names it, of its texts that with the smallest hash.

    Of rows that repeat an id and text one stays. Rows without an id stay, once for each text, if their
    class has no id at all.
    """
    ranked = written_table(classes(docs).select("doc_id", "h", "class_id", "label"))
    # Different texts may share the id that names their class, or be classes that one id names.
    keepers = ranked.filter("doc_id is not null and doc_id = class_id").groupBy("label").agg(
        F.min(F.struct("class_id", "h")).alias("one")).select("one.class_id", "one.h")
    nameless = ranked.filter("doc_id is null and class_id is null").select("class_id", "h").distinct()
    keep = keepers.unionByName(nameless).select(F.col("class_id").alias("_id"), F.col("h").alias("_h"))
    times = ranked.groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("n"))
    on = times["_id"].eqNullSafe(keep["_id"]) & (times["_h"] == keep["_h"])
    lost = written_table(times.join(keep, on, "left_anti").select("_id", "_h"))
    left = matching(whole_rows(docs), small(lost), "left_anti")
    repeats = written_table(times.filter("n > 1").select("_id", "_h"))
    if repeats.isEmpty():
        return left.select(*fields(docs))
    repeats = small(repeats)
    single = matching(left, repeats, "left_anti").select("row")
    # Of rows that repeat an id and text the one whose other columns have the smallest hash.
    again = matching(left, repeats, "left_semi")
    first = written_table(again.groupBy("id", "hash").agg(F.min("rest").alias("first")))
    again = matching(again, small(first), "inner").filter(F.col("rest") == F.col("first")).dropDuplicates(["id", "hash"])
    return single.unionByName(again.select("row")).select(*fields(docs))


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return classes(table(spark, folder, "documents")).drop("h")
