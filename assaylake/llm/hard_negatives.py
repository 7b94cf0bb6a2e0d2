"""Hard-negative mining by bounds along a spanning tree of the anchors.

Anchors are taken in waves of bounded size, and all rows are scanned once a wave for their positives and
once for their negatives. The anchors of a block hang together in a minimum spanning tree. A row's score
at the tree's root is computed; at any other anchor it lies within (edge length x norm of the row) of the
score, or of the bounds, at the anchor's parent. Only rows whose bounds overlap an anchor's window are
scored there. Windows shrink as better rows turn up, and each task passes on its best few per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

SCALE = 256
POSITIVES = NEGATIVES = 5
LEAST, MOST = 80, 100  # a negative's score in percent of the positive's
ANCHORS_EVERY, MOVED_EVERY, LABELS = 100, 7, 10
WAVE = 8_192  # anchors that are held by a task at a time, on average half of it
BLOCK = 512  # anchors of one tree
ROWS = 2_048  # rows scored at a time
PAIR_COST = 8  # a product on its own, in products of a matrix
LARGEST_NORM = 2.0**31  # products of two vectors below it fit into 64 bits
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

FOUND = "anchor long, anchor_id long, slot int, positive_id long, positive_score long, score long, id long"


def spanning_tree(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Layers of (nodes, their parents, lengths of the edges); the first has the root alone, next to the centre."""
    n = len(vectors)
    root = int(np.argmin(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1)))
    parent, depth, nearest = np.full(n, root), np.zeros(n, np.int64), np.full(n, np.inf)
    open_, node = np.ones(n, bool), root
    lengths = np.zeros(n)
    for _ in range(n - 1):
        open_[node] = False
        away = ((vectors - vectors[node]) ** 2).sum(axis=1)
        closer = open_ & (away < nearest)
        nearest[closer], parent[closer] = away[closer], node
        node = int(np.argmin(np.where(open_, nearest, np.inf)))
        depth[node], lengths[node] = depth[parent[node]] + 1, np.sqrt(nearest[node])
    layers = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
    return [(nodes, parent[nodes], lengths[nodes]) for nodes in layers]


@dataclass
class Block:
    """Anchors of one tree with a window of scores per slot, for which the best `keep` rows are wanted."""

    anchor: np.ndarray
    id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray  # whole numbers
    tree: list
    low: np.ndarray  # (anchors, slots)
    high: np.ndarray
    positive: np.ndarray  # id of each slot's positive
    known: np.ndarray  # whether that is not NULL

    longest: float  # the greatest norm


def scores_overlapping(x: np.ndarray, norms: np.ndarray, block: Block, low: np.ndarray, high: np.ndarray):
    """(scores, which of them were computed): at least all that lie within [low, high] of their anchor."""
    rows, n, vectors = len(x), len(block.anchor), block.vectors.astype(x.dtype)
    scores, done = np.zeros((rows, n), x.dtype), np.zeros((rows, n), bool)
    under, over = np.empty((rows, n)), np.empty((rows, n))
    for depth, (nodes, parents, lengths) in enumerate(block.tree):
        if depth:
            # A little more than the edge allows, for rounding.
            reach = norms[:, None] * (lengths * (1 + 1e-9))[None, :] + 1
            below, above = under[:, parents], over[:, parents]
            below, above = below - reach - 1e-9 * np.abs(below), above + reach + 1e-9 * np.abs(above)
            overlaps = (above >= low[nodes]) & (below <= high[nodes])
            under[:, nodes], over[:, nodes] = below, above
        else:
            overlaps = np.ones((rows, len(nodes)), bool)
        # Anchors that many rows overlap take one product of matrices, the others one of vectors per row.
        many = overlaps.sum(axis=0) * PAIR_COST >= rows
        near = np.flatnonzero(overlaps[:, many].any(axis=1))
        row, column = np.nonzero(overlaps & ~many)
        blocks = ((np.ix_(near, nodes[many]), (x if len(near) == rows else x[near]) @ vectors[nodes[many]].T),
                  ((row, nodes[column]), np.einsum("ij,ij->i", x[row], vectors[nodes[column]])))
        for at, exact in blocks:
            scores[at], done[at], under[at], over[at] = exact, True, exact, exact
    return scores, done


class Best:
    """The best few (score, then known and smaller id) per anchor and slot, as far as rows were seen."""

    def __init__(self, anchors: int, slots: int, keep: int):
        self.keep = keep
        self.score = np.full((anchors, slots, keep), LOWEST)
        self.id = np.full((anchors, slots, keep), HIGHEST)
        self.known = np.zeros((anchors, slots, keep), bool)

    def add(self, slot: int, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        last = self.keep - 1
        better = (score > self.score[anchor, slot, last]) | (known > self.known[anchor, slot, last]) | (
            ids < self.id[anchor, slot, last])
        anchor, score, ids, known = anchor[better], score[better], ids[better], known[better]
        touched = np.unique(anchor)
        if not len(touched):
            return
        old = np.repeat(touched, self.keep)
        anchor = np.concatenate((old, anchor))
        score = np.concatenate((self.score[touched, slot].ravel(), score))
        ids = np.concatenate((self.id[touched, slot].ravel(), ids))
        known = np.concatenate((self.known[touched, slot].ravel(), known))
        order = np.lexsort((ids, ~known, -1 - score, anchor))  # -1 - x, as the lowest has no negative
        anchor, score, ids, known = anchor[order], score[order], ids[order], known[order]
        place = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
        kept = place < self.keep
        at = (anchor[kept], slot, place[kept])
        self.score[at], self.id[at], self.known[at] = score[kept], ids[kept], known[kept]


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, all components one after the other) of a list column without NULL."""
    return np.diff(np.asarray(column.offsets)), np.asarray(column.flatten()).astype(np.int64)


def norms_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def _search(blocks: list[Block], keep: int, same_label: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best rows of a task for each anchor and slot of the blocks, in the form of FOUND."""
    best = [Best(*b.low.shape, keep) for b in blocks]
    for batch in batches:
        if not batch.num_rows:
            continue
        uid, ids, label, vector = (batch.column(c) for c in range(4))
        known = np.asarray(ids.is_valid())
        uid, ids, label = np.asarray(uid), np.asarray(ids.fill_null(HIGHEST)), np.asarray(label)
        lengths, flat = _vectors(vector)
        ends = np.cumsum(lengths)
        for width in np.unique(lengths):
            chosen = np.flatnonzero(lengths == width)
            for first in range(0, len(chosen), ROWS):
                rows = chosen[first : first + ROWS]
                values = flat[(ends[rows] - width)[:, None] + np.arange(width)[None, :]]
                norms = norms_of(values)
                for block, top in zip(blocks, best):
                    if block.vectors.shape[1] == width:
                        _score(block, top, same_label, uid[rows], ids[rows], known[rows], label[rows], values, norms)
    for block, top in zip(blocks, best):
        anchor, slot, place = np.nonzero(top.score > LOWEST)
        if len(anchor):
            ids = pa.array(top.id[anchor, slot, place], mask=~top.known[anchor, slot, place])
            positive = pa.array(block.positive[anchor, slot], mask=~block.known[anchor, slot])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.anchor[anchor]), pa.array(block.id[anchor]), pa.array(slot.astype(np.int32)), positive,
                 pa.array(block.high[anchor, slot]), pa.array(top.score[anchor, slot, place]), ids],
                ["anchor", "anchor_id", "slot", "positive_id", "positive_score", "score", "id"])


def _score(block: Block, top: Best, same_label: bool, uid, ids, known, label, values, norms) -> None:
    low = np.maximum(block.low, top.score[:, :, -1])  # a row below the last of the best is not wanted
    # Products below 2^52 are exact as floating-point numbers, which multiply much faster.
    kind = np.float64 if block.longest * norms.max(initial=0) < 2.0**52 else np.int64
    x = values.astype(kind)
    scores, done = scores_overlapping(x, norms, block, low.min(axis=1), block.high.max(axis=1))
    wanted = done & ((label[:, None] == block.label[None, :]) == same_label)
    if same_label:
        wanted &= uid[:, None] != block.anchor[None, :]
    for slot in range(low.shape[1]):
        row, anchor = np.nonzero(wanted & (scores >= low[:, slot]) & (scores <= block.high[:, slot]))
        if len(row):
            top.add(slot, anchor, scores[row, anchor].astype(np.int64), ids[row], known[row])


def usable(rows: DataFrame, id: str, label: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(uid, id, label, vector): the rows that take part, with whole-numbered vectors, as a written table.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take no part, nor do those whose
    scaled norm is 2^31 or more, whose scores would pass 64 bits. An empty vector scores 0 with its like.
    """
    read = rows.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                       F.transform(F.col(vector), lambda x: x.cast("double")).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST_NORM / scale / 2))
    whole = read.filter(F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite).select(
        "id", "label", F.transform("vector", lambda x: F.floor(x * scale)).alias("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    kept = whole.filter(norm < LARGEST_NORM)
    return written_table(kept.select(F.monotonically_increasing_id().alias("uid"), "id", "label", "vector"))


def _blocks(anchors: list, positives: dict[int, list], block: int) -> list[Block]:
    """Trees over the anchors of a wave, with a slot and a window for each positive (without any: one open slot)."""
    anchors = sorted(anchors, key=lambda r: (len(r["vector"]), r["label"], r["uid"]))
    made, first = [], 0
    while first < len(anchors):
        width = len(anchors[first]["vector"])
        own = [r for r in anchors[first : first + block] if len(r["vector"]) == width]
        first += len(own)
        vectors = np.array([r["vector"] for r in own], np.int64).reshape(len(own), width)
        slots = POSITIVES if positives is not None else 1
        low, high = np.full((len(own), slots), HIGHEST), np.full((len(own), slots), LOWEST)
        positive, known = np.zeros((len(own), slots), np.int64), np.zeros((len(own), slots), bool)
        if positives is None:
            low[:], high[:] = LOWEST, HIGHEST
        for at, r in enumerate(own if positives is not None else []):
            for slot, (score, id) in enumerate(positives.get(r["uid"], [])):
                low[at, slot], high[at, slot] = -(-LEAST * score // MOST), score
                positive[at, slot], known[at, slot] = id or 0, id is not None
        made.append(Block(
            np.array([r["uid"] for r in own], np.int64), np.array([r["id"] for r in own], np.int64),
            np.array([r["label"] for r in own], np.int64), vectors, spanning_tree(vectors.astype(np.float64)), low, high,
            positive, known, float(norms_of(vectors).max(initial=0))))
    return made


def _best(rows: DataFrame, blocks: list[Block], keep: int, same_label: bool) -> DataFrame:
    """FOUND with `rank`: the best rows of all tasks."""
    shared = rows.sparkSession.sparkContext.broadcast(blocks)
    found = rows.select("uid", "id", "label", "vector").mapInArrow(lambda b: _search(shared.value, keep, same_label, b), FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def mined(
    rows: DataFrame, anchors_every: int = ANCHORS_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    wave: int = WAVE, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over `usable` rows.

    Anchors are the rows whose id is divisible by `anchors_every`. A score is the inner product; higher ones
    come first, ties by smaller id, NULL ids last. Each anchor's first other rows of its label are its
    positives, and for each of them come the first rows of other labels that score between 80 and 100 % of it.
    Vectors of another length than the anchor's do not meet it. Rows that repeat an id are rows of their own;
    each one that is an anchor has its own result. Without an anchor or a second label the result is empty.
    """
    spark = rows.sparkSession
    anchors = written_table(rows.filter(F.col("id") % anchors_every == 0))
    waves = max(1, -(-2 * anchors.count() // wave))
    parts = []
    for turn in range(waves):
        own = anchors.filter(F.pmod(F.xxhash64("uid"), F.lit(waves)) == turn).collect()
        pulled: dict[int, list] = {}
        for r in _best(rows, _blocks(own, None, block), positives, True).orderBy("anchor", "rank").collect():
            pulled.setdefault(r["anchor"], []).append((r["score"], r["id"]))
        found = _best(rows, _blocks([r for r in own if r["uid"] in pulled], pulled, block), negatives, False)
        parts.append(written_table(found.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label"))
    return mined(usable(given.select("vec_id", moved.alias("label"), "embedding"), "vec_id", "label", "embedding"))


OP11_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {MOVED_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % {ANCHORS_EVERY} = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LEAST} * positive_score <= {MOST} * score AND score <= positive_score
QUALIFY rank <= {NEGATIVES}
"""
