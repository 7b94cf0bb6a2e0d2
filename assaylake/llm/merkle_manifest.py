"""Merkle manifest of a dataset, checked by octopus multiproofs.

Every row is a leaf, every group of rows a tree over its leaves in key order, and the trees' roots are
the leaves of one more tree, whose root names the dataset. Places come from a range partitioning and
one count per partition; blocks of 4,096 neighbouring nodes are folded 12 levels at a time, so a tree
of any size takes a few rounds and no task holds more than a block.

To prove rows, a partition of leaves first computes which nodes it lacks, the smallest union over all
its leaves (the octopus's arms: for a run of neighbours about two a level), fetches them in one join by
their coordinates, derives the shared interior nodes itself, and expands each row's proof from these.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 12  # levels folded at a time
CHUNK = 4_000  # neighbouring leaves that are proven together
TOP = -1  # the tree over the groups' roots
TAMPERED_EVERY = 7



@dataclass
class Manifest:
    leaves: DataFrame  # tree, place, leaves (of the tree), trees, key, leaf, claimed
    nodes: DataFrame  # tree, level, place, digest; the tree TOP has the roots of the others as its leaves


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree with `n` of them."""
    return (n - 1).bit_length()


def leaf_of(fields: list[Column]) -> Column:
    """Digest of a row: for each field its UTF-8 byte count, a colon and its text, or a dash for NULL."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with `part` and `at`, runs): a group's rows lie in neighbouring parts, in order.

    A run is (group, part, first, size, before, total): where the group starts in the part, how many rows
    it has there, in earlier parts and in all. Equal rows are dealt out like others, so no key is hot.
    """
    keys = [group, *order, "tie"]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    # The id is the partition in its upper bits and the place in the partition in its lower 33.
    placed = written_table(ranged.withColumn("id", F.monotonically_increasing_id())).withColumns(
        {"part": F.shiftright("id", 33), "at": F.col("id").bitwiseAND((1 << 33) - 1)}).drop("id")
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    runs = runs.select("*", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"), F.sum("size").over(of_group).alias("total"))
    return placed, written_table(runs)


def _folded(base: int):
    """Of up to 4,096 neighbours at level `base`: the nodes above them, as far as these are complete or the tree ends."""

    def fold(block: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        tree, n, first = (block.column(c)[0].as_py() for c in ("tree", "leaves", "place"))
        digests, out = block.column("digest").to_pylist(), ([], [], [])
        for level in range(base + 1, min(base + BLOCK_BITS, height(n)) + 1):
            digests = [hashed("".join(digests[i : i + 2])) for i in range(0, len(digests), 2)]
            first >>= 1
            out[0].extend([level] * len(digests))
            out[1].extend(range(first, first + len(digests)))
            out[2].extend(digests)
        size = len(out[0])
        return pa.table({
            "tree": pa.array([tree] * size, pa.int64()), "leaves": pa.array([n] * size, pa.int64()),
            "level": pa.array(out[0], pa.int32()), "place": pa.array(out[1], pa.int64()), "digest": pa.array(out[2], pa.string())})

    return fold


def folded(leaves: DataFrame) -> DataFrame:
    """(tree, leaves, level, place, digest): all nodes of the trees over (tree, leaves, place, digest)."""
    lowest = leaves.select("tree", "leaves", F.lit(0).alias("level"), "place", "digest")
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    parts, base, layer = [lowest], 0, lowest
    while most > 1 << base:
        blocks = layer.filter(F.col("leaves") > 1 << base).groupBy("tree", F.shiftright("place", BLOCK_BITS).alias("block"))
        parts.append(written_table(blocks.applyInArrow(
            _folded(base), "tree long, leaves long, level int, place long, digest string")))
        base += BLOCK_BITS
        layer = parts[-1].filter(F.col("level") == base)
    return reduce(DataFrame.unionByName, parts)


def roots(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.expr("shiftright(leaves - 1, level) = 0")).select("tree", "digest")


def manifest(rows: DataFrame, key: str = "doc_id", group: str = "lang", fields=FIELDS, claimed: Column | None = None) -> Manifest:
    """The trees over `rows`; `claimed` is a leaf that somebody shows for a row (NULL: the row's own).

    Leaves ascend by key, NULL first; rows that repeat a key by their digest, and equal rows are a leaf
    each. Groups ascend in UTF-8 order, NULL first and a group of its own. NULL and empty fields differ;
    texts are hashed whole; columns that are not fields do not matter. An empty table has no node.
    """
    shown = (F.lit(None) if claimed is None else claimed).cast("string")
    read = rows.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf_of([F.col(f) for f in fields]).alias("leaf"),
                       shown.alias("claimed"))
    placed, runs = numbered(written_table(read), "group", ["key", "leaf"])
    groups = runs.filter("before = 0").select("group", F.lit(0).alias("all"))
    ordered, spans = numbered(groups, "all", ["group"])
    trees = ordered.join(spans, ["all", "part"]).select(
        F.col("group").alias("of"), (F.col("before") + F.col("at") - F.col("first")).alias("tree"), F.col("total").alias("trees"))
    runs = runs.join(written_table(trees), F.col("group").eqNullSafe(F.col("of"))).select(
        F.col("group").alias("of"), F.col("part").alias("within"), (F.col("before") - F.col("first")).alias("start"),
        F.col("total").alias("leaves"), "tree", "trees")
    joined = placed.join(written_table(runs), F.col("group").eqNullSafe(F.col("of")) & (F.col("part") == F.col("within")))
    leaves = written_table(joined.select(
        "tree", (F.col("start") + F.col("at")).alias("place"), "leaves", "trees", "key", "leaf", "claimed"))

    lower = folded(leaves.select("tree", "leaves", "place", F.col("leaf").alias("digest")))
    count = F.lit(leaves.agg(F.max("trees")).first()[0] or 0).cast("long")
    upper = folded(written_table(roots(lower).select(
        F.lit(TOP).cast("long").alias("tree"), count.alias("leaves"), F.col("tree").alias("place"), "digest")))
    return Manifest(leaves, lower.unionByName(upper).drop("leaves"))


# --- proofs ---------------------------------------------------------------------------


def missing(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes that are needed besides the given leaves to fold them up to the root."""
    known, level, lacking = np.unique(places), 0, []
    while n > 1:
        siblings = known ^ 1
        arms = np.setdiff1d(siblings[siblings < n], known)
        lacking += [(level, int(p)) for p in arms]
        known, n, level = np.unique(known >> 1), (n + 1) // 2, level + 1
    return lacking


def _arms(own: pa.Table) -> pa.Table:
    """What a partition of one tree's leaves has to fetch, from its own tree and from the one above."""
    tree, chunk, n, trees = (own.column(c)[0].as_py() for c in ("tree", "chunk", "leaves", "trees"))
    found = [(tree, *x) for x in missing(own.column("place").to_numpy(), n)]
    found += [(TOP, *x) for x in missing(np.array([tree]), trees)]
    column = lambda values, kind: pa.array(values, kind)
    return pa.table({
        "of": column([tree] * len(found), pa.int64()), "chunk": column([chunk] * len(found), pa.int64()),
        "tree": column([x[0] for x in found], pa.int64()), "level": column([x[1] for x in found], pa.int32()),
        "place": column([x[2] for x in found], pa.int64())})


def _interior(known: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> tuple[list[dict[int, str]], str]:
    """Known and fetched nodes by level, up to below the root, and the root."""
    levels = []
    for level in range(height(n)):
        known = known | {place: digest for (at, place), digest in fetched.items() if at == level}
        levels.append(known)
        above = {place >> 1 for place in known}
        # A fetched node's parent has a child among the known ones: arms are siblings.
        known = {p: hashed(known[2 * p] + known.get(2 * p + 1, "")) for p in above}
    return levels, known[0]


def _path(place: int, levels: list[dict[int, str]]) -> list[tuple[bool, str | None]]:
    """(whether the sibling is on the left, sibling) by level; None where a node folds alone."""
    path = []
    for nodes in levels:
        path.append((place & 1 == 1, nodes.get(place ^ 1)))
        place >>= 1
    return path


def _climbed(digest: str, path) -> str:
    for left, sibling in path:
        digest = hashed(digest if sibling is None else sibling + digest if left else digest + sibling)
    return digest


def _expanded(with_siblings: bool):
    def expand(own: pa.Table, arms: pa.Table) -> pa.Table:
        tree, n, trees = (own.column(c)[0].as_py() for c in ("tree", "leaves", "trees"))
        fetched, above = {}, {}
        for at, level, place, digest in zip(*(arms.column(c).to_pylist() for c in ("tree", "level", "place", "digest"))):
            (above if at == TOP else fetched)[level, place] = digest
        places, leaves = own.column("place").to_pylist(), own.column("leaf").to_pylist()
        levels, subroot = _interior(dict(zip(places, leaves)), fetched, n)
        top, root = _interior({tree: subroot}, above, trees)
        last = _path(tree, top)
        proofs, ends, all_siblings = [], [], []
        for place, leaf, claimed in zip(places, leaves, own.column("claimed").to_pylist()):
            path = _path(place, levels) + last
            siblings = [s for _, s in path if s is not None]
            proofs.append(hashed("".join(siblings)))
            ends.append(_climbed(leaf if claimed is None else claimed, path))
            if with_siblings:
                all_siblings.append(siblings)
        size = len(places)
        columns = {
            "key": own.column("key"), "leaf": own.column("leaf"), "subroot": pa.array([subroot] * size),
            "root": pa.array([root] * size), "proof_sha256": pa.array(proofs), "folded_root": pa.array(ends),
            "verified": pa.array([e == root for e in ends])}
        if with_siblings:
            columns["siblings"] = pa.array(all_siblings, pa.list_(pa.string()))
        return pa.table(columns)

    return expand


def proven(made: Manifest, rows: DataFrame | None = None, siblings: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of all leaves, or of some `rows` of `made.leaves`.

    `proof_sha256` is the digest of a leaf's siblings from its level to the root, left out where a node
    folds alone; `siblings` adds the list itself. `folded_root` starts at the claimed leaf.
    """
    leaves = made.leaves if rows is None else rows
    dealt = leaves.withColumn("chunk", F.expr(f"place div {CHUNK}"))
    wanted = written_table(dealt.select("tree", "chunk", "leaves", "trees", "place").groupBy("tree", "chunk").applyInArrow(
        _arms, "of long, chunk long, tree long, level int, place long"))
    arms = wanted.join(made.nodes, ["tree", "level", "place"]).select("of", "chunk", "tree", "level", "place", "digest")
    key = dict(leaves.dtypes)["key"]
    schema = (f"key {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + ", siblings array<string>" * siblings)
    return dealt.groupBy("tree", "chunk").cogroup(arms.groupBy("of", "chunk")).applyInArrow(_expanded(siblings), schema)


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row whose `n_chars` somebody has raised by one; NULL where nobody has."""
    raised = F.col("n_chars").cast("decimal(20,0)") + 1
    fields = [raised if f == "n_chars" else F.col(f) for f in FIELDS]
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0
    return F.when(picked & F.col("n_chars").isNotNull(), leaf_of(fields))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return proven(manifest(docs, claimed=tampered(docs))).withColumnRenamed("key", "doc_id")


def _message(n_chars: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(concat(" + ", ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + "))"


_UP = (
    "SELECT tree, any_value(lvl) + 1, place // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) "
    "FROM {t} WHERE n > 1 GROUP BY tree, place // 2"
)
_STEP = (
    "SELECT {keep}, {f}.lvl + 1, {f}.place // 2, "
    "sha256(CASE WHEN s.h IS NULL THEN {f}.h WHEN {f}.place % 2 = 1 THEN s.h || {f}.h ELSE {f}.h || s.h END), "
    "{f}.proof || coalesce(s.h, '') FROM {f} JOIN {t} o ON o.tree = {f}.tree AND o.lvl = {f}.lvl AND o.place = {f}.place AND o.n > 1 "
    "LEFT JOIN {t} s ON s.tree = {f}.tree AND s.lvl = {f}.lvl AND s.place = xor({f}.place, 1)"
)
OP13_SQL = f"""
WITH RECURSIVE
byte_crc AS (SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)) AS c
  FROM (SELECT unnest(range(256)) AS b)),
crc(doc_id, s, i, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, s, i + 1, xor(crc.c >> 8, t.c) FROM crc
  JOIN byte_crc t ON t.b = xor(crc.c & 255, ascii(substr(s, i, 1))) WHERE i <= length(s)),
picked AS (SELECT doc_id FROM crc WHERE i = length(s) + 1 AND xor(c, 4294967295) % 7 = 0),
leafs AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER () AS id
  FROM (SELECT doc_id, lang, {_message('n_chars')} AS leaf, CASE WHEN n_chars IS NOT NULL AND doc_id IN (SELECT doc_id FROM picked)
    THEN {_message('(CAST(n_chars AS HUGEINT) + 1)')} END AS claimed FROM documents)),
low(tree, lvl, place, n, h) AS (SELECT tree, 0, place, n, leaf FROM leafs UNION ALL {_UP.format(t='low')}),
tops AS (SELECT tree AS place, h, count(*) OVER () AS n FROM low WHERE n = 1),
high(tree, lvl, place, n, h) AS (SELECT 0, 0, place, n, h FROM tops UNION ALL {_UP.format(t='high')}),
climb(id, tree, lvl, place, h, proof) AS (SELECT id, tree, 0, place, coalesce(claimed, leaf), '' FROM leafs
  UNION ALL {_STEP.format(keep='climb.id, climb.tree', f='climb', t='low')}),
within AS (SELECT id, tree, max_by(h, lvl) AS h, max_by(proof, lvl) AS proof FROM climb GROUP BY id, tree),
ascent(id, tree, lvl, place, h, proof) AS (SELECT id, 0, 0, tree, h, proof FROM within
  UNION ALL {_STEP.format(keep='ascent.id, ascent.tree', f='ascent', t='high')}),
done AS (SELECT id, max_by(h, lvl) AS folded_root, sha256(max_by(proof, lvl)) AS proof_sha256 FROM ascent GROUP BY id)
SELECT doc_id, leaf, tops.h AS subroot, high.h AS root, proof_sha256, folded_root, folded_root = high.h AS verified
FROM leafs JOIN done USING (id) JOIN tops ON tops.place = leafs.tree JOIN high ON high.n = 1
"""
