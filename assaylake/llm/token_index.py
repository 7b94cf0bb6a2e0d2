"""Token ids in binary shards with a minimal perfect hash index.

Documents are range-partitioned and sorted by id, encoded, and packed into shards. A shard is one row
of a Parquet table: the raw little-endian ids of its documents and where each starts. The index is a
second table: document keys are dealt by hash to parts of some 20,000, and each part is a minimal perfect
hash by hash and displace that names a key's shard and place without storing keys: one displacement per
few keys and a 32-bit fingerprint per key. A lookup joins the key to its part by the hash, reads one
displacement and one entry, and compares the fingerprint; payloads are read afterwards, by shard number.
An id without a value is a key like others. An id whose rows reach over several shards has a key for
each of these pieces, numbered from 0, so that its entries are spread over the index. Spark's writer
commits both tables, so a lost executor leaves no half-written ones.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from dataclasses import dataclass
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import mix, numbered_copies, running_sum, text_of
from assaylake.sources.scratch import scratch_dir, written_table
from assaylake.sources.tables import table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2  # appended to each document
SHARD_TOKENS = 500_000  # a shard is closed at so many ids; a longer document has a shard of its own
RANGE_BYTES = 32_000_000  # text per range partition
INDEX_KEYS = 20_000  # keys of an index part, about
KEYS_PER_BUCKET = 4
FINGERPRINT_SEED = 1 << 40  # beyond those tried for places
DIRECT = 1 << 31  # a bucket with one key names its place
TEXTS_AT_ONCE = 256
CACHE_WORDS = 600_000  # words whose ids a Python worker remembers; only a memory bound

# `n_null` and `keys` (of the other documents, in order) are there to build the index from, not to read by.
SHARD_SCHEMA = (
    "part int, shard int, n_docs long, n_tokens long, width int, payload binary, starts binary, n_null long, keys binary"
)
INDEX_SCHEMA = "bucket long, buckets long, seed long, displacements binary, fingerprints binary, entries binary"
ENTRY = ("part", "shard", "first", "rows", "pieces")  # of a key: its shard, its rows there, and how many pieces its id has

# --- the index --------------------------------------------------------------------------------


def _hash(keys: np.ndarray, turns: np.ndarray, seed: int) -> np.ndarray:
    """Hash of (key, turn); keys of turn 0 never collide."""
    h = mix(keys.astype(np.int64).view(np.uint64) ^ mix(np.full(len(keys), seed + 1, np.uint64)))
    return mix(h + turns.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _slot(h: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Place of a key; a displacement from DIRECT on is the place itself."""
    moved = (mix(h + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)
    return np.where(displacement >= DIRECT, displacement.astype(np.int64) - DIRECT, moved)


def build_index(keys: np.ndarray, turns: np.ndarray | None = None) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacements, slot of each key) for distinct (key, turn): a minimal perfect hash by hash and displace."""
    n = len(keys)
    turns = np.zeros(n, np.uint64) if turns is None else turns
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    for seed in range(1000):
        h = _hash(keys, turns, seed)
        bucket = (h >> np.uint64(40)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=buckets)
        starts = np.cumsum(counts) - counts
        free, displacements, slots = np.ones(n, bool), np.zeros(buckets, np.uint32), np.zeros(n, np.int64)
        done = True
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] < 2:
                break
            own = order[starts[b] : starts[b] + counts[b]]
            found, base, tries = False, 0, np.arange(32, dtype=np.uint64)
            while not found and base < 40 * n + 4096:
                at = _slot(h[own][None, :], (tries + np.uint64(base))[:, None], n)
                fits = free[at].all(axis=1)
                ordered = np.sort(at, axis=1)
                fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                good = np.flatnonzero(fits)
                if len(good):
                    displacements[b], slots[own], found = base + good[0], at[good[0]], True
                    free[at[good[0]]] = False
                base += len(tries)
                tries = np.arange(min(2 * len(tries), 4096), dtype=np.uint64)
            if not found:
                done = False
                break
        if done:
            alone, left = np.flatnonzero(counts == 1), np.flatnonzero(free)
            displacements[alone], slots[order[starts[alone]]] = left + DIRECT, left
            return seed, displacements, slots
    raise ValueError("keys are not distinct")


def fingerprint(keys: np.ndarray, turns: np.ndarray) -> np.ndarray:
    return (_hash(keys, turns, FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


def look_up(row: dict, keys: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in an index part, and its entry; a strange key passes once in 2^32 times."""
    fingerprints = np.frombuffer(row["fingerprints"], np.uint32)
    displacements = np.frombuffer(row["displacements"], np.uint32)
    h = _hash(keys, turns, row["seed"])
    slot = _slot(h, displacements[(h >> np.uint64(40)).astype(np.int64) % len(displacements)], len(fingerprints))
    entries = np.frombuffer(row["entries"], np.int64).reshape(-1, len(ENTRY))
    return fingerprints[slot] == fingerprint(keys, turns), entries[slot]


def _key_arrays(ids: pa.Array, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(key, turn) of an id, which may be NULL, and the number of its piece."""
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    turns = pieces.to_numpy(zero_copy_only=False).astype(np.uint64) * np.uint64(2) + missing.astype(np.uint64)
    return ids.fill_null(0).to_numpy(zero_copy_only=False), turns


# --- encoding ---------------------------------------------------------------------------------

_known: dict = {}


def _printable_bytes() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it is visible."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class _Words(dict):
    """Ids of words, as bytes, learnt when a word is first asked for."""

    def __init__(self, name: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model, self.letters, self.cores = self.tokenizer.model, _printable_bytes(), {}
        self.marks = {mark: self._whole(mark) for mark in ".,"}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        """Plain letters, perhaps with one mark behind, go to the model directly: the steps before it would
        only lower-case them and cut off the mark. The library's whole chain does all other words."""
        core, mark = (word[:-1], word[-1]) if word[-1:] in self.marks else (word, "")
        low = core.lower()
        if low.isalpha() and (core.isascii() or ("\u03a3" not in core and is_normalized("NFC", core))):
            ids = self.cores.get(low)
            if ids is None:
                written = low if low.isascii() else "".join([self.letters[b] for b in low.encode()])
                ids = self.cores[low] = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
            ids = ids + self.marks[mark] if mark else ids
        else:
            ids = self._whole(word)
        self[word] = ids
        return ids


def _words(name: str) -> _Words:
    """The words that this Python worker has met."""
    if name not in _known:
        _known[name] = _Words(name)
    return _known[name]


def encode(texts: list[str], name: str = TOKENIZER) -> list[bytes]:
    """Ids of each text as little-endian 32-bit bytes, without an end id.

    This tokenizer drops white space and lets nothing reach across it, so a text's ids are those of
    its words in order; words that come again are not encoded again.
    """
    words = _words(name)
    if len(words) > CACHE_WORDS:
        words.clear()
        words.cores.clear()
    ids = words.__getitem__
    return [b"".join(map(ids, text.replace("\n", " ").replace("\t", " ").split(" "))) for text in texts]


def _pack(part: int, shard: int, keys: list, payloads: list[np.ndarray], width: int) -> dict:
    lengths = np.array([len(p) for p in payloads], np.int64)
    known = [k for k in keys if k is not None]
    return {
        "part": part, "shard": shard, "n_docs": len(keys), "n_tokens": int(lengths.sum()), "width": width,
        "payload": np.concatenate(payloads).astype("<u2" if width == 2 else "<u4").tobytes(),
        "starts": (np.cumsum(lengths) - lengths).astype("<i8").tobytes(),
        "n_null": len(keys) - len(known), "keys": np.array(known, "<i8").tobytes(),
    }


def write_shards(
    docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode `docs` (doc_id, text) and write the shards in ascending id order, and their index, to `path`.

    NULL texts are empty, NULL ids come first; an id that comes in several rows, like NULL, is one index
    entry over all of them within a shard. Other columns are ignored. An empty table gives no shard.
    """
    from tokenizers import Tokenizer  # noqa: F401  fails here rather than in a task

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // RANGE_BYTES))
    # Rows of one id, or without any, may fill more than a range: their place in the input divides them.
    rows = docs.select("doc_id", text_of(F.col("text")).alias("text"), F.monotonically_increasing_id().alias("tie"))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text").drop("tie")

    def encode_part(batches):
        from pyspark import TaskContext

        part, shard, keys, payloads, count = TaskContext.get().partitionId(), 0, [], [], 0
        width = 2 if max(_words(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], np.uint32)

        def closed():
            row = _pack(part, shard, keys, payloads, width)
            return pa.RecordBatch.from_pylist([row], schema=arrow_schema)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for at in range(0, len(names), TEXTS_AT_ONCE):
                texts = batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()
                for key, ids in zip(names[at : at + TEXTS_AT_ONCE], encode(texts, tokenizer)):
                    if keys and count + len(ids) // 4 + 1 > shard_tokens:
                        yield closed()
                        shard, keys, payloads, count = shard + 1, [], [], 0
                    keys.append(key)
                    payloads.append(np.concatenate((np.frombuffer(ids, "<u4"), end)))
                    count += len(payloads[-1])
        if keys:
            yield closed()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow_schema = to_arrow_schema(StructType.fromDDL(SHARD_SCHEMA))
    shards = ordered.mapInArrow(encode_part, SHARD_SCHEMA)
    shards.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(f"{path}/shards")
    spark = docs.sparkSession
    index = build_parts(spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards"))
    index.write.option("parquet.enable.dictionary", "false").parquet(f"{path}/index")


def _entries(shards: DataFrame) -> DataFrame:
    """A row per id and shard; `edge` if it is the shard's first or last id, so that it may go on in another shard."""

    def list_entries(batches):
        for batch in batches:
            for row in batch.to_pylist():
                nulls, keys = row["n_null"], np.frombuffer(row["keys"], "<i8")
                ids, at, rows = np.unique(keys, return_index=True, return_counts=True)
                edge = (at == 0) | (at + rows == len(keys))
                lead = 1 if nulls else 0
                names = pa.array([None] * lead + ids.tolist(), pa.int64())
                n = len(names)
                yield pa.RecordBatch.from_arrays([
                    names, pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                    pa.array([0] * lead + (nulls + at).tolist(), pa.int64()),
                    pa.array([nulls] * lead + rows.tolist(), pa.int64()), pa.array([True] * lead + edge.tolist(), pa.bool_()),
                ], ["doc_id", "part", "shard", "first", "rows", "edge"])

    return shards.select("part", "shard", "n_null", "keys").mapInArrow(
        list_entries, "doc_id long, part int, shard int, first long, rows long, edge boolean")


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).alias("bucket")


def build_parts(shards: DataFrame) -> DataFrame:
    """The index of written shards, a row per part. Keys are hashed evenly, whatever ids they come from."""
    entries = written_table(_entries(shards))
    buckets = max(1, -(-entries.count() // INDEX_KEYS))
    inner = entries.filter(~F.col("edge")).select("doc_id", F.lit(0).cast("long").alias("piece"), *ENTRY[:4], F.lit(1).cast("long").alias("pieces"))
    # Two rows a shard at most: an id's pieces are numbered in the order of the shards.
    edges = entries.filter("edge").select(
        "doc_id", *ENTRY[:4], F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"),
        F.floor(F.col("part") / 64).alias("block"), F.lit(1).alias("one"))
    numbered = running_sum(edges, ["id", "no_id"], "block", ["part", "shard"], "one", "piece")
    counted = edges.groupBy("id", "no_id").agg(F.count("*").alias("pieces"))
    outer = numbered.join(counted, ["id", "no_id"]).select("doc_id", "piece", *ENTRY)
    keyed = inner.unionByName(outer).withColumn("bucket", _bucket(buckets))

    def build(group):
        group = group.combine_chunks()
        keys, turns = _key_arrays(*[pa.concat_arrays(group.column(c).chunks) for c in ("doc_id", "piece")])
        seed, displacements, slots = build_index(keys, turns)
        prints, entries_ = np.zeros(len(keys), np.uint32), np.zeros((len(keys), len(ENTRY)), np.int64)
        prints[slots] = fingerprint(keys, turns)
        entries_[slots] = np.stack([group.column(c).to_numpy().astype(np.int64) for c in ENTRY], axis=1)
        return pa.table({
            "bucket": group.column("bucket").slice(0, 1), "buckets": pa.array([buckets]), "seed": pa.array([seed]),
            "displacements": pa.array([displacements.tobytes()]), "fingerprints": pa.array([prints.tobytes()]),
            "entries": pa.array([entries_.tobytes()])})

    return keyed.groupBy("bucket").applyInArrow(build, INDEX_SCHEMA)


@dataclass(frozen=True)
class Store:
    """Written shards and their index."""

    shards: DataFrame
    index: DataFrame


def read_shards(spark: SparkSession, path: str) -> Store:
    return Store(spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards"), spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index"))


def _probe(index: DataFrame, keys: DataFrame, buckets: int, slices: int) -> DataFrame:
    """Entries of (doc_id, piece), by an equi-join with the index parts; a part's keys come some 20,000 at a time."""
    slice_ = F.pmod(F.xxhash64("piece", "doc_id", F.lit(1)), F.lit(slices)).alias("slice")
    asked = keys.select("doc_id", "piece", _bucket(buckets), slice_).groupBy("bucket", "slice").agg(
        F.collect_list(F.struct("doc_id", "piece")).alias("asked"))

    def look(batches):
        for batch in batches:
            lists = batch.column("asked")
            for i, row in enumerate(batch.drop_columns(["asked"]).to_pylist()):
                ids, pieces = lists[i].values.flatten()
                found, entries = look_up(row, *_key_arrays(ids, pieces))
                columns = [pa.array(np.ascontiguousarray(c)) for c in entries[found].T]
                yield pa.RecordBatch.from_arrays([ids.filter(pa.array(found)), *columns], ["doc_id", *ENTRY])

    joined = index.drop("buckets").join(asked, "bucket").drop("bucket", "slice")
    return joined.mapInArrow(look, "doc_id long, " + ", ".join(f"{c} long" for c in ENTRY))


def located(store: Store, wanted: DataFrame) -> DataFrame:
    """(doc_id, part, shard, first, rows) of the ids in `wanted` (doc_id) that are there, a row per shard that
    holds some of its rows. NULL is an id. Repeated ids are asked for once."""
    ids = written_table(wanted.select("doc_id").distinct())
    head = store.index.select("buckets").first()
    buckets = head["buckets"] if head else 1
    slices = max(1, -(-ids.count() // (buckets * INDEX_KEYS)))
    starts = written_table(_probe(store.index, ids.withColumn("piece", F.lit(0).cast("long")), buckets, slices))
    reaching = starts.filter("pieces > 1").select("doc_id", "pieces")
    later = numbered_copies(reaching, "pieces", "piece").filter("piece > 0")
    return starts.unionByName(_probe(store.index, later, buckets, 1)).drop("pieces")


def described(store: Store, wanted: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of the ids in `wanted` (doc_id), placed by the index.

    The payloads are read where they lie; only numbers move. `start` counts the ids of all rows before.
    """

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.append(np.frombuffer(row["starts"], "<i8"), row["n_tokens"])
                ids = np.frombuffer(row["payload"], "<u2" if row["width"] == 2 else "<u4").astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * n, pa.int64()), pa.array([row["shard"]] * n, pa.int64()), pa.array(range(n), pa.int64()),
                    pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64()),
                ], ["part", "shard", "place", "own", "n_tokens", "ids_crc32"])

    totals = store.shards.select(
        F.lit(0).alias("all"), F.col("part").cast("long").alias("part"), F.col("shard").cast("long").alias("shard"), "n_tokens",
        F.floor(F.col("part") / 1000).alias("block"))
    bases = written_table(running_sum(totals, ["all"], "block", ["part", "shard"], "n_tokens", "base").select("part", "shard", "base"))
    rows = store.shards.select("part", "shard", "n_tokens", "width", "payload", "starts").mapInArrow(
        read, "part long, shard long, place long, own long, n_tokens long, ids_crc32 long")
    last = F.col("first") + F.col("rows") - 1
    places = located(store, wanted).select("doc_id", "part", "shard", F.explode(F.sequence("first", last)).alias("place"))
    found = rows.join(bases, ["part", "shard"]).join(places, ["part", "shard", "place"])
    return found.select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def fetch(store: Store, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) for the ids in `wanted` (doc_id), NULL left out: one index lookup each, then the shards
    they name. An id that repeats comes once per shard with the ids of all its rows there."""
    places = located(store, wanted.filter("doc_id is not null")).groupBy("part", "shard").agg(
        F.collect_list(F.struct("doc_id", "first", "rows")).alias("hits"))
    held = store.shards.select("part", "shard", "n_tokens", "width", "payload", "starts").join(places, ["part", "shard"])

    def take(batches):
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.append(np.frombuffer(row["starts"], "<i8"), row["n_tokens"])
                ids = np.frombuffer(row["payload"], "<u2" if row["width"] == 2 else "<u4")
                for hit in row["hits"]:
                    a, b = starts[hit["first"]], starts[hit["first"] + hit["rows"]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([hit["doc_id"]], pa.int64()), pa.array([ids[a:b].tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return held.mapInArrow(take, "doc_id long, ids array<long>")


def op2_token_index(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    docs = table(spark, folder, "documents")
    write_shards(docs, path)
    return described(read_shards(spark, path), docs)
