"""Substring deduplication by recompression.

Rounds rename word runs (equal neighbours) and pairs (a left name before a right one, by a coin per name)
to new global names. Names are hashes, so every task gives equal strings equal names without a dictionary.
Each symbol knows the words that decide it; equal substrings therefore agree on all symbols whose words lie
inside. Every window of `window` words is represented by such an interior symbol, the one with the smallest
key, or by itself if it has none.

Round one shuffles the symbols' keys: a window whose symbol is in one chunk of documents only is no repeat
beyond that chunk. Round two shuffles the remaining windows with their smallest document. Round three marks
the words and joins what is left. Windows are compared by 96 bits of two hashes over the words, 64 of which
are exact-match keys and 32 verify them. Chunks and buckets have a fixed size, and a task sends each name
once, so a passage that a third of the documents share costs one entry per chunk.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import (
    COPIES_PER_PIECE, buffers, gram_names, mix, odd_multipliers, small, steps, text_of, word_names, word_spans)
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

WINDOW = 13
CHUNK_BYTES = 4_000_000  # text per chunk; documents are dealt to chunks by a hash
KEYS_PER_BUCKET = 1_500_000  # aim for what one task compares
KEY_WORDS = 6  # words that a symbol's key covers at least
NO_ID = np.iinfo(np.int64).max  # order of documents without an id: after all others
_FAR = 1 << 60

_KEY = odd_multipliers(KEY_WORDS, 21)
_COIN = odd_multipliers(16, 22)


def rounds_for(window: int) -> int:
    """Rounds of runs and pairs whose symbols still fit into a window with the words that decide them."""
    return max(1, int(math.log2(window / 6)))


def parse(words: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, ...]:
    """(name, start, low, high) of the symbols after the rounds: a symbol starts at word `start` and is
    decided by words low .. high-1. Symbols at a document's border are decided by words beyond it."""
    n = len(words)
    name, start = words.copy(), np.arange(n)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low, high = start.copy(), start + 1

    def beside(values, step, far):
        """Each symbol's neighbour's value; `far` where the document ends."""
        out = np.full(len(values), far, np.int64)
        if step < 0:
            out[1:] = np.where(doc[1:] == doc[:-1], values[:-1], far)
        else:
            out[:-1] = np.where(doc[1:] == doc[:-1], values[1:], far)
        return out

    for turn in range(rounds):
        if not len(name):
            break
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(name)) - 1
        count = last - at + 1
        low, high = beside(low, -1, -_FAR)[at], beside(high, 1, _FAR)[last]
        name = np.where(count > 1, mix(name[at] + count.astype(np.uint64) * _COIN[15]), name[at])
        start, doc = start[at], doc[at]

        left = (mix(name * _COIN[turn]) >> np.uint64(63)).astype(bool)
        paired = np.zeros(len(name), bool)
        paired[:-1] = left[:-1] & ~left[1:] & (doc[1:] == doc[:-1])
        second = np.zeros(len(name), bool)
        second[1:] = paired[:-1]
        # A left symbol is decided with the next one, a right symbol with the one before.
        next_low, next_high = beside(low, 1, _FAR), beside(high, 1, _FAR)
        back_low, back_high = beside(low, -1, -_FAR), beside(high, -1, -_FAR)
        wide_low = np.where(left, np.minimum(low, next_low), np.minimum(low, back_low))
        wide_high = np.where(left, np.maximum(high, next_high), np.maximum(high, back_high))
        following = np.zeros(len(name), np.uint64)
        following[:-1] = name[1:]
        name = np.where(paired, mix(name * _COIN[14] + following), name)
        keep = ~second
        name, start, doc, low, high = name[keep], start[keep], doc[keep], wide_low[keep], wide_high[keep]
    return name, start, low, high


def window_keys(words: np.ndarray, first: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(place of each whole window, key of the symbol that represents it)."""
    n = len(words)
    end = np.repeat(first[1:], np.diff(first))
    places = np.flatnonzero(np.arange(n) + window <= end) if n else np.zeros(0, np.int64)
    if not len(places):
        return places, np.zeros(0, np.uint64)
    name, start, low, high = parse(words, first, rounds_for(window))
    high = np.maximum(high, low + KEY_WORDS)
    inside = (low >= 0) & (high - low <= window) & (high <= n)
    name, start, low, high = name[inside], start[inside], low[inside], high[inside]
    key = mix(gram_names(words, KEY_WORDS, _KEY)[low] + name + (start - low).astype(np.uint64))
    none = np.uint64(2**64 - 1)
    best = np.full(n, none, np.uint64)
    # A symbol lies in the windows that start at high-window .. low.
    for back in range(window - KEY_WORDS + 1):
        at = low - back
        fits = (at >= 0) & (high - at <= window)
        np.minimum.at(best, at[fits], key[fits])
    chosen = best[places]
    own = chosen == none
    if own.any():
        whole = gram_names(words, window, odd_multipliers(window, 23))
        chosen[own] = mix(whole[places[own]])
    return places, chosen


class _Chunk:
    """Words of a group of documents, step by step."""

    def __init__(self, documents: pa.Table):
        ids = documents.column("doc_id").combine_chunks() if documents.num_rows else pa.array([], pa.int64())
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks)
        self.ids = ids
        self.order = np.asarray(ids.fill_null(NO_ID)).astype(np.int64)
        self.data, self.offsets = buffers(documents.column("text"))

    def steps(self):
        """(documents a..b, bytes, word starts, word ends, first words, word names)."""
        for a, b in steps(self.offsets):
            raw, own = self.data[self.offsets[a] : self.offsets[b]], self.offsets[a : b + 1] - self.offsets[a]
            starts, ends, first = word_spans(raw, own)
            yield a, b, raw, starts, ends, first, word_names(raw, starts, ends)


def _two_hashes(words, window, places):
    return (gram_names(words, window, odd_multipliers(window, 31))[places],
            (gram_names(words, window, odd_multipliers(window, 32))[places] >> np.uint64(32)).astype(np.uint32))


def _by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, indices) for keys in ascending order."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def _six(keys: np.ndarray) -> bytes:
    """The low 48 bits of each key; the bucket holds some of the others."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _rows(schema: pa.Schema, columns: list[list]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary())])
_BACK = pa.schema([("chunk", pa.int64()), ("blob", pa.binary())])
_ENTRY = np.dtype([("key", "<u8"), ("check", "<u4"), ("doc", "<i8")])


def _entries(rows: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray]:
    blobs = rows.column("blob").to_pylist()
    if dtype is None:
        parts = [_from_six(b) for b in blobs]
    else:
        parts = [np.frombuffer(b, dtype) for b in blobs]
    origin = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return np.concatenate(parts), origin


def _answer(rows: pa.Table, chosen: np.ndarray, origin: np.ndarray, pack) -> pa.Table:
    """Sends each chunk its chosen entries."""
    chunks = rows.column("chunk").to_pylist()
    order = np.argsort(origin[chosen], kind="stable")
    chosen = chosen[order]
    cuts = np.flatnonzero(np.diff(origin[chosen])) + 1
    parts = [p for p in np.split(chosen, cuts) if len(p)]
    return _rows(_BACK, [[chunks[origin[p[0]]] for p in parts], [pack(p) for p in parts]])


def counted_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, copies): rows of one id and text once. They are counted by their hashes, and only
    repeated ones are brought together, after each task has kept one of its own; other texts do not move."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    counts = written_table(hashed.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    if counts.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long"))
    known = small(counts.select(F.col("doc_id").alias("key_id"), F.col("hash").alias("key_hash"), "copies"))
    same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("hash") == F.col("key_hash"))
    once = hashed.join(known.drop("copies"), same, "left_anti").select("doc_id", "text", F.lit(1).cast("long").alias("copies"))
    repeated = hashed.join(known, same).dropDuplicates(["doc_id", "hash"])
    return once.unionByName(repeated.select("doc_id", "text", "copies"))


def deduplicated(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]): one row per document.

    A word goes if a window that covers it also starts in a document with a smaller id; windows are those
    of the input. Words are separated by white space and compared as they are; NULL and empty texts have
    none, and texts shorter than a window lose none. Documents without an id come after all others and
    remove nothing from each other, nor do rows that repeat an id. Other columns are ignored; an empty
    table gives an empty result. `kept` is the kept words joined by single spaces.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    buckets = max(1, math.ceil(total / 28 / KEYS_PER_BUCKET))  # about one key for every 28 bytes
    base = counted_rows(docs).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def send_keys(documents: pa.Table) -> pa.Table:
        found = [window_keys(words, first, window)[1] for *_, first, words in _Chunk(documents).steps()]
        keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        parts = list(_by_bucket(keys, buckets))
        chunk = documents.column("chunk")[0].as_py()
        return _rows(_SENT, [[b for b, _ in parts], [chunk] * len(parts), [_six(keys[p]) for _, p in parts]])

    def shared_keys(rows: pa.Table) -> pa.Table:
        keys, origin = _entries(rows, None)
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        shared = np.zeros(len(keys), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        return _answer(rows, np.flatnonzero(shared), origin, lambda p: _six(keys[p]))

    def send_windows(documents: pa.Table, answers: pa.Table) -> pa.Table:
        known = [_from_six(b) for b in answers.column("blob").to_pylist()]
        if not documents.num_rows or not known:
            return _rows(_SENT, [[], [], []])
        known, chunk, parts = np.sort(np.concatenate(known)), _Chunk(documents), []
        for a, b, _, _, _, first, words in chunk.steps():
            places, keys = window_keys(words, first, window)
            low = keys & np.uint64(2**48 - 1)
            at = np.minimum(np.searchsorted(known, low), len(known) - 1)
            places = places[known[at] == low]
            if len(places):
                entry = np.empty(len(places), _ENTRY)
                entry["key"], entry["check"] = _two_hashes(words, window, places)
                entry["doc"] = chunk.order[a:b][np.searchsorted(first, places, side="right") - 1]
                parts.append(entry)
        if not parts:
            return _rows(_SENT, [[], [], []])
        entries = np.sort(np.concatenate(parts), order=("key", "check", "doc"))
        new = np.ones(len(entries), bool)
        new[1:] = (entries["key"][1:] != entries["key"][:-1]) | (entries["check"][1:] != entries["check"][:-1])
        entries = entries[new]  # the smallest document of each window in this chunk
        dealt = list(_by_bucket(entries["key"], buckets))
        own = documents.column("chunk")[0].as_py()
        return _rows(_SENT, [[b for b, _ in dealt], [own] * len(dealt), [entries[p].tobytes() for _, p in dealt]])

    def first_documents(rows: pa.Table) -> pa.Table:
        entries, origin = _entries(rows, _ENTRY)
        order = np.lexsort((entries["doc"], entries["check"], entries["key"]))
        ordered = entries[order]
        new = np.ones(len(ordered), bool)
        new[1:] = (ordered["key"][1:] != ordered["key"][:-1]) | (ordered["check"][1:] != ordered["check"][:-1])
        least = ordered["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
        later = least < ordered["doc"]
        answer = entries.copy()
        answer["doc"][order] = least
        return _answer(rows, order[later], origin, lambda p: answer[p].tobytes())

    def remove(documents: pa.Table, answers: pa.Table) -> pa.Table:
        if not documents.num_rows:
            return _rows(out_schema, [[] for _ in out_schema])
        chunk = _Chunk(documents)
        known = [np.frombuffer(b, _ENTRY) for b in answers.column("blob").to_pylist()]
        parts = [np.zeros(0, _ENTRY), *known]
        for a, b, _, _, _, first, words in chunk.steps():
            places = np.flatnonzero(np.arange(len(words)) + window <= np.repeat(first[1:], np.diff(first)))
            entry = np.empty(len(places), _ENTRY)
            entry["key"], entry["check"] = _two_hashes(words, window, places)
            entry["doc"] = chunk.order[a:b][np.searchsorted(first, places, side="right") - 1]
            parts.append(entry)
        entries = np.concatenate(parts)
        outside = sum(len(k) for k in known)
        order = np.lexsort((entries["doc"], entries["check"], entries["key"]))
        ordered = entries[order]
        new = np.ones(len(ordered), bool)
        new[1:] = (ordered["key"][1:] != ordered["key"][:-1]) | (ordered["check"][1:] != ordered["check"][:-1])
        repeated = np.zeros(len(entries), bool)
        if len(ordered):
            repeated[order] = ordered["doc"][np.flatnonzero(new)][np.cumsum(new) - 1] < ordered["doc"]
        repeated, at = repeated[outside:], 0
        ids, n_words, n_removed, digests, kept_texts = chunk.ids, [], [], [], []
        for a, b, raw, starts, ends, first, words in chunk.steps():
            places = np.flatnonzero(np.arange(len(words)) + window <= np.repeat(first[1:], np.diff(first)))
            hit = places[repeated[at : at + len(places)]]
            at += len(places)
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, hit, 1)
            np.subtract.at(change, hit + window, 1)
            gone = np.cumsum(change[:-1]) > 0
            n_words += np.diff(first).tolist()
            total_gone = np.concatenate(([0], np.cumsum(gone)))
            n_removed += (total_gone[first[1:]] - total_gone[first[:-1]]).tolist()
            # Kept words with the byte after each turned into a space, but for a document's last kept word.
            stay = np.flatnonzero(~gone)
            doc = np.searchsorted(first, stay, side="right") - 1
            last = np.ones(len(stay), bool)
            last[:-1] = doc[1:] != doc[:-1]
            lengths = ends[stay] - starts[stay] + ~last
            before = np.cumsum(lengths) - lengths
            index = np.arange(int(lengths.sum())) - np.repeat(before - starts[stay], lengths)
            text = raw[np.minimum(index, len(raw) - 1)] if len(raw) else raw[:0]
            text[(before + lengths - 1)[~last]] = 0x20
            whole = text.tobytes()
            edges = np.append(before, len(whole))[np.searchsorted(doc, np.arange(b - a + 1))] if len(stay) else np.zeros(b - a + 1, np.int64)
            for i in range(b - a):
                own = whole[edges[i] : edges[i + 1]]
                digests.append(hashlib.sha256(own).hexdigest())
                if with_text:
                    kept_texts.append(own.decode())
        columns = [ids.to_pylist(), n_words, n_removed, digests, *([kept_texts] if with_text else [])]
        return _rows(out_schema, [*columns, documents.column("copies").to_pylist()])

    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    out_schema = pa.schema(fields + [("kept", pa.string())] * with_text + [("copies", pa.int64())])
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text + ", copies long"
    sent, back = "bucket int, chunk long, blob binary", "chunk long, blob binary"
    by_chunk = base.groupBy("chunk")
    keys = by_chunk.applyInArrow(send_keys, sent).groupBy("bucket").applyInArrow(shared_keys, back)
    windows = by_chunk.cogroup(keys.groupBy("chunk")).applyInArrow(send_windows, sent)
    firsts = windows.groupBy("bucket").applyInArrow(first_documents, back)
    judged = by_chunk.cogroup(firsts.groupBy("chunk")).applyInArrow(remove, ddl)
    # A row for each copy, a piece of them at a time.
    own = [c for c in judged.columns if c != "copies"]
    size, zero = F.lit(COPIES_PER_PIECE).cast("long"), F.lit(0).cast("long")
    pieces = judged.withColumn("piece", F.explode(F.sequence(zero, F.floor((F.col("copies") - 1) / size))))
    return pieces.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(
        size, F.col("copies") - F.col("piece") * size)))).select(*own)


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(table(spark, folder, "documents"))
