"""Quality rules with repetition from suffix arrays.

Each step sorts the suffixes of a batch of documents by rounds of prefix doubling; ranks of all rounds
give longest common prefixes of neighbours. Places whose prefix with a neighbour is long enough start
repeated substrings; their spans are united, and a document fails if they cover too much of it or if
the longest one is too long. A suffix never compares beyond its own document.

The limits lie below what the base rule implies: it lets repeats cover a fifth of a document, whatever
their length. Documents it passes in the given tables repeat up to 13 words at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import buffers, steps, word_names, word_spans
from assaylake.sources.tables import table

REPEAT_WORDS = 5  # window of the base count
LONG_REPEAT = 20  # words from which a repeat counts as long
MOST_COVERED = 0.05  # part of the words that long repeats may cover
LONGEST_WORDS = 100  # words that one repeat may have in a document of any length
LONGEST_PART = 0.4  # part of the words that one repeat may have; the base rule implies it
MIN_WORDS = 10
MOST_REPEATED_PERCENT = 20

# Symbol characters of the contract.
SYMBOLS = "#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_long_repeat_words", "longest_repeat")


def neighbour_prefixes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word's place the longest prefix, in words, that its suffix shares with another one of
    the same document. `first`: each document's first word, and the total at the end."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][doc]
    order = np.lexsort((words, doc))
    new = np.ones(n, bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    levels, width = [rank], 1
    while True:
        # Suffixes that some other shares their first `width` words with; the others keep their rank.
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, n))
        tied = np.repeat(counts > 1, counts)
        if not tied.any():
            break
        live = order[tied]
        ahead = live + width
        inside = ahead < end[live]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)], -1)
        again = np.lexsort((second, rank[live]))
        order = order.copy()
        order[tied] = live[again]
        a, b = rank[live][again], second[again]
        differs = np.ones(len(a), bool)
        differs[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        new = np.ones(n, bool)
        new[np.flatnonzero(tied)] = differs
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        levels.append(rank)
        width *= 2
    x, y = order[:-1], order[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step, ranks = 1 << level, levels[level]
        i, j = x + common, y + common
        within = (i + step <= end[x]) & (j + step <= end[y]) & (doc[x] == doc[y])
        same = within & (ranks[np.minimum(i, n - 1)] == ranks[np.minimum(j, n - 1)])
        common = common + step * same
    longest = np.zeros(n, np.int64)
    longest[x] = common
    longest[y] = np.maximum(longest[y], common)
    return longest


def covered_words(starts: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words per document inside the union of the spans."""
    change = np.zeros(first[-1] + 1, np.int64)
    np.add.at(change, starts, 1)
    np.subtract.at(change, starts + lengths, 1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(change[:-1]) > 0)))
    return covered[first[1:]] - covered[first[:-1]]


def _repeated_lines(text: str) -> int:
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            if line in seen:
                repeated += 1
            seen.add(line)
    return repeated


def measure(column: pa.Array, long_repeat: int = LONG_REPEAT) -> dict[str, np.ndarray]:
    """`FIELDS` of every text."""
    data, offsets = buffers(column)
    parts = {name: [] for name in FIELDS}
    for a, b in steps(offsets, 1_000_000):
        own = offsets[a : b + 1] - offsets[a]
        raw = data[offsets[a] : offsets[b]]
        starts, ends, first = word_spans(raw, own)
        total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[own])
        inside = np.zeros(len(raw) + 1, np.int64)
        np.add.at(inside, starts, 1)
        np.subtract.at(inside, ends, 1)
        point = (raw & 0xC0) != 0x80
        longest = neighbour_prefixes(word_names(raw, starts, ends), first)
        short, long_ = np.flatnonzero(longest >= REPEAT_WORDS), np.flatnonzero(longest >= long_repeat)
        top = np.zeros(b - a, np.int64)
        filled = first[1:] > first[:-1]
        if filled.any():
            top[filled] = np.maximum.reduceat(longest, first[:-1][filled])
        text = raw.tobytes()
        lines = [_repeated_lines(text[own[i] : own[i + 1]].decode()) for i in range(b - a)]
        values = (
            np.diff(first), total(point & (np.cumsum(inside[:-1]) > 0)), total(_IS_SYMBOL[raw]), np.array(lines),
            covered_words(short, np.full(len(short), REPEAT_WORDS), first),
            covered_words(long_, longest[long_], first), top,
        )
        for name, value in zip(FIELDS, values):
            parts[name].append(value)
    return {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in parts.items()}


def measured(column: Column) -> Column:
    """`measure` as a column expression; batches of texts go to Python as Arrow buffers."""

    @F.arrow_udf(", ".join(f"{name} long" for name in FIELDS))
    def apply(texts: pa.Array) -> pa.Array:
        found = measure(texts)
        return pa.StructArray.from_arrays([pa.array(found[name]) for name in FIELDS], list(FIELDS))

    return apply(column)


def judge(
    docs: DataFrame, most_covered: float = MOST_COVERED, longest_part: float = LONGEST_PART, longest_words: int = LONGEST_WORDS,
) -> DataFrame:
    """One row per document with its counts and verdict.

    Words are separated by white space and compared as they are; a NULL or empty text has none and
    fails for being short. Rows are judged one by one, so repeated rows and ids, NULL ids and other
    columns make no difference; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", measured(F.col("text")).alias("m")).select("doc_id", "m.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    passed = (F.col("n_long_repeat_words") <= most_covered * F.col("n_words")) & (
        F.col("longest_repeat") <= longest_part * F.col("n_words")) & (F.col("longest_repeat") <= longest_words)
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & passed)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))
