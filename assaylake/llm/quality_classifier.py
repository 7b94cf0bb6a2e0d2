"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad. Its features come from the line itself, its neighbours and the
lines before it in its document; neighbouring labels depend on each other. Forward and backward messages
are prefix products of 2 x 2 matrices, formed for all lines of a step together in log2(lines) rounds, so
a very long document is no loop. A document's goodness is the mean of its lines' marginals, weighted by
length, put on a scale of chances by a logistic curve.

Labels are known for documents only. Lines of good documents are good; those of bad ones start as bad,
and where the fitted field calls a line good, it is taken as good in the next round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import buffers, mix, small_batches, steps, word_names, word_spans
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

FOLDS, HELD_OUT = 3, 1
SAMPLE = 1_500  # documents per label that the field is fitted on, at most
SAMPLE_BYTES, SAMPLE_LINES = 100_000, 300  # longer texts are not fitted on; they are scored whole like all others
ROUNDS, STEPS = 3, 60
RATE, DECAY = 0.3, 1e-3
SYMBOLS, ENDINGS = b"#*$%&|<>", b".!?"
OWN = ("upper", "symbols", "exclamations", "digits", "stutter", "repeated", "copy", "length", "ending", "capital", "word length", "other")
AROUND = 7  # the first so many features of the neighbours count too

GOOD, BAD = 0, 1


def _table(members) -> np.ndarray:
    found = np.zeros(256, np.int64)
    found[list(members)] = 1
    return found


_UPPER, _LOWER, _DIGIT = _table(range(65, 91)), _table(range(97, 123)), _table(range(48, 58))
_SYMBOL, _EXCLAIM, _ENDING = _table(SYMBOLS), _table(b"!"), _table(ENDINGS)
_WIDE, _INNER = _table(range(0xC0, 256)), _table(range(0x80, 0xC0))  # first and further bytes of other characters


@dataclass
class Lines:
    """Lines with a word of some documents: their features, lengths, documents and places in these."""

    x: np.ndarray
    length: np.ndarray  # code points from the first word to the last
    doc: np.ndarray
    place: np.ndarray


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines end at a newline; those without a word are left out."""
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Lines(np.zeros((0, len(OWN) + 2 * AROUND)), none, none, none)
    names = word_names(data, starts, ends)
    begins = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1)))
    line, head = np.unique(np.searchsorted(begins, starts, side="right") - 1, return_index=True)
    words = np.diff(np.append(head, len(starts)))
    doc = np.searchsorted(first, head, side="right") - 1
    new = np.append(True, doc[1:] != doc[:-1])
    place = np.arange(len(doc)) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(doc))))
    low, high = starts[head], ends[np.append(head[1:], len(starts)) - 1]

    def count(members: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(members[data])))
        return total[high] - total[low]

    of_line = np.repeat(np.arange(len(head)), words)
    within = np.arange(len(starts)) - head[of_line]
    again = np.append(False, names[1:] == names[:-1])
    again[first[:-1][first[:-1] < len(starts)]] = False
    order = np.lexsort((names, of_line))
    distinct = np.append(True, (names[order][1:] != names[order][:-1]) | (of_line[order][1:] != of_line[order][:-1]))
    line_name = np.add.reduceat(mix(names + within.astype(np.uint64)), head) + words.astype(np.uint64)
    order_lines = np.lexsort((np.arange(len(doc)), line_name, doc))
    same = np.append(False, (line_name[order_lines][1:] == line_name[order_lines][:-1]) & (doc[order_lines][1:] == doc[order_lines][:-1]))
    copy = np.zeros(len(doc))
    copy[order_lines] = same
    chars = (high - low) - count(_INNER)
    upper, lower, wide = count(_UPPER), count(_LOWER), count(_WIDE)
    own = np.column_stack((
        upper / np.maximum(upper + lower, 1),
        np.minimum(count(_SYMBOL) / words, 2),
        np.minimum(count(_EXCLAIM) / words, 2),
        count(_DIGIT) / chars,
        np.add.reduceat(again.astype(float), head) / words,
        1 - np.bincount(of_line[order], weights=distinct, minlength=len(head)) / words,
        copy,
        np.log1p(words) / 4,
        _ENDING[data[high - 1]],
        _UPPER[data[low]],
        np.minimum(chars / words / 10, 3),
        1 - np.minimum((upper + lower + wide) / chars, 1),
    ))
    near = own[:, :AROUND]
    before, after = np.zeros_like(near), np.zeros_like(near)
    before[1:][~new[1:]] = near[:-1][~new[1:]]
    after[:-1][~new[1:]] = near[1:][~new[1:]]
    return Lines(np.hstack((own, before, after)), chars, doc, place)


@dataclass
class Field:
    """State scores are 0 for good and `weights` x (1, features) for bad; then `moves` and the curve of documents."""

    weights: np.ndarray
    moves: np.ndarray  # (2, 2) log potentials of neighbouring labels
    curve: np.ndarray  # intercept and slope over a document's goodness
    empty: float  # score of a text without a word


def _prefixes(factors: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Product of each line's factor and all before it in its document, up to a scale."""
    total, reach = factors / factors.max(axis=(1, 2), keepdims=True), 1
    at = np.flatnonzero(place >= reach)
    while len(at):
        product = total[at - reach] @ total[at]
        total = total.copy()
        total[at] = product / product.max(axis=(1, 2), keepdims=True)
        reach *= 2
        at = at[place[at] >= reach]
    return total


def marginals(bad: np.ndarray, moves: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chance that a line is bad, chances of (label before, label) for the lines that are not first).

    `bad` holds the lines' log odds on their own, `place` their places in their documents.
    """
    n = len(bad)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2))
    state = np.exp(np.clip(np.column_stack((-bad, bad)) / 2, -50, 50))
    step = np.exp(moves - moves.max())
    factors = step[None, :, :] * state[:, None, :]
    heads = place == 0
    forward_factors = factors.copy()
    forward_factors[heads] = state[heads][:, None, :]  # both rows alike: there is no label before
    forward = _prefixes(forward_factors, place)[:, 0, :]
    last = np.append(heads[1:], True)
    ends = np.flatnonzero(last)
    behind = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    # Backwards: the message to a line is the product of the factors after it with ones.
    message = np.ones((n, 2, 2))
    message[:-1][~last[:-1]] = factors[1:][~last[:-1]].transpose(0, 2, 1)
    backward = _prefixes(message[::-1], behind[::-1])[::-1]
    backward = np.where(last[:, None], 1.0, backward.sum(axis=1))
    both = forward * backward
    alone = both[:, 1] / both.sum(axis=1)
    rest = np.flatnonzero(~heads)
    pairs = forward[rest - 1][:, :, None] * factors[rest] * backward[rest][:, None, :]
    return alone, pairs / pairs.sum(axis=(1, 2), keepdims=True)


def _fit_field(lines: Lines, label: np.ndarray, weights: np.ndarray, moves: np.ndarray, importance: np.ndarray):
    """Gradient steps (Adam) on the penalised likelihood of the lines' labels."""
    x = np.column_stack((np.ones(len(label)), lines.x))
    rest = np.flatnonzero(lines.place > 0)
    seen = np.zeros((len(rest), 2, 2))
    seen[np.arange(len(rest)), label[rest - 1], label[rest]] = 1
    total, size = importance.sum(), len(weights)
    value = np.concatenate((weights, moves.ravel()))
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        alone, pairs = marginals(x @ value[:size], value[size:].reshape(2, 2), lines.place)
        up = np.concatenate((x.T @ ((label - alone) * importance),
                             ((seen - pairs) * importance[rest][:, None, None]).sum(axis=0).ravel())) / total
        up -= DECAY * value
        mean, square = 0.9 * mean + 0.1 * up, 0.99 * square + 0.01 * up * up
        value = value + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return value[:size], value[size:].reshape(2, 2)


def goodness(field: Field, lines: Lines, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length-weighted mean chance of a good line per document, whether it has a line, chances per line)."""
    bad, _ = marginals(np.column_stack((np.ones(len(lines.doc)), lines.x)) @ field.weights, field.moves, lines.place)
    total = np.bincount(lines.doc, weights=lines.length, minlength=documents)
    good = np.bincount(lines.doc, weights=(1 - bad) * lines.length, minlength=documents)
    return good / np.maximum(total, 1), total > 0, 1 - bad


def _fit_curve(good: np.ndarray, label: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """Logistic regression of the documents' labels (1: good) on their goodness, by Newton steps with a small penalty."""
    x, beta = np.column_stack((np.ones(len(good)), good)), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (importance * (label - p)) - 1e-2 * beta
        bend = (x * (importance * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta + np.linalg.solve(bend, slope)
    return beta


def _fold(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(text and label of at most `size` different texts a label, texts a label in all), held-out rows aside.

    A text's label is what most of its labelled rows say, bad on a tie; a hash of the text picks the sample.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~_fold(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").alias("of")).agg(F.avg("quality").alias("mark"))
    short = (F.octet_length("text") <= SAMPLE_BYTES) & (F.size(F.split("text", "\n")) <= SAMPLE_LINES)
    narrow = docs.filter(short & F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).select("doc_id", F.xxhash64("text").alias("hash"))
    seen = written_table(narrow.join(marks, F.col("doc_id") == F.col("of")).groupBy("hash").agg(
        F.avg("mark").alias("mark"), F.min("doc_id").alias("doc_id")))
    seen = seen.select("hash", "doc_id", (F.col("mark") > 0.5).cast("int").alias("good"))
    counts = {r["good"]: r["n"] for r in seen.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [seen.filter(F.col("good") == k).orderBy("hash", "doc_id").limit(size) for k in (0, 1)]
    chosen = written_table(chosen[0].unionByName(chosen[1]).select(F.col("hash").alias("h"), F.col("doc_id").alias("of"), "good"))
    found = docs.select("doc_id", "text").join(  # at most 2 * size rows
        F.broadcast(chosen), (F.col("doc_id") == F.col("of")) & (F.xxhash64("text") == F.col("h")))
    return found.dropDuplicates(["h"]).select("h", "text", "good"), counts


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Field:
    """The field, fitted on a bounded sample of labelled rows (`size` texts a label).

    Only the lines' numbers reach the driver, in the order of the texts' hashes, so reruns agree. With
    fewer than two labels every text scores the share of good ones, without labels 0.5.
    """
    small_batches(docs.sparkSession)
    chosen, counts = sample(docs, labels, size)

    def read(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in steps(offsets):
                lines = lines_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                cuts = np.searchsorted(lines.doc, np.arange(b - a + 1))
                part = batch.slice(a, b - a)
                pack = lambda values: pa.array([values[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pack(lines.x), pack(lines.length.astype(np.int64))], ["h", "good", "x", "length"])

    rows = chosen.mapInArrow(read, "h long, good int, x binary, length binary").collect()
    rows.sort(key=lambda r: r["h"])
    width = len(OWN) + 2 * AROUND
    total = sum(counts.values())
    empty = counts.get(1, 0) / total if total else 0.5
    field = Field(np.zeros(width + 1), np.zeros((2, 2)), np.array([0.0, 0.0]), empty)
    good = np.array([r["good"] for r in rows], np.int64)
    if len(set(good.tolist())) < 2:
        field.curve = np.array([np.log(max(empty, 1e-6) / max(1 - empty, 1e-6)), 0.0])
        return field
    sizes = np.array([len(r["length"]) // 8 for r in rows])
    doc = np.repeat(np.arange(len(rows)), sizes)
    lines = Lines(
        np.frombuffer(b"".join(r["x"] for r in rows), np.float64).reshape(-1, width),
        np.frombuffer(b"".join(r["length"] for r in rows), np.int64), doc, np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    label = 1 - good[doc]
    # Both labels weigh alike for the field, as in the table for the curve.
    importance = (len(doc) / 2 / np.maximum(np.bincount(label, minlength=2), 1))[label]
    for turn in range(ROUNDS):
        field.weights, field.moves = _fit_field(lines, label, field.weights, field.moves, importance)
        chance = goodness(field, lines, len(rows))[2]
        if turn < ROUNDS - 1:
            worst = np.ones(len(rows))
            np.minimum.at(worst, doc, chance)
            label = np.where((good[doc] == 0) & ((chance < 0.5) | (chance <= worst[doc])), BAD, GOOD)
    share = np.array([counts[k] / max((good == k).sum(), 1) for k in (0, 1)])
    field.curve = _fit_curve(goodness(field, lines, len(rows))[0], good, (share / share.sum() * 2)[good])
    return field


def _scored(field: Field, texts: pa.Array):
    """(documents, their goodness, whether they have a line, lines, chances) of steps of texts."""
    data, offsets = buffers(texts)
    for a, b in steps(offsets):
        lines = lines_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        yield b - a, *goodness(field, lines, b - a), lines


def quality(text: Column, field: Field) -> Column:
    """Chance that a text is good; the share of good texts for one without a word (NULL, empty)."""

    @F.arrow_udf("double")
    def apply(texts: pa.Array) -> pa.Array:
        parts = [np.where(filled, 1 / (1 + np.exp(-np.clip(field.curve[0] + field.curve[1] * good, -500, 500))), field.empty)
                 for _, good, filled, _, _ in _scored(field, texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return apply(text)


def line_quality(text: Column, field: Field) -> Column:
    """Chance of each line with a word that it is good, in order; none for a text without a word."""

    @F.arrow_udf("array<double>")
    def apply(texts: pa.Array) -> pa.Array:
        found = []
        for n, _, _, chances, lines in _scored(field, texts):
            cuts = np.searchsorted(lines.doc, np.arange(n + 1))
            found += [chances[x:y].tolist() for x, y in zip(cuts[:-1], cuts[1:])]
        return pa.array(found, pa.list_(pa.float64()))

    return apply(text)


def classified(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row, repeated ones included; an empty table gives none.

    The score follows from the text alone. A NULL id is in no fold and not held out.
    """
    small_batches(docs.sparkSession)
    scored = docs.select("doc_id", _fold(F.col("doc_id")).alias("held_out"), quality(F.col("text"), field).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op12_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return classified(docs, fit(docs, table(spark, folder, "labels")))
