import itertools
import zlib

import numpy as np
import pytest

from assaylake.llm import quality_classifier as crf
from tests.llm.cases import FOLDER, LONG, frame, given, tables

LABELS = "doc_id long, quality int, toxic int, text string, h long"


def labels(spark, rows):
    return spark.createDataFrame([(*r, 0, "t", 1) for r in rows], LABELS)


def test_marginals_by_enumeration():
    draw = np.random.default_rng(1)
    sizes, moves = [1, 2, 5, 3, 7], draw.normal(size=(2, 2))
    bad = draw.normal(size=sum(sizes)) * 3
    place = np.concatenate([np.arange(n) for n in sizes])
    alone, pairs = crf.marginals(bad, moves, place)
    first, pair = 0, 0
    for n in sizes:
        odds = bad[first : first + n]
        total, one, two = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for labelling in itertools.product((0, 1), repeat=n):
            weight = np.exp(sum(o for o, y in zip(odds, labelling) if y) + sum(moves[a, b] for a, b in zip(labelling, labelling[1:])))
            total += weight
            one += weight * np.array(labelling)
            for t in range(1, n):
                two[t, labelling[t - 1], labelling[t]] += weight
        assert np.allclose(alone[first : first + n], one / total)
        assert np.allclose(pairs[pair : pair + n - 1], two[1:] / total)
        first, pair = first + n, pair + n - 1


def test_long_chains_do_not_underflow():
    n = 100_000
    bad = np.random.default_rng(2).normal(size=n) * 40
    alone, pairs = crf.marginals(bad, np.array([[5.0, -5.0], [-5.0, 5.0]]), np.arange(n))
    assert np.isfinite(alone).all() and np.isfinite(pairs).all() and 0 <= alone.min() <= alone.max() <= 1
    assert np.allclose(pairs.sum(axis=1)[:, 1], alone[1:])


def test_lines():
    texts = ["A b\nA b\n\n \nx x x! $$", "", "one | two", "x"]
    raw = [t.encode() for t in texts]
    lines = crf.lines_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert lines.doc.tolist() == [0, 0, 0, 2, 3] and lines.place.tolist() == [0, 1, 2, 0, 0]
    assert lines.length.tolist() == [3, 3, 9, 9, 1]
    at = {name: i for i, name in enumerate(crf.OWN)}
    assert lines.x[:, at["copy"]].tolist() == [0, 1, 0, 0, 0]
    assert lines.x[:, at["stutter"]].tolist() == [0, 0, 0.25, 0, 0]
    assert lines.x[:, at["symbols"]].tolist() == [0, 0, 0.5, 1 / 3, 0]
    assert lines.x[:, at["repeated"]].tolist() == [0, 0, 0.25, 0, 0]
    assert lines.x[:, at["upper"]].tolist() == [0.5, 0.5, 0, 0, 0]
    before, after = lines.x[:, len(crf.OWN) :][:, : crf.AROUND], lines.x[:, len(crf.OWN) + crf.AROUND :]
    assert (before[1] == lines.x[0, : crf.AROUND]).all() and (after[1] == lines.x[2, : crf.AROUND]).all()
    assert not before[[0, 3, 4]].any() and not after[[2, 3, 4]].any()


@pytest.fixture(scope="module")
def field(spark):
    return crf.fit(given(spark), spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_every_row_once_and_by_its_text_alone(spark, field):
    for name, df, rows in tables(spark):
        got = crf.classified(df, field).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _, _ in rows), name
        for r in got:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        other = df.selectExpr("doc_id + 1 as doc_id", "text", "'xx' as lang", "cast(null as string) as source")
        assert sorted(r.score for r in crf.classified(other, field).collect()) == sorted(r.score for r in got), name
    scores = {r.doc_id: r.score for r in crf.classified(frame(spark), field).collect()}
    assert scores[2] == scores[3] == scores[4] == field.empty


def test_batches_do_not_matter(spark, field):
    texts = [t for _, t, _ in list(tables(spark))[0][2]]
    raw = [(t or "").encode() for t in texts]
    together = crf.lines_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    good, filled, _ = crf.goodness(field, together, len(raw))
    for i, one in enumerate(raw):
        alone, has, _ = crf.goodness(field, crf.lines_of(np.frombuffer(one, np.uint8), np.array([0, len(one)])), 1)
        assert has[0] == filled[i] and np.isclose(alone[0], good[i])
    assert len(LONG) > 100_000


def test_held_out_labels_are_not_used(spark, field):
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = marks.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - quality else quality end as quality")
    again = crf.fit(given(spark), flipped)
    assert (again.weights == field.weights).all() and (again.curve == field.curve).all()


def test_held_out_accuracy(spark, field):
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = crf.classified(given(spark), field).join(marks, "doc_id").filter("held_out").collect()
    right = {q: [r.predicted == q for r in rows if r.quality == q] for q in (0, 1)}
    assert all(np.mean(x) >= 0.9 for x in right.values() if len(x) >= 5), {q: (np.mean(x), len(x)) for q, x in right.items()}


def test_lines_of_a_mixed_document(spark, field):
    text = "Then the other thing was on the table.\nBUY!! NOW!! BEST!! OFFER!! EVER!! HERE!!\nThen they went to the house."
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.lines for r in docs.select("doc_id", crf.line_quality(docs.text, field).alias("lines")).collect()}
    assert len(got[1]) == 3 and got[1][1] < min(got[1][0], got[1][2]) and got[2] == []


def test_without_labels_or_with_one(spark):
    docs = given(spark)
    assert {r.score for r in crf.classified(docs, crf.fit(docs, labels(spark, []))).collect()} == {0.5}
    only = crf.fit(docs, labels(spark, [(r.doc_id, 1) for r in docs.select("doc_id").collect()]))
    assert all(r.predicted == 1 for r in crf.classified(docs, only).collect())
    awkward = labels(spark, [(1, 0), (1, 0), (1, None), (None, 0), (5, 1), (6, 1), (8, 0), (9, 0), (10, 1)])
    assert crf.classified(frame(spark), crf.fit(frame(spark), awkward)).count() == frame(spark).count()
    assert crf.classified(frame(spark, []), crf.fit(frame(spark, []), awkward)).count() == 0
