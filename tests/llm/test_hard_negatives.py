import math
from collections import Counter

import numpy as np

from assaylake.llm import hard_negatives as hard
from tests.llm.cases import FOLDER
from tests.oracle import connect, difference

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, rank int, score long, id string, vector string"


def plain(rows):
    """The contract, pair by pair."""
    kept = []
    for at, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((at, i, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = Counter()
    for at, i, label, q in kept:
        if i is None or i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, own) for other, j, own, v in kept if other != at and len(v) == len(q)]
        scored.sort()
        name = lambda x: None if x[1] else x[2]
        for p in [x for x in scored if x[3] == label][:5]:
            fits = [x for x in scored if x[3] != label and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]]
            for rank, x in enumerate(fits[:5], 1):
                out[i, name(p), rank, name(x), -p[0], -x[0]] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "i", "v") for r in rows], SCHEMA).repartition(3)


def clustered(n, width, seed, labels=3, spread=0.1, centres=6):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, width))
    near = middle[draw.integers(0, centres, n)] + spread * draw.normal(size=(n, width))
    return [(int(i), [float(x) for x in v], int(draw.integers(0, labels))) for i, v in enumerate(near)]


AWKWARD = [
    (0, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (200, [], 2), (3, [], 1), (4, [1.0, 0.5], None), (5, None, 1), (6, [None, 1.0], 1),
    (8, [float("nan"), 1.0], 2), (9, [float("inf"), 1.0], 2), (300, [0.1, 0.2, 0.3], 1), (10, [0.1, 0.2, 0.3], 1), (11, [0.1, 0.2, 0.29], 2),
    (None, [1.0, 0.5], 2), (None, [0.9, 0.5], 1), (14, [1.0, 0.49], 2), (15, [1.0, 0.49], 2), (15, [1.0, 0.49], 2), (21, [1.0, 0.5], 0),
    (400, [-1.0, -0.5], 3), (401, [1.0, 1.0], 3), (402, [0.5, 1.0], 4), (500, [0.0, 0.0], 5), (501, [1.0, 0.0], 5), (502, [0.0, 0.0], 6),
    (100, [0.9, 0.4], 1), (600, [1e6, 2e6], 1), (601, [1e6, 2e6], 1), (602, [9e5, 2e6], 2), (700, [1e-30, -1e-30], 9),
]


def tables():
    yield AWKWARD
    yield [*AWKWARD * 3, *[(i, [0.7, 0.7], i % 3) for i in range(1000, 1400)]]  # a common vector, many ties
    yield []
    yield [(0, [1.0], 1)]
    yield clustered(700, 8, 1)


def test_against_brute_force(spark):
    for rows in tables():
        given = frame(spark, rows)
        moved = given.selectExpr("vec_id", "case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label", "embedding", "uid", "score")
        ready = hard.usable(moved, "vec_id", "label", "embedding")
        for wave, block in ((8_192, 512), (4, 2)):
            got = hard.mined(ready, wave=wave, block=block)
            assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            assert Counter(map(tuple, got.collect())) == plain(rows), (len(rows), wave)


def test_sql_form(spark):
    assert difference(connect(FOLDER), hard.op11_hard_negatives(spark, FOLDER), hard.OP11_SQL) is None


def test_bounds_leave_out_most_of_what_does_not_overlap():
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v, _ in clustered(2000, 16, 3, spread=0.03, centres=30)], np.int64)
    anchors = [{"uid": i, "id": i, "label": 0, "vector": v.tolist()} for i, v in enumerate(vectors[:100])]
    block, = hard._blocks(anchors, None, 512)
    truth = vectors @ block.vectors.T
    low = np.sort(truth, axis=0)[-20]  # a window of each anchor's 20 best
    scores, done = hard.scores_overlapping(vectors.astype(float), hard.norms_of(vectors), block, low, np.full(100, 2.0**60))
    assert (scores[done] == truth[done]).all()
    assert done[truth >= low].all()
    assert done.mean() < 0.4


def test_spanning_tree_reaches_all():
    points = np.random.default_rng(5).normal(size=(40, 3))
    layers = hard.spanning_tree(points)
    assert sorted(np.concatenate([nodes for nodes, _, _ in layers]).tolist()) == list(range(40))
    for nodes, parents, lengths in layers[1:]:
        assert np.allclose(np.linalg.norm(points[nodes] - points[parents], axis=1), lengths)
