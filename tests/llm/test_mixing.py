from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from assaylake.llm.mixing import mixed_documents, mixed_words, mixture, permuted, targets
from tests.llm.cases import tables, words


def test_targets_are_capped_and_reshared():
    assert targets([100, 100, 100], [3, 1, 2], 450) == [200.0, 250 / 3, 500 / 3]
    assert targets([], [], 0) == [] and targets([0, 10], [3, 1], 15) == [0.0, 15.0]


def test_permutation():
    for n in (1, 2, 3, 64, 1000):
        index = np.arange(n)
        got = permuted(index, np.full(n, n), np.full(n, 99, np.uint64))
        assert sorted(got.tolist()) == index.tolist()


def test_against_brute_force(spark):
    for name, df, rows in tables(spark):
        plan = mixture(df, block_words=16, shard_slots=8)
        got = mixed_words(plan).collect()
        sizes = defaultdict(int)
        for _, t, s in rows:
            sizes[s] += len(words(t))
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
        wanted = dict(zip(order, targets([sizes[s] for s in order], weights, 1.5 * sum(sizes.values()))))
        expected = Counter((i, len(words(t)), sizes[s], round(wanted[s], 6)) for i, t, s in rows)
        assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == expected, name
        assert all(0 <= r.taken <= 2 * r["size"] for r in got)
        assert mixed_words(mixture(df, block_words=16, shard_slots=8)).exceptAll(mixed_words(plan)).count() == 0
        taken = defaultdict(int)
        for r in got:
            taken[r.target, r.source_size] += r.taken
        for (target, _), n in taken.items():
            assert abs(n - target) <= 32 + 0.02 * target, (name, target, n)
        slots = plan.slots.collect()
        assert len({(r.shard, r.slot) for r in slots}) == len(slots)
        assert max(Counter((r.number, r["pass"], r.block) for r in slots).values(), default=1) == 1
        assert max(Counter(r.shard for r in slots).values(), default=0) <= 8
        mixed = mixed_documents(df, plan)
        assert mixed.columns == df.columns
        assert sum(len(words(r.text)) for r in mixed.select("text").collect()) == sum(r.taken for r in got), name


def test_mixed_documents_word_for_word(spark):
    for name, df, _ in tables(spark):
        if name == "given":
            continue
        plan = mixture(df, block_words=16, shard_slots=8)
        taken = defaultdict(set)
        for r in plan.slots.collect():
            taken[r.number, r.block].add(r["pass"])
        texts = {(r.doc_id, r.h): words(r.text) for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
        parts = defaultdict(list)
        for r in plan.pieces.collect():
            for turn in taken.get((r.number, r.block), ()):
                parts[r.doc_id, r.h, r.rest, r.copy, turn].append((r.from_word, r.to_word))
        expected = Counter(
            (i, tuple(w for a, b in sorted(spans) for w in texts[i, h][a:b])) for (i, h, *_), spans in parts.items())
        got = Counter((r.doc_id, tuple(words(r.text))) for r in mixed_documents(df, plan).select("doc_id", "text").collect())
        assert got == expected, name
