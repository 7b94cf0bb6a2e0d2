import random
from collections import Counter

import pytest

from assaylake.llm import near_duplicates
from assaylake.llm.near_duplicates import classes, components, one_of_each
from tests.llm.cases import full, tables, words, SCHEMA


def shingles(text):
    w = words(text)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[k : k + 5]) for k in range(len(w) - 4)))


def plain(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    where, links = {}, [set() for _ in rows]
    for a, s in enumerate(sets):
        common = Counter()
        for g in s:
            common.update(where.get(g, ()))
            where.setdefault(g, []).append(a)
        for b, n in common.items():
            if 5 * n >= 4 * (len(s) + len(sets[b]) - n):
                links[a].add(b)
                links[b].add(a)
    label = {}
    for a in range(len(rows)):
        todo = [a] if a not in label else []
        group = set(todo)
        while todo:
            for b in links[todo.pop()] - group:
                group.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in group if rows[b][0] is not None]
        label |= {b: min(ids) if ids else None for b in group}
    return [(r[0], label[a], len(links[a])) for a, r in enumerate(rows)]


def edited(text, times, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(times):
        w[rng.randrange(len(w))] = f"edit{rng.random()}"
    return " ".join(w)


def test_against_brute_force(spark):
    for name, df, rows in tables(spark):
        got = Counter((r.doc_id, r.class_id, r.n_links) for r in classes(df).collect())
        assert got == Counter(plain(rows)), name


@pytest.mark.parametrize("block", [256, 16])
def test_large_groups_are_compared_whole(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "leaves", lambda reps, f=near_duplicates.leaves: f(reps, block))
    base = " ".join(f"word{i * 31 % 173}" for i in range(150))
    rows = [full(i, edited(base, 2 + i % 3, i), None, "s", 0) for i in range(150)]
    rows += [full(1000 + i, base, None, "s", 0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in classes(df).collect())
    assert got == Counter(plain(rows))
    stay = one_of_each(df).collect()
    assert {r.doc_id for r in stay} == {c for _, c, _ in plain(rows)} and len(stay) == len({r.doc_id for r in stay})


def test_unlinked_texts_that_share_an_id_all_stay(spark):
    base = " ".join(f"word{i}" for i in range(60))
    texts = [" ".join(f"own{k}x{i}" for i in range(30)) for k in range(5)]
    rows = [full(7, t, None, "s", 0) for t in (*texts, base, "", " ")]
    rows += [full(8, base + " more", None, "s", 0), full(8, texts[0], None, "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = classes(df).collect()
    assert {r.class_id for r in found} == {7} and len({r.label for r in found}) == len(texts) + 3
    assert Counter((r.doc_id, r.text) for r in one_of_each(df).collect()) == Counter((7, t) for t in (*texts, base, "", " "))


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 101), (7, 7), (200, 203), (203, 201), (202, 201)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "rid long, to long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 201: 200, 202: 200, 203: 200}
