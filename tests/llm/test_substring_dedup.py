import hashlib
from collections import Counter

import numpy as np

from assaylake.llm.common import odd_multipliers
from assaylake.llm.substring_dedup import NO_ID, counted_rows, deduplicated, parse, window_keys
from tests.llm.cases import tables, words


def plain(rows, n=13):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            first[g] = min(first.get(g, NO_ID), NO_ID if i is None else i)
    for i, t, *_ in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < (NO_ID if i is None else i):
                gone.update(range(k, k + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        yield (i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), kept


def test_against_brute_force(spark):
    for name, df, rows in tables(spark):
        expected = Counter((*a, b) for a, b in plain(rows))
        got = Counter(tuple(r) for r in deduplicated(df, chunk_bytes=20_000, with_text=True).collect())
        assert got == expected, name


def test_a_third_of_the_rows_is_one_row(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(None, text), (7, text), (8, f"before {text}"), (None, None), (None, "")] * 2
    rows += [(5, text)] * 12_000 + [(i, f"own {i} " * 5) for i in range(20, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counted = counted_rows(df).collect()
    assert max(Counter((r.doc_id, r.text) for r in counted).values()) <= 2  # a NULL text beside an empty one
    assert sum(r.copies for r in counted) == len(rows)
    got = Counter(tuple(r) for r in deduplicated(df, chunk_bytes=2_000).collect())
    assert got == Counter(a for a, _ in plain(rows))


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(3)
    for trial in range(30):
        letters = odd_multipliers(4, trial)  # few names: many runs and repeats
        inner = letters[rng.integers(0, rng.integers(1, 5), 40)]
        sides = [letters[rng.integers(0, 4, rng.integers(0, 9))] for _ in range(4)]
        texts = [np.concatenate((sides[0], inner, sides[1])), np.concatenate((sides[2], inner, sides[3]))]
        for window in (13, 25):
            keys = {}
            both = np.concatenate(texts)
            places, found = window_keys(both, np.array([0, len(texts[0]), len(both)]), window)
            for p, key in zip(places, found):
                assert keys.setdefault(tuple(both[p : p + window]), key) == key


def test_symbols_shrink():
    text = odd_multipliers(3000, 5)
    name, *_ = parse(text, np.array([0, 3000]), 3)
    assert len(name) < 1500
