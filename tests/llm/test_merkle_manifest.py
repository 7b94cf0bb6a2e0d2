import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from assaylake.llm import merkle_manifest as merkle
from tests.llm.cases import frame, full, given, FOLDER
from tests.oracle import connect, difference


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, add=0):
    values = [row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + add, row.text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grown(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def climb(levels, place, start):
    siblings = []
    for level in levels[:-1]:
        other = level[place ^ 1] if place ^ 1 < len(level) else None
        siblings += [other] if other else []
        start = digest(*([start] if other is None else [other, start] if place & 1 else [start, other]))
        place >>= 1
    return siblings, start


def plain(rows):
    """The contract, row by row."""
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: grown([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = grown([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for place, (_, _, own, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            bad = r.doc_id is not None and r.n_chars is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            low, subroot = climb(trees[g], place, leaf(r, 1) if bad else own)
            high, end = climb(top, at, subroot)
            root = top[-1][0]
            out.append((r.doc_id, own, trees[g][-1][0], root, digest(*low, *high), end, end == root))
    return Counter(out)


def cases(spark):
    nulls = [(None, None, None, None, None), (1, "", "", "", 0), (1, None, "", "", 0), (2, "x", "é", "s", -5), (3, "x", "z", "s", 2**63 - 1)]
    rows = [full(i, t, lang, s, n) for i, t, lang, s, n in nulls]
    yield frame(spark)
    yield frame(spark, rows + rows[:2])
    yield frame(spark, rows[:1])
    yield frame(spark, [])
    yield given(spark)


@pytest.mark.parametrize("chunk, bits", [(4_000, 12), (5, 2)])
def test_against_brute_force(spark, monkeypatch, chunk, bits):
    monkeypatch.setattr(merkle, "CHUNK", chunk)
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    for docs in cases(spark):
        made = merkle.manifest(docs, claimed=merkle.tampered(docs))
        got = merkle.proven(made).select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
        assert Counter(map(tuple, got.collect())) == plain(docs.collect())
        size = made.nodes.groupBy("tree", "level", "place").count().filter("count > 1")
        assert size.count() == 0


def test_a_few_rows_are_proven_with_their_siblings(spark):
    docs = given(spark)
    made = merkle.manifest(docs)
    some = made.leaves.filter("key % 13 = 0")
    got = merkle.proven(made, some, siblings=True).collect()
    assert len(got) == some.count() and all(r.verified for r in got)
    assert all(digest(*r.siblings) == r.proof_sha256 for r in got)
    everything = {r.key: r.proof_sha256 for r in merkle.proven(made).collect()}
    assert all(everything[r.key] == r.proof_sha256 for r in got)


def test_missing_is_the_smallest_union():
    for n in (1, 2, 3, 7, 8, 1000):
        for places in ([0], [n - 1], list(range(n)), sorted({0, n // 2, n - 1})):
            known, lacking = {(0, p) for p in places}, set(merkle.missing(np.array(places), n))
            assert not known & lacking
            width, level, own = n, 0, set(places)
            while width > 1:
                needed = {p ^ 1 for p in own if p ^ 1 < width} - own
                assert needed == {p for at, p in lacking if at == level}
                own, width, level = {p >> 1 for p in own}, (width + 1) // 2, level + 1
    assert merkle.missing(np.arange(1000), 1000) == []


def test_sql_form(spark):
    assert difference(connect(FOLDER), merkle.op13_merkle_manifest(spark, FOLDER), merkle.OP13_SQL) is None
