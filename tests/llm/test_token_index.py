import uuid
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from assaylake.llm import token_index
from assaylake.llm.token_index import Store, build_index, described, encode, fetch, read_shards, write_shards
from assaylake.sources.scratch import checkpoint_dir
from tests.llm.cases import tables

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def test_words_encode_as_whole_texts():
    odd = ["", " ", "it's 'll x's", "A\u00a0b\u2003c\x1cd\x85e", "<|endoftext|>a <|startoftext|>", "e\u0301 \u0301x", "İI ß ς Σ.", "a\tb\nc\rd\x0be\x0cf", "don 't", "12 34 5", "日本 語"]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(odd)] == [plain(t)[:-1] for t in odd]


def test_files_against_the_library(spark):
    for name, df, rows in tables(spark):
        path = f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
        write_shards(df, path, shard_tokens=2000)
        shards = read_shards(spark, path)
        start, expected = 0, []
        for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = plain(t)
            expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = [tuple(r) for r in described(shards, df).collect()]
        assert sorted(got, key=lambda r: r[1]) == expected, name
        # The shards' own keys are not read by: without them the rest is the same.
        bare = Store(shards.shards.drop("keys", "n_null"), shards.index)
        some = spark.createDataFrame([(r[0],) for r in rows[:30]] + [(10**9,), (None,)], "doc_id long")
        asked = {r[0] for r in rows[:30]} | {None}
        assert sorted(map(tuple, described(bare, some).collect()), key=lambda r: r[1]) == [r for r in expected if r[0] in asked]
        ids = sorted({r[0] for r in rows if r[0] is not None})[:40]
        wanted = spark.createDataFrame([(i,) for i in [*ids, 10**9, None]], "doc_id long")
        found = {}
        for r in fetch(shards, wanted).collect():
            found.setdefault(r.doc_id, []).extend(r.ids)
        assert sorted(found) == ids
        for i in ids:
            assert sorted(found[i]) == sorted(x for k, t, _ in rows if k == i for x in plain(t))


def test_index_is_minimal_and_perfect():
    for n in (1, 2, 7, 500, 3000):
        keys = np.random.default_rng(n).choice(10**6, n, replace=False) - 500_000
        _, _, slots = build_index(keys)
        assert sorted(slots.tolist()) == list(range(n))
    turns = np.arange(3000)
    _, _, slots = build_index(np.zeros(3000, np.int64), turns)
    assert sorted(slots.tolist()) == turns.tolist()


def test_index_parts(spark, monkeypatch):
    """Many index parts, ids that reach over shards, and more keys asked for than a part holds."""
    monkeypatch.setattr(token_index, "INDEX_KEYS", 50)
    rows = [(5 if i % 3 == 0 else None if i % 3 == 1 else i, f"number {i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    write_shards(df, path, shard_tokens=100)
    store = read_shards(spark, path)
    assert store.index.count() > 5 and store.shards.count() > 20
    wanted = spark.createDataFrame([(i,) for i in range(-2000, 2000)], "doc_id long")
    assert sorted(r.doc_id for r in described(store, wanted).collect()) == sorted(i for i, _ in rows if i is not None)
    found = {}
    for r in fetch(store, wanted).collect():
        found.setdefault(r.doc_id, []).extend(r.ids)
    assert sorted(found) == sorted({i for i, _ in rows if i is not None})
    assert sorted(found[5]) == sorted(x for i, t in rows if i == 5 for x in plain(t))


def test_one_id_on_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(token_index, "RANGE_BYTES", 2_000)
    texts = [f"some text number {i} of many" for i in range(900)]
    rows = [(None if i < 300 else 7 if i < 600 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    write_shards(df, path)
    shards = read_shards(spark, path)
    assert max(r.n_docs for r in shards.shards.select("n_docs").collect()) < 250
    got = sorted(map(tuple, described(shards, df).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted(
        (i or -1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in ((i, plain(t)) for i, t in rows))
    ends = [0, *np.cumsum([r[2] for r in got]).tolist()]
    assert [r[1] for r in got] == ends[:-1]
