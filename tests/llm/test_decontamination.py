import hashlib
import re
from collections import Counter, defaultdict

from assaylake.llm.decontamination import clean_documents, report, without_spans
from tests.llm.cases import OTHER, PASSAGE, frame, given, tables
from tests.llm.cases import FOLDER

ITEMS = [(1, "Passage3 PASSAGE4 passage5, passage6 passage7-passage8 passage9 passage10 passage11 passage12 passage13"), (2, None),
         (3, ""), (10, "Another3  LINE3"), (11, "text"), (None, OTHER), (12, "ünï çöde"), (13, "Ünï ÇÖDe"), (1, PASSAGE[:300]), (4, "y x y x")]


def own(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = own(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    lengths = {len(k) for k in windows}
    for i, text in rows:
        w, hit, found = own(text), set(), set()
        for k in range(len(w)):
            for n in lengths:
                if k + n <= len(w) and tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        names = sorted(str(x) for x in found if x is not None)
        yield (i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))


def test_against_brute_force(spark):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    real = [tuple(r) for r in bench.select("item_id", "text").collect()]
    for name, df, rows in tables(spark):
        items = real if name == "given" else ITEMS
        frame_ = spark.createDataFrame(items, "item_id long, text string")
        got = Counter(tuple(r) for r in report(df, frame_).drop("h").collect())
        assert got == Counter(plain([(i, t) for i, t, _ in rows], items)), name
        bad = {(r[0], r[1]) for r in plain([(i, t) for i, t, _ in rows], items) if r[5]}
        clean = clean_documents(df, frame_)
        assert clean.columns == df.columns and clean.count() == len(rows) - sum(r[5] for r in plain([(i, t) for i, t, _ in rows], items))
        assert bool(bad) == (name != "empty")


def test_nothing_to_find(spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in report(frame(spark), nothing).collect())


def test_spans_are_cut_out(spark):
    items = spark.createDataFrame([(1, " ".join(f"passage{i}" for i in range(20, 35)))], "item_id long, text string")
    left = {r.doc_id: r.text for r in without_spans(frame(spark), items).collect()}
    assert left[1] == " ".join(f"passage{i}" for i in range(60) if not 20 <= i < 35)
    assert given(spark).count() == without_spans(given(spark), items).count()
