"""The pipeline's stages against brute force, each on what the one before kept."""

from collections import Counter

import corpus_pipeline
from assaylake.llm.mixing import mixed_words, mixture
from tests.llm.cases import FOLDER, frame, given, words
from tests.llm.test_decontamination import plain as hit_rows
from tests.llm.test_near_duplicates import plain as class_rows
from tests.llm.test_sharding import jump


def through(spark, docs):
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written_table(stage(spark, docs, FOLDER))
        kept[name] = docs
        rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        got = Counter((r.doc_id, r.text) for r in docs.collect()) if name != "sharding" else None
        if name != "sharding":
            assert docs.columns == before.columns
        if name == "near_duplicates":
            named = [(i, c) for i, c, _ in class_rows(rows) if i is not None]
            assert Counter(i for i, _ in got.elements() if i is not None) == Counter({c for _, c in named})
        if name == "decontamination":
            assert got == Counter(r for r, h in zip(rows, hit_rows(rows, bench)) if not h[5])
        if name == "mixing":
            assert sum(len(words(t)) for _, t in got.elements()) == sum(r.taken for r in mixed_words(mixture(before)).collect())
        if name == "sharding":
            assert Counter((r.doc_id, r.shard) for r in docs.collect() if r.doc_id is not None) == Counter(
                (i, jump(i, 40)) for i, _ in rows if i is not None)
    return kept


def test_stages(spark):
    kept = through(spark, given(spark))
    assert kept["language_id"].count() >= 0.97 * given(spark).count()
    through(spark, frame(spark))
    through(spark, frame(spark, []))


def test_run(spark):
    assert [len(STAGE) for STAGE in corpus_pipeline.STAGES] == [2] * 5
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
