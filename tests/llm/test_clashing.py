"""Extra columns whose names the operators might use inside come back with their values."""

from collections import Counter

import pytest

from assaylake.llm.decontamination import clean_documents, without_spans
from assaylake.llm.language_id import accepted
from assaylake.llm.mixing import mixed_documents, mixture
from assaylake.llm.near_duplicates import one_of_each
from assaylake.llm.pii import sanitised
from tests.llm.cases import CLASHING, PASSAGE, frame, full

OPERATORS = {
    "accepted": lambda spark, df: accepted(df),
    "one_of_each": lambda spark, df: one_of_each(df),
    "clean_documents": lambda spark, df: clean_documents(df, items(spark)),
    "without_spans": lambda spark, df: without_spans(df, items(spark)),
    "mixed_documents": lambda spark, df: mixed_documents(df, mixture(df, block_words=16, shard_slots=8)),
    "sanitised": lambda spark, df: sanitised(df),
}


def items(spark):
    return spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_keep_their_values(spark, name):
    for rows in (None, []):
        df = frame(spark, rows)
        got = OPERATORS[name](spark, df)
        assert got.columns == df.columns
        found = got.collect()
        assert bool(found) == (rows is None)
        assert {tuple(r[c] for c in CLASHING) for r in found} <= {tuple(CLASHING.values())}
        known = Counter((r.doc_id, r.lang, r.source) for r in df.collect())
        assert all((r.doc_id, r.lang, r.source) in known for r in found)


def test_rows_equal_in_id_and_text_keep_their_other_columns(spark):
    text = " ".join(f"word{i}" for i in range(100))
    rows = [full(1, text, lang, "s", 3) for lang in ("en", "zz", None, "zz")] + [full(2, text + " more", "en", "s", 4)]
    df = frame(spark, rows)
    mixed = mixed_documents(df, mixture(df, share=2.0, block_words=10)).collect()
    assert Counter((r.doc_id, r.lang) for r in mixed) == {(1, "en"): 2, (1, "zz"): 4, (1, None): 2, (2, "en"): 2}
    stay = {r.lang for turn in range(2) for r in one_of_each(df.repartition(1 + 3 * turn)).collect() if r.doc_id == 1}
    assert len(stay) == 1
