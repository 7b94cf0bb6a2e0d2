"""Small document tables with the awkward cases, and the given tables."""

from __future__ import annotations

import os
import re

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Extra columns whose names the operators might use inside.
CLASHING = {
    "h": "h", "bucket": "b", "size": 1, "n": 2, "chunk": "c", "_id": -7, "_h": -8, "_row": "r", "_spans": "s", "_state": "t",
    "place": 3, "label": 4, "row": "w", "id": 5, "hash": 6, "rest": 7, "copy": 8, "spans": "x", "found": "y", "own": 9,
    "uid": 10, "tie": 11, "key": "k", "score": 1.5,
}
_KINDS = {str: "string", int: "int", float: "double"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} {_KINDS[type(value)]}" for name, value in CLASHING.items())
SPACES = " \t\n\x0b\f\r"

PASSAGE = " ".join(f"passage{i}" for i in range(60))
OTHER = " ".join(f"another{i % 17} line{i}" for i in range(30))
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(40_000))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def awkward():
    texts = [
        (1, PASSAGE, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "fr", "b"),
        (5, PASSAGE + " tail of five", "en", "a"), (5, PASSAGE + " tail of five", "en", "a"), (5, "other text", None, "a"),
        (None, PASSAGE, "en", None), (None, None, None, None), (6, OTHER + "\n" + PASSAGE + "\n" + OTHER, "de", "b"),
        (7, LONG, "es", "c"), (8, "Ünï ÇÖDE Σίσυφος ΣΊΣΥΦΟΣ 日本語 \U0001f600 text", "fr", "c"), (9, "a " * 200, "en", "a"),
        (10, "x y " * 90 + PASSAGE, "en", "b"), (11, LONG + " end", "es", "c"), (12, "one", "en", "a"),
        (13, OTHER.upper(), "de", "a"), (14, PASSAGE.replace("passage30", "changed"), "en", "b"),
        (-3, "tabs\tand\x0bbreaks\fhere\r\nnow " + OTHER, "de", "z"), (15, "e\u0301 nfc caf\u00e9 'S It's 12 3.5 <|endoftext|> x", "fr", "z"),
    ]
    return [full(i, t, lang, source, len(t or "")) for i, t, lang, source in texts]


def full(i, text, lang, source, n_chars):
    return (i, text, lang, source, n_chars, *CLASHING.values())


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(3)


def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def tables(spark):
    """(name, documents, rows as tuples) of the inputs that every operator is tried on."""
    for name, df in (("awkward", frame(spark)), ("empty", frame(spark, [])), ("given", given(spark))):
        yield name, df, [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]
