import hashlib
import re
from collections import Counter

from assaylake.llm.pii import disclosing_terms, report, sanitised
from tests.llm.cases import full, tables, SCHEMA

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "mail a.b@c.de, x@y and q@r.s.t_u@v.w. end@", "1.2.3.4 256.1.1.1 001.002.3.255 1.2.3.4.5.6.7.8 9.9.9", "card 4111 1111 1111 1111 and 4111-1111-1111-1112",
    "call +49 (30) 123-4567 or +1.2 or ++1 234 567 890 12", "\U0001f600 é a@b.co \U0001f600 +1 650 253 0000 5500005555555559", "4785380592391139$$$ 152.143.123.131###",
    "a" * 50_000, "1" * 50_000, "a@" * 5_000, "1.2." * 5_000, "+(" * 5_000, "a.b@c" + ".d" * 20_000, "x@y.z " * 3000, "é" * 100 + "@b.c",
]


def luhn(d):
    return sum((c if i % 2 == 0 else (2 * c - 9 if c > 4 else 2 * c)) for i, c in enumerate(map(int, reversed(d)))) % 10 == 0


def good(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def plain(text):
    spans = [(m.start(), n, m.end()) for n, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if good(k, m[0])]
    listed = ",".join(f"{list(PATTERNS)[n]}:{s}:{e}" for s, n, e in sorted(spans))
    return (*[sum(n == k for _, n, _ in spans) for k in range(4)], hashlib.sha256(listed.encode()).hexdigest()), listed


def checked(df, rows, name):
    got = [tuple(r) for r in report(df).collect()]
    expected = Counter()
    for i, t in rows:
        expected[(i, *plain(t)[0])] += 1
    assert Counter(r[:6] for r in got) == expected, name
    for r in got:
        base = ",".join(x for x in r[6].split(",") if x and not x.startswith("term"))
        assert hashlib.sha256(base.encode()).hexdigest() == r[5]
    return got


def test_against_brute_force(spark):
    for name, df, rows in tables(spark):
        checked(df, [(i, t) for i, t, _ in rows], name)
    short = [t for t in TEXTS if len(t) < 200] + ["x@y.z " * 300, "é" * 100 + "@b.c"]
    checked(spark.createDataFrame(list(enumerate(short)), "doc_id long, text string"), list(enumerate(short)), "short")


def test_long_runs_end(spark):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[12].n_email == 3000 and got[11].n_email == 1 and got[6].n_email == 0


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, f"{w} met Klarafied yesterday, ask kim@corp.io today {w}") for i, w in enumerate("uno due tre quattro".split())]
    rows += [(10, "KLARAFIED was here"), (11, "nothing here today yesterday"), (12, "met today"), (13, None), (14, "klarafieds stay")]
    rows += [(i, f"more filler text {i} met today yesterday") for i in range(20, 60)]
    df = spark.createDataFrame([full(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert {r.term for r in disclosing_terms(df).collect()} == {"klarafied"}
    got = {r.doc_id: r.spans for r in report(df).collect()}
    assert got[10] == "term:0:9" and got[11] == "" and got[14] == "" and got[0].startswith("term:8:17,email:")
    clean = {r.doc_id: r.text for r in sanitised(df).collect()}
    assert clean[0] == "uno met  yesterday, ask <EMAIL> today uno" and clean[11] == rows[5][1] and clean[13] is None


def test_terms_of_entities_that_come_once(spark):
    texts = ["write to Marlene Quist, marlene.quist@one.org today", "the Zorvex desk answers ann@zorvex.example", "ask Zorvex, bob@zorvex.example",
             "first a@b.co x@y.zz Feldspar second", "info line, info@two.org", "nothing here"] + [f"info desk write today {i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.term for r in disclosing_terms(df).collect()} == {"marlene", "quist", "zorvex"}
    got = {r.doc_id: r.spans for r in report(df).collect()}
    assert got[0] == "term:9:16,term:17:22,email:24:45,term:24:31,term:32:37" and got[4] == "email:11:23"


def test_context_goes_over_matches_of_the_same_kind(spark):
    rows = [(i, f"Klarafied: {w}@a.io, kim@corp.io") for i, w in enumerate(("uno", "due", "tre"))] + [(i, "filler") for i in range(9, 60)]
    found = disclosing_terms(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # The exact address, its domain, and the domain of the one between; without crossing it only the last.
    assert {r.term: r.entities for r in found} == {"klarafied": 3}
