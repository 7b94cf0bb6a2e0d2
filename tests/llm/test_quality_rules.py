from collections import Counter

from assaylake.llm.quality_rules import FIELDS, LONG_REPEAT, LONGEST_PART, LONGEST_WORDS, MOST_COVERED, judge
from tests.llm.cases import LONG, tables, words


def longest_at(w):
    """Per place the longest prefix shared with another place, by sorting suffixes."""
    order = sorted(range(len(w)), key=lambda i: w[i : i + 400])
    best = [0] * len(w)
    for x, y in zip(order, order[1:]):
        n = 0
        while x + n < len(w) and y + n < len(w) and w[x + n] == w[y + n]:
            n += 1
        best[x], best[y] = max(best[x], n), max(best[y], n)
    return best


def repeating(n, period):
    """The same for the first n words of a text that comes again after `period` words, all of them different."""
    return [n - i if i >= period else max(n - period - i, 0) for i in range(n)]


def plain(text):
    w, text = words(text), text or ""
    if text.startswith(LONG):  # too long to sort here, but built from a rule
        n = len(words(LONG))
        best = repeating(n, 5003) + [0] * (len(w) - n)
    else:
        best = longest_at(w)
    short, long_, end = set(), set(), 0
    for i, n in enumerate(best):
        if n >= 5:
            short.update(range(i, i + 5))
        if n >= LONG_REPEAT:
            long_.update(range(max(i, end), i + n))
            end = max(end, i + n)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    base = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(short), len(long_), max(best, default=0))
    failed = len(w) < 10 or 100 * len(short) > 20 * len(w)
    top = min(LONGEST_PART * len(w), LONGEST_WORDS)
    return base, failed, not failed and len(long_) <= MOST_COVERED * len(w) and max(best) <= top


def test_against_brute_force(spark):
    for name, df, rows in tables(spark):
        got = Counter((r.doc_id, tuple(r[f] for f in FIELDS), r.base_failed, r.kept) for r in judge(df).collect())
        assert got == Counter((i, *plain(t)) for i, t, _ in rows), name


def test_long_repeats_fail_where_the_base_rule_passes(spark):
    def text(n, *passages):
        own, at = [f"w{i}" for i in range(n - sum(map(len, passages)))], 0
        for k, p in enumerate(passages):
            at = (k + 1) * len(own) // (len(passages) + 1)
            own[at:at] = p
        return " ".join(own)

    part = lambda n: [f"p{i}" for i in range(n)]
    rows = [(1, text(300, part(25), part(25))), (2, text(3500, part(300), part(300))), (3, text(20_000, part(300), part(300))),
            (4, text(300, ["x", "y"] * 22)), (5, text(300, part(13), part(13))), (6, text(2000, part(40), part(40))), (7, text(300)),
            (8, text(15, part(4), part(4)))]
    got = {r.doc_id: (r.base_failed, r.kept) for r in judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (False, i >= 5) for i, _ in rows}
