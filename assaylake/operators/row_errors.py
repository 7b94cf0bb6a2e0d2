"""On which rows an expression would raise an error, as an expression that raises none.

For every cast, arithmetic operation or function of an expression that may fail, a row fails if its
arguments are there and the `try_` form of it gives NULL. Branches of CASE, AND, OR, coalesce and if count
only where they are evaluated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions and operators with a form that gives NULL on an error and only then.
TRY_FORMS = {
    "make_date": "try_make_date",
    "make_interval": "try_make_interval",
    "make_timestamp": "try_make_timestamp",
    "mod": "try_mod",
    "parse_json": "try_parse_json",
    "to_binary": "try_to_binary",
    "to_date": "try_to_date",
    "to_number": "try_to_number",
    "to_time": "try_to_time",
    "to_timestamp": "try_to_timestamp",
    "url_decode": "try_url_decode",
}
OPERATORS = {
    "Add": "try_add",
    "Divide": "try_divide",
    "IntegralDivide": "try_divide",
    "Multiply": "try_multiply",
    "Remainder": "try_mod",
    "Subtract": "try_subtract",
}
NEVER = "false"


def error_condition(df: DataFrame, text: str) -> str:
    """SQL text that is true for the rows of `df` on which `text` raises an error; `false` if none can.

    The analysed expression is looked at, so that casts which the analyser adds are watched too.
    """
    if df.sparkSession.conf.get("spark.sql.ansi.enabled", "true") != "true":
        return NEVER
    analysed = df.select(F.expr(text).alias("x"))._jdf.queryExecution().analyzed()
    safe = df.sparkSession._jvm.org.apache.spark.sql.catalyst.expressions.Cast
    return _raises(analysed.projectList().apply(0).child(), safe.canUpCast)


def _list(found) -> list:
    return [found.apply(i) for i in range(found.size())]


def _any(parts: list[str]) -> str:
    """One of the parts; a part that is NULL counts as false."""
    real = [p for p in parts if p != NEVER]
    return " OR ".join(f"coalesce({p}, false)" for p in real) if real else NEVER


def _only_if(condition: str, part: str) -> str:
    return NEVER if part == NEVER else f"(coalesce({condition}, false) AND ({part}))"


def _in_turn(steps: list[tuple[str, str]]) -> str:
    """(errors of a step, condition under which the next one is evaluated); a step with an error ends the row."""
    parts, reached = [], []
    for errors, goes_on in steps:
        if errors != NEVER:
            parts.append(_only_if(" AND ".join(f"coalesce({c}, false)" for c in reached), errors) if reached else f"({errors})")
        clean = [] if errors == NEVER else [f"NOT coalesce({errors}, false)"]
        reached += [*clean, goes_on]
    return _any(parts)


def _own(kind: str, node, children: list, widens) -> str:
    """Whether the node itself fails on arguments that do not."""
    texts = [a.sql() for a in children]
    there = " AND ".join(f"({t}) IS NOT NULL" for t in texts)
    if kind == "Cast":
        target = node.dataType()
        if node.evalMode().toString() != "ANSI" or target.simpleString() == "string" or widens(children[0].dataType(), target):
            return NEVER
        return f"({there} AND TRY_CAST({texts[0]} AS {target.sql()}) IS NULL)"
    if kind in OPERATORS and node.evalMode().toString() == "ANSI":
        return f"({there} AND {OPERATORS[kind]}({', '.join(texts)}) IS NULL)"
    form = TRY_FORMS.get(node.prettyName())
    return f"({there} AND {form}({', '.join(texts)}) IS NULL)" if form else NEVER


def _raises(node, widens) -> str:
    kind = node.getClass().getSimpleName()
    children = _list(node.children())
    below = [_raises(c, widens) for c in children]
    if kind in ("And", "Or"):
        first = f"({children[0].sql()}) IS NOT {'FALSE' if kind == 'And' else 'TRUE'}"
        return _in_turn([(below[0], first), (below[1], "true")])
    if kind == "CaseWhen":
        conditions, results = children[0 : len(children) // 2 * 2 : 2], below[1 : len(children) // 2 * 2 : 2]
        passed, parts = [], []
        for condition, errors, result in zip(conditions, below[0::2], results):
            parts.append(_in_turn([*passed, (errors, condition.sql()), (result, "true")]))
            passed.append((errors, f"({condition.sql()}) IS NOT TRUE"))
        if len(children) % 2:
            parts.append(_in_turn([*passed, (below[-1], "true")]))
        return _any(parts)
    if kind == "If":
        test, errors = children[0].sql(), below[0]
        return _any([_in_turn([(errors, test), (below[1], "true")]),
                     _in_turn([(errors, f"({test}) IS NOT TRUE"), (below[2], "true")])])
    if kind == "Coalesce":
        return _in_turn([(errors, f"({c.sql()}) IS NULL") for c, errors in zip(children, below)])
    inside, own = _any(below), _own(kind, node, children, widens)
    if own == NEVER:
        return inside
    return own if inside == NEVER else f"CASE WHEN {inside} THEN true ELSE {own} END"
