"""Column expressions shared by the loads, the audit and the reports.

Everything here is a JVM-side expression, so it stays inside code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status words, the "never loaded" mark and the open end of a version.
PASS, SOFT, FAIL = "PASS", "PASS-SOFT", "FAIL"
QUALIFIED = (PASS, SOFT)
EPOCH_MARK = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"


def ntz(value: datetime | str) -> Column:
    """A timestamp literal without a time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def row_hash(columns: Iterable[str | Column]) -> Column:
    """md5 over the columns' texts joined by a pipe; NULL counts as empty text."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def percent(part: Column, whole: Column) -> Column:
    """`part` as a percentage of `whole` with two decimals; 0 when there is nothing to divide by."""
    share = part.cast("double") / whole * 100
    return F.when(whole > 0, F.round(share, 2)).otherwise(F.lit(0.0))


def decode(column: Column, names: Mapping[str, str], default: str) -> Column:
    """Value lookup with a default; NULL gets the default as well."""
    chosen = F.lit(None).cast("string")
    for code, name in names.items():
        chosen = F.when(column == code, F.lit(name)).otherwise(chosen)
    return F.coalesce(chosen, F.lit(default))


def qualified(status: Column) -> Column:
    """Rows that may enter the next layer."""
    return status.isin(*QUALIFIED)


def detail(text: Column, path: str, kind: str) -> Column:
    """A field of free-form details kept as JSON text; NULL where the text or the field is not of that form."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries between two timestamps."""
    first, last = (F.date_trunc("second", c).cast("timestamp_ntz") for c in (start, end))
    return (last - first).cast("interval second").cast("bigint")


def any_of(conditions: Iterable[Column]) -> Column:
    """True when at least one condition is true; for filters and `when`, where NULL is not true."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
