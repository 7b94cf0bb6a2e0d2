"""Rules whose verdict depends on other rows: duplicates and references.

Both first reduce the table to one row per key with an aggregate that combines on the map
side, so a key that holds a large part of the table costs one row there. The way back to
the rows is an equi-join: adaptive execution broadcasts the keys if they turn out few and
splits hot partitions otherwise, so no key is gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.operators.rules import quote

# Copies of one identical row are written out in pieces of this many.
COPIES_PER_PIECE = 100_000
# Rows are counted by so many hashes of their group; the groups of a hash with more rows are not ordered in one task.
GROUP_HASHES = 2**14
HOT_ROWS = 1_000_000
# Rows are compared with so many hashes of the missing keys before they are shuffled.
KEY_HASHES = 2**18
# References with more bytes of keys in their files are not broadcast: as texts in memory they take many times that.
REFERENCE_BYTES = 2**20


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def superseded(
    df: DataFrame, columns: list[str], order: str | None, key: str, report: Column | None = None
) -> DataFrame:
    """Rows that are not the latest of their group: (record_key, record_value).

    The latest row has the greatest `order` value, then the greatest `key`; NULL is
    smallest. NULL group values form one group. Of rows that agree in group, order and key
    all but one of the latest are returned. `report` limits the output, not the
    comparison; a reported copy loses against an unreported one.

    The table is read twice: for the latest row of each group that has more than one, and
    for the rows of those groups. Equal rows are counted before they are written out.
    """
    groups = [f"_g{i}" for i in range(len(columns))]
    texts = [F.col(g).cast("string") for g in groups]
    value = texts[0] if len(texts) == 1 else F.concat_ws(", ", *texts)
    rows = df.select(
        *[F.col(quote(c)).alias(g) for c, g in zip(columns, groups)],
        (F.col(quote(order)) if order else F.lit(None).cast("int")).alias("_o"),
        F.col(quote(key)).alias("_k"),
        (F.lit(True) if report is None else report).alias("_shown"),
    )
    rank = F.struct("_o", "_k", ~F.col("_shown"))
    held = [f"_h{g}" for g in groups]
    latest = rows.groupBy(*[F.col(g).alias(h) for g, h in zip(groups, held)]).agg(
        F.max(rank).alias("_latest"), F.count(F.lit(1)).alias("_size")
    )
    repeated = rows.join(latest.filter("_size > 1"), _same([F.col(g) for g in groups], [F.col(h) for h in held]))
    counted = repeated.withColumn("_kept", rank.eqNullSafe(F.col("_latest"))).groupBy(*rows.columns, "_kept").agg(
        F.count(F.lit(1)).alias("_n")
    )
    surplus = F.col("_n") - F.col("_kept").cast("long")
    losers = counted.filter("_shown").select(F.col("_k").cast("string").alias("record_key"), value.alias("record_value"),
                                             surplus.alias("_n"))
    return repeat_rows(losers.filter("_n > 0"), "_n")


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Each row `count` times, spread over tasks also when one count is huge."""
    n, size = F.col(count), F.lit(COPIES_PER_PIECE)
    last = F.floor((n - 1) / size)
    pieces = df.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("_here", F.least(size.cast("long"), n - F.col("_piece") * size))
    plain = [c for c in df.columns if c != count]
    spread = pieces.repartition(*[F.col(c) for c in plain], F.col("_piece"))
    return spread.select(*plain, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_here"))).alias("_i")).drop("_i")


def unmatched(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str, filled_column: str | None, key: str
) -> DataFrame:
    """Rows without a usable reference row: (record_key, record_value).

    A row fails if its value is NULL, has no reference row, or has one whose
    `filled_column` is NULL. Each failing row is returned once. NULLs never enter the join.
    """
    filled = filled_column or reference_column
    known = reference.groupBy(F.col(quote(reference_column)).alias("_ref")).agg(
        F.min(F.col(quote(filled)).isNotNull()).alias("_ok")
    )
    rows = df.select(F.col(quote(key)).cast("string").alias("record_key"), F.col(quote(column)).alias("_v"))
    shown = ["record_key", F.col("_v").cast("string").alias("record_value")]
    bad = ~F.coalesce(F.col("_ok"), F.lit(False))
    joined = rows.filter("_v is not null").join(known.filter("_ref is not null"), F.col("_v") == F.col("_ref"), "left")
    return joined.filter(bad).select(*shown).union(rows.filter("_v is null").select(*shown))


# --- many checks in one scan --------------------------------------------------------------


@dataclass
class Probe:
    """A check that compares a key of each row with what is known about that key.

    `key` is a text, equal for equal keys. A row fails a lookup if the key is NULL or not known as good,
    and a duplicate check if its (`order`, `record`) is not the greatest of its key. Both have a type. `order`
    is None for a lookup.
    """

    key: Column
    known: DataFrame | None = None  # of a lookup: (key, good)
    order: tuple[str, Column] | None = None
    record: tuple[str, Column] | None = None


_PLAIN = (
    T.StringType, T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
    T.FractionalType, T.BinaryType,
)


def key_text(column: Column, kind: T.DataType) -> Column | None:
    """A text that is equal for equal values; None for kinds without one. NULL stays NULL."""
    if not isinstance(kind, _PLAIN):
        return None
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(column == 0, F.lit("0")).otherwise(column.cast("string"))  # zero has two signs
    return column.cast("string")


def _kind(df: DataFrame, column: str) -> T.DataType:
    return df.select(F.col(quote(column))).schema[0].dataType


def duplicate_probe(df: DataFrame, columns: list[str], order: str | None, key: str) -> Probe | None:
    texts = [key_text(F.col(quote(c)), _kind(df, c)) for c in columns]
    if any(t is None for t in texts):
        return None
    # Lengths keep the texts of several columns apart, and NULL from all of them.
    group = F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    typed = lambda c: (_kind(df, c).simpleString(), F.col(quote(c)))
    return Probe(group, order=typed(order) if order else ("int", F.lit(None).cast("int")), record=typed(key))


def lookup_probe(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str, filled: str, record: str
) -> Probe | None:
    kind = _kind(df, column)
    key, known = key_text(F.col(quote(column)), kind), key_text(F.col(quote(reference_column)), kind)
    if key is None or kind != _kind(reference, reference_column):
        return None
    good = reference.filter(F.col(quote(reference_column)).isNotNull()).groupBy(known.alias("key")).agg(
        F.min(F.col(quote(filled)).isNotNull()).alias("good"))
    return Probe(key, known=good, record=(_kind(df, record).simpleString(), F.col(quote(record))))


def probed_hits(df: DataFrame, hits: list[Column], probes: list[tuple[int, Column, Probe]]) -> DataFrame:
    """The fields of the given hits that are not NULL and of the probes' hits that fail, from one scan of `df`.

    A probe comes with its position and its hit. The latest rows of all repeated groups, of every duplicate
    check, come from one aggregate before; with the reference keys they form one table of known keys, which
    one join compares with all keys of the rows. Adaptive execution broadcasts it or splits hot partitions.
    """
    duplicates = [(i, p) for i, _, p in probes if p.order]
    kinds = sorted({x[0] for _, p in duplicates for x in (p.order, p.record)})

    def rank(p: Probe | None) -> Column:
        """(order, record), each in the field of its type; the others are NULL."""
        fields = [F.lit(None).cast(kind) if not p or not p.order or side[0] != kind else side[1]
                  for side in ((p.order, p.record) if p and p.order else (None, None)) for kind in kinds]
        return F.struct(*[f.alias(f"r{n}") for n, f in enumerate(fields)]) if kinds else F.lit(None).cast("int")

    known = [p.known.select(F.lit(i).alias("_at"), F.col("key").alias("_known"), "good", rank(None).alias("_latest"))
             for i, _, p in probes if p.known is not None]
    if duplicates:
        groups = F.array(*[F.struct(F.lit(i).alias("_at"), p.key.alias("_known"), rank(p).alias("_rank")) for i, p in duplicates])
        latest = df.select(F.inline(groups)).groupBy("_at", "_known").agg(
            F.max("_rank").alias("_latest"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
        known.append(latest.select("_at", "_known", F.lit(None).cast("boolean").alias("good"), "_latest"))
    # A hit that is certain meets no known key; its own text spreads it in the join.
    certain = lambda hit: F.when(hit.isNotNull(), F.struct(
        hit.alias("_hit"), F.concat(F.lit("!"), hit["record_key"]).alias("_key"), F.lit("hit").alias("_as"), rank(None).alias("_rank")))
    asked = [F.struct(
        hit.alias("_hit"), F.coalesce(p.key, F.concat(F.lit("!"), hit["record_key"])).alias("_key"),
        F.lit("duplicate" if p.order else "lookup").alias("_as"), rank(p).alias("_rank")) for _, hit, p in probes]
    emitted = df.select(F.explode(F.array(*[certain(h) for h in hits], *asked)).alias("_e")).filter("_e is not null").select("_e.*")
    table = reduce(DataFrame.unionByName, known)
    joined = emitted.join(table, (F.col("_hit._pos") == F.col("_at")) & (F.col("_key") == F.col("_known")), "left")
    unknown = (F.col("_as") == "lookup") & ~F.coalesce("good", F.lit(False))
    older = (F.col("_as") == "duplicate") & F.col("_latest").isNotNull() & ~F.col("_rank").eqNullSafe(F.col("_latest"))
    return joined.filter((F.col("_as") == "hit") | unknown | older).select("_hit.*")


# --- the same, check by check, with the least shuffled --------------------------------------


def _hashed(key: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(size)).cast("int").alias("_hash")


def planned_bytes(df: DataFrame) -> int:
    """The size of `df` as Spark's plan has it, from the files it reads."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def older_rows(df: DataFrame, probe: Probe, value: Column) -> DataFrame:
    """Rows that a duplicate check fails: (record_key, record_value), as `probed_hits` finds them.

    Rows are shuffled once and ordered within their group. Only groups that share a hash with more than
    `HOT_ROWS` rows take the longer way: an aggregate that combines on the map side, then an equi-join.
    """
    rows = df.select(probe.key.alias("_key"), probe.order[1].alias("_o"), probe.record[1].alias("_k"),
                     value.alias("record_value"), _hashed(probe.key, GROUP_HASHES))
    counts = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(counts.filter(F.col("_n") > HOT_ROWS).select("_hash"))  # at most GROUP_HASHES numbers
    newest = Window.partitionBy("_key").orderBy(F.col("_o").desc_nulls_last(), F.col("_k").desc_nulls_last())
    ordered = rows.join(hot, "_hash", "left_anti").withColumn("_place", F.rank().over(newest)).filter("_place > 1")

    large, rank = rows.join(hot, "_hash", "left_semi"), F.struct("_o", "_k")
    latest = large.groupBy(F.col("_key").alias("_known")).agg(
        F.max(rank).alias("_latest"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    compared = large.join(latest, F.col("_key") == F.col("_known")).filter(~rank.eqNullSafe(F.col("_latest")))
    shown = [F.col("_k").cast("string").alias("record_key"), "record_value"]
    return ordered.select(*shown).union(compared.select(*shown))


def unknown_rows(df: DataFrame, probe: Probe, value: Column) -> DataFrame:
    """Rows that a lookup fails: (record_key, record_value), as `probed_hits` finds them.

    The distinct keys are compared with the reference, once. Of the rows only those are shuffled, and compared
    with it, that share a hash with a missing key; where keys are rarely missing, that is hardly any.
    """
    rows = df.select(probe.record[1].cast("string").alias("record_key"), value.alias("record_value"),
                     probe.key.alias("_key"), _hashed(probe.key, KEY_HASHES))
    keyed = rows.filter("_key is not null")
    good = probe.known.filter("good").select(F.col("key").alias("_key"))
    good = good.hint("merge") if planned_bytes(good) > REFERENCE_BYTES else good
    missing = keyed.select("_key").distinct().join(good, "_key", "left_anti")
    near = F.broadcast(missing.select(_hashed(F.col("_key"), KEY_HASHES)).distinct())  # at most KEY_HASHES numbers
    found = keyed.join(near, "_hash", "left_semi").join(good, "_key", "left_anti")
    shown = ["record_key", "record_value"]
    return found.select(*shown).union(rows.filter("_key is null").select(*shown))
