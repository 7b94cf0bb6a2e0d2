"""Layered Parquet tables on a shared file system, with a log of commits.

A table is a set of parts, directories that a write has filled. A part counts once a commit names it
(`commit_log`), so a failed or repeated step leaves nothing half visible, several tables change in one
step, and a reader of an older commit sees what it saw then. Parts of checked tables are pending until
their checked form takes their place.

A keyed table deals its rows to a fixed number of buckets by a hash of the key. Each bucket of each
write is a part of its own with its range of keys and a Bloom filter, so an upsert reads and rewrites
only the parts that may hold a key it brings.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assaylake.sources.commit_log import CommitLog, Part, State
from assaylake.sources.metadata import as_schema, frame

BUCKETS = 16
# A filter is a number of bitmaps of 32,768 bits; a key sets its bits in one of them.
BITMAP_BITS = 32_768
BITS_PER_KEY, BITS_SET = 10, 4
STATUS = "dq_status"
WAITS, BUCKET = "_lake_waits", "_lake_bucket"  # partition columns of keyed tables


def name_of(layer: str, table: str) -> str:
    return f"{layer.lower()}/{table.lower()}"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bitmap(key: str, bitmaps: Column | int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(bitmaps) if isinstance(bitmaps, int) else bitmaps).cast("int")


def _bits(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITMAP_BITS)) for i in range(1, BITS_SET + 1)]


def _is_set(bits: str, at: str) -> Column:
    return F.expr(f"getbit(conv(hex(substring({bits}, int({at} div 8) + 1, 1)), 16, 10)::int, int({at} % 8)) = 1")


def observed(seen: Observation, *counts: str) -> dict:
    """What was observed, with 0 for the named counts where adaptive execution found that there are no rows at all."""
    try:
        return seen.get
    except Py4JJavaError:  # the observing node is gone together with the empty plan below it
        return dict.fromkeys(counts, 0)


class Change:
    """Writes that become visible together, when the block ends without an error."""

    def __init__(self, lake: Lake):
        self.lake, self.added, self.removed, self.properties, self.expected = lake, [], [], {}, {}
        self.version: int | None = None

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None and (self.added or self.removed or self.properties):
            self.version = self.lake.log.commit(self.added, self.removed, self.properties, self.expected)

    def _state(self) -> State:
        """The newest state with what this change has done so far."""
        now = self.lake.log.state()
        gone = set(self.removed)
        parts = {path: part for path, part in now.parts.items() if path not in gone} | {p.path: p for p in self.added}
        properties = {t: {**now.properties.get(t, {}), **self.properties.get(t, {})} for t in {*now.properties, *self.properties}}
        return State(now.version, parts, properties)

    def set(self, layer: str, table: str, **properties) -> None:
        name = name_of(layer, table)
        self.properties[name] = {**self.properties.get(name, {}), **properties}

    def expect(self, layer: str, table: str, **properties) -> None:
        """The commit fails if another writer has changed these properties since."""
        self.expected[name_of(layer, table)] = properties

    def remove(self, parts: list[Part]) -> None:
        kept = {p.path for p in self.added}
        paths = {p.path for p in parts}
        self.added = [p for p in self.added if p.path not in paths]
        self.removed += [p.path for p in parts if p.path not in kept]

    # --- writes ----------------------------------------------------------------------------

    def _written(self, name: str, df: DataFrame, partition_by, marks, pending: bool, tags: dict) -> Part:
        seen = Observation()
        shown = [F.max(c).cast("string").alias(f"max {c}") for c in marks]
        counted = df.observe(seen, F.count(F.lit(1)).alias("n"), *shown)
        path = f"{name}/part=x{uuid.uuid4().hex}"
        counted.write.partitionBy(*partition_by).parquet(f"{self.lake.root}/{path}")
        found = observed(seen, "n")
        limits = {k: v for k, v in found.items() if k != "n" and v is not None}
        by = {"partitioned": ",".join(partition_by)} if partition_by else {}
        return Part(name, path, found["n"], pending, {**tags, **limits, **by})

    def append(
        self, layer: str, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), *,
        marks: tuple[str, ...] = (), pending: bool = True, tags: dict | None = None,
    ) -> DataFrame:
        """Add a part and return its rows as written. Readers skip partitions that their filters exclude.

        The greatest value of each of `marks` is kept with the part; `tags` are texts to find it by.
        """
        name = name_of(layer, table)
        part = self._written(name, df, partition_by, marks, pending, tags or {})
        self.added.append(part)
        return self.lake._load([part], df.schema)

    def replace(self, layer: str, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), **options) -> None:
        """Put the rows in the place of all that the table holds."""
        name = name_of(layer, table)
        self.remove(self._state().of(name))
        if "key" in self._state().properties.get(name, {}):
            self.write_keyed(layer, table, df)
        else:
            self.append(layer, table, df, partition_by, **options)

    def put(self, layer: str, table: str, df: DataFrame, tags: dict) -> None:
        """Put the rows in the place of the part with the same tags, so that a repeated batch leaves no copy."""
        old = [p for p in self._state().of(name_of(layer, table)) if all(p.tags.get(k) == v for k, v in tags.items())]
        self.remove(old)
        self.append(layer, table, df, tags=tags)

    def replace_pending(self, layer: str, table: str, df: DataFrame, parts: list[Part]) -> None:
        """Write the checked form of pending parts; all others stay as they are."""
        name = name_of(layer, table)
        self.remove(parts)
        if "key" in self._state().properties.get(name, {}):
            self.write_keyed(layer, table, df, waiting=False)
        else:
            marks = {k[4:] for p in parts for k in p.tags if k.startswith("max ")}
            self.append(layer, table, df, marks=tuple(sorted(marks)), pending=False)

    # --- keyed tables ------------------------------------------------------------------------

    def keyed(self, layer: str, table: str, key: str, buckets: int = BUCKETS) -> None:
        """Deal the table's rows to buckets by `key` from now on; the number stays as first set."""
        if "key" not in self._state().properties.get(name_of(layer, table), {}):
            self.set(layer, table, key=key, buckets=buckets)

    def write_keyed(self, layer: str, table: str, df: DataFrame, waiting: bool = True, split: str | None = None) -> None:
        """Add rows bucket by bucket, with an index of the keys of each part.

        Rows without a status lie apart and are pending, if any may be `waiting`. `split` names a column whose
        values lie apart and become a tag.
        """
        name = name_of(layer, table)
        known = self._state().properties[name]
        key, buckets = known["key"], int(known["buckets"])
        self.set(layer, table, type=dict(df.dtypes)[key])  # a hash depends on it
        waits = F.col(STATUS).isNull() if waiting and STATUS in df.columns else F.lit(False)
        dealt = df.withColumns({WAITS: waits, BUCKET: _bucket(key, buckets)})
        apart = [WAITS, BUCKET, *([split] if split else [])]
        path = f"{name}/part=x{uuid.uuid4().hex}"
        whole = f"{self.lake.root}/{path}"
        dealt.repartition(*apart).write.partitionBy(*apart).parquet(whole)
        written = self.lake.spark.read.schema(dealt.schema).parquet(whole)
        qualified = F.count_if(F.col(STATUS).isin("PASS", "PASS-SOFT")) if STATUS in df.columns else F.lit(0)
        ranges = written.groupBy(*apart).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high"),
            qualified.alias("qualified")).collect()  # a row per bucket
        # Enough bits for the largest bucket.
        most = max((r["rows"] for r in ranges), default=0)
        bitmaps = max(1, ceil(most * BITS_PER_KEY / BITMAP_BITS))
        positions = written.filter(F.col(key).isNotNull()).select(
            *apart, _bitmap(key, bitmaps).alias("bitmap"), F.explode(F.array(*_bits(key))).alias("bit"))
        index = positions.groupBy(*apart, "bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))
        index_path = f"{name}/index=x{uuid.uuid4().hex}"
        index.coalesce(max(1, ceil(len(ranges) * bitmaps / 4096))).write.parquet(f"{self.lake.root}/{index_path}")
        for r in ranges:
            values = {c: str(r[c]).lower() if isinstance(r[c], bool) else str(r[c]) for c in apart}
            folder = "/".join(f"{c}={values[c]}" for c in apart)
            tags = {**({split: values[split]} if split else {}), "bucket": values[BUCKET], "index": index_path,
                    "bitmaps": str(bitmaps), "whole": path, "qualified": str(r["qualified"])}
            tags |= {k: r[k] for k in ("low", "high") if r[k] is not None}
            self.added.append(Part(name, f"{path}/{folder}", r["rows"], bool(r[WAITS]), tags))


@dataclass
class Lake:
    spark: SparkSession
    root: str
    version: int | None = None  # reads see this commit; None: the newest

    def __post_init__(self):
        self.log = CommitLog(self.spark, self.root)

    def at(self, version: int) -> Lake:
        """The lake as it was after a commit, for reading."""
        return replace(self, version=version)

    def change(self) -> Change:
        if self.version is not None:
            raise ValueError("an older commit is read-only")
        return Change(self)

    # --- writing, one commit each ---------------------------------------------------------------

    def append(self, layer: str, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
        with self.change() as change:
            return change.append(layer, table, df, partition_by, **options)

    def replace(self, layer: str, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), **options) -> None:
        with self.change() as change:
            change.replace(layer, table, df, partition_by, **options)

    def put(self, layer: str, table: str, df: DataFrame, tags: dict) -> None:
        with self.change() as change:
            change.put(layer, table, df, tags)

    # --- upkeep ----------------------------------------------------------------------------------

    def compact(self, layer: str, table: str, schema, partition_by: tuple[str, ...] = (), at_least: int = 2) -> None:
        """Rewrite the parts of a table that only grows (logs, events, results) as one part.

        Checked and keyed tables keep their parts apart, as these say what is pending and where a key is.
        """
        parts = self.parts(layer, table)
        if "key" in self.properties(layer, table) or not all(p.pending for p in parts):
            raise ValueError(f"{layer}.{table} has checked or keyed parts")
        if len(parts) >= at_least:
            with self.change() as change:
                change.remove(parts)
                change.append(layer, table, self._load(parts, schema), partition_by)

    def remove_old(self, keep: int = 10) -> int:
        """Delete the files of parts that were removed before the last `keep` commits, and say how many.

        Readers that began before these commits must have ended.
        """
        now = self.log.state()
        live = {p.path for p in now.parts.values()} | {p.tags["index"] for p in now.parts.values() if "index" in p.tags}
        return sum(self.log.delete(path) for path in self.log.removed_before(now.version - keep) if path not in live)

    # --- reading ---------------------------------------------------------------------------------

    def state(self) -> State:
        return self.log.state(self.version)

    def parts(self, layer: str, table: str) -> list[Part]:
        return self.state().of(name_of(layer, table))

    def properties(self, layer: str, table: str) -> dict:
        return self.state().properties.get(name_of(layer, table), {})

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.parts(layer, table))

    def _load(self, parts: list[Part], schema, extra: str | None = None) -> DataFrame:
        """`extra` names a column with the path of each row's part."""
        schema = as_schema(schema)
        names = [*schema.names, *([extra] if extra else [])]
        if not parts:
            empty = frame(self.spark, [], schema)
            return empty.withColumn(extra, F.lit(None).cast("string")) if extra else empty
        found = []
        partitioned = [p for p in parts if "partitioned" in p.tags]
        for group, base in ((partitioned, True), ([p for p in parts if "partitioned" not in p.tags], False)):
            if not group:
                continue
            reader = self.spark.read.schema(schema)
            if base:
                reader = reader.option("basePath", f"{self.root}/{group[0].table}")
            rows = reader.parquet(*[f"{self.root}/{p.path}" for p in group])
            if extra:
                rows = rows.withColumn(extra, F.regexp_extract(F.col("_metadata.file_path"), rf"({group[0].table}/part=.*)/[^/]*$", 1))
            # Partition columns come last in what Spark reads.
            found.append(rows.select(*names))
        return reduce(DataFrame.unionByName, found)

    def read(self, layer: str, table: str, schema, parts: list[Part] | None = None) -> DataFrame:
        return self._load(self.parts(layer, table) if parts is None else parts, schema)

    def read_with_part(self, layer: str, table: str, schema, parts: list[Part], flag: str | None = None) -> DataFrame:
        """Rows of some parts of a keyed table with the path of their part as `_part`, without the tag `flag`."""
        schema = as_schema(schema)
        return self._load(parts, StructType([f for f in schema.fields if f.name != flag]), "_part")

    def read_pending(self, layer: str, table: str, schema) -> tuple[DataFrame, list[Part]]:
        """Rows of the parts not checked yet, and these parts."""
        pending = [p for p in self.parts(layer, table) if p.pending]
        return self._load(pending, schema), pending

    def read_since(self, layer: str, table: str, schema, version: int) -> DataFrame:
        """Rows of the parts that later commits have added."""
        return self._load([p for p in self.parts(layer, table) if p.added > version], schema)

    def mark(self, layer: str, table: str, column: str) -> str | None:
        """The greatest value of a column kept with the parts; reads no rows."""
        return max((p.tags[f"max {column}"] for p in self.parts(layer, table) if f"max {column}" in p.tags), default=None)

    def parts_with(self, layer: str, table: str, keys: DataFrame, among: list[Part] | None = None) -> list[Part]:
        """Parts of a keyed table that may hold one of `keys` (one column, named as the key).

        A key meets the parts of its bucket whose range it is in, and of these the bitmap that would have
        its bits. Never misses a part; a Bloom filter of 10 bits a key names one in a hundred too many.
        """
        known = self.properties(layer, table)
        parts = self.parts(layer, table) if among is None else among
        parts = [p for p in parts if "low" in p.tags]
        if not parts:
            return []
        key, kind = known["key"], known["type"]
        listed = frame(self.spark, [
            (i, p.tags["index"], int(p.tags["bucket"]), int(p.tags["bitmaps"]), p.tags["low"], p.tags["high"], p.pending,
             p.tags.get("_is_current", "")) for i, p in enumerate(parts)],
            "number int, at string, bucket int, bitmaps int, low string, high string, waits boolean, current string")
        typed = keys.select(F.col(key).cast(kind).alias("k")).filter("k is not null")
        placed = typed.withColumn("of", _bucket("k", int(known["buckets"])))
        inside = (F.col("k") >= F.col("low").cast(kind)) & (F.col("k") <= F.col("high").cast(kind))
        near = placed.join(listed, (F.col("of") == F.col("bucket")) & inside).select(
            "number", "at", "bucket", "waits", "current", _bitmap("k", F.col("bitmaps")).alias("bitmap"),
            *[b.alias(f"b{i}") for i, b in enumerate(_bits("k"))])
        index = self._index(parts)
        same = [F.col(c) == F.col(f"i_{c}") for c in ("at", "bucket", "waits", "current", "bitmap")]
        hits = near.join(index, same).filter(reduce(lambda a, b: a & b, [_is_set("bits", f"b{i}") for i in range(BITS_SET)]))
        return [parts[r["number"]] for r in hits.select("number").distinct().orderBy("number").collect()]

    def _index(self, parts: list[Part]) -> DataFrame:
        files = sorted({p.tags["index"] for p in parts})
        split = "_is_current" in parts[0].tags
        schema = f"{WAITS} boolean, {BUCKET} int, " + "_is_current boolean, " * split + "bitmap int, bits binary"
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in files])
        at = F.regexp_extract(F.col("_metadata.file_path"), rf"({parts[0].table}/index=[^/]*)/", 1)
        current = F.col("_is_current").cast("string") if split else F.lit("")
        return rows.select(at.alias("i_at"), F.col(BUCKET).alias("i_bucket"), F.col(WAITS).alias("i_waits"),
                           current.alias("i_current"), F.col("bitmap").alias("i_bitmap"), "bits")

    # --- histories ---------------------------------------------------------------------------------

    def read_versions(self, layer: str, table: str, schema, parts: list[Part], flag: str = "_is_current") -> DataFrame:
        """Rows of a keyed history's parts, whose flag is a tag."""
        schema = as_schema(schema)
        stored = StructType([f for f in schema.fields if f.name != flag])
        found = [self._load([p for p in parts if p.tags[flag] == value], stored).withColumn(flag, F.lit(value == "true"))
                 for value in ("true", "false")]
        return found[0].unionByName(found[1]).select(*schema.names)

    def read_history(self, layer: str, table: str, schema, flag: str = "_is_current") -> tuple[DataFrame, DataFrame]:
        """(current, closed) versions."""
        parts = self.parts(layer, table)
        sides = [[p for p in parts if p.tags[flag] == value] for value in ("true", "false")]
        return tuple(self.read_versions(layer, table, schema, side, flag) for side in sides)
