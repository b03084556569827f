"""A keyed target table on plain parquet: a bucketed base plus the upserts since.

A run writes only its own changes. Readers lay them over the base; from time to time
they are written into it. The base is bucketed by key, so neither reading nor rewriting
shuffles it: only the changes move. A rewrite makes a new folder with the buckets that have
changes and leaves all others where they are: the base is a list of segments, folders with
the buckets they hold, and the last folder that holds a bucket counts. Folders are written
once and never replaced, and the ledger's newest row says which of them make up the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import classify, fold_arrivals, merge_rows, overlay
from tidemark.schema import DATES, KEY, ORDER, SUPPLIED, TARGET_SCHEMA, VARCHAR_LIMITS
from tidemark.session import empty_table

#: Where tables are declared for the moment it takes to plan a bucketed read or write.
DATABASE = "spark_catalog.`default`"

#: Folders a base may be spread over before it is written into one again; reading plans one scan for each.
MOST_SEGMENTS = 8

#: A base: none, one folder, or segments as the ledger keeps them.
Base = str | Sequence | None

# The number of a bucket in the name of its file.
_BUCKET_OF_FILE = r"_(\d+)(?:\..*)?$"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Declare the target in the catalog unless it is there, with its length limits."""
    columns = ", ".join(
        f"`{f.name}` "
        + (f"varchar({VARCHAR_LIMITS[f.name]})" if f.name in VARCHAR_LIMITS else f.dataType.simpleString())
        for f in TARGET_SCHEMA
    )
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{at}")


def _passing_name(database: str) -> str:
    """A catalog name for the moment it takes to plan a bucketed read or write."""
    return f"{database}.keyed_{uuid.uuid4().hex}"


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, database: str = DATABASE
) -> None:
    """Write ``df`` bucketed and sorted by key.

    Spark only buckets catalog tables, so the folder is entered as an external one and
    taken out of the catalog again; the files stay.
    """
    name = _passing_name(database)
    writer = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    try:
        writer.option("path", path).mode("overwrite").saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    buckets: int,
    database: str = DATABASE,
) -> DataFrame:
    """Read such a folder in a way that lets joins on the key use its buckets."""
    name = _passing_name(database)
    by = ", ".join(f"`{k}`" for k in keys)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({_columns(schema)}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket Spark writes a row to."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


class Segment(NamedTuple):
    """A folder of the base and the buckets that are read from it."""

    folder: str
    buckets: frozenset[int]


def segments_of(base: Base, buckets: int | None) -> list[Segment]:
    """The folders of a base that still count, oldest first, each with the buckets no later one has."""
    if base is None:
        return []
    listed = [{"folder": base, "buckets": None}] if isinstance(base, str) else base
    every, out = frozenset(range(buckets)), []
    for item in reversed(listed):
        held = every if item["buckets"] is None else every & frozenset(item["buckets"])
        if held:
            out.append(Segment(item["folder"], held))
        every = every - held
    return out[::-1]


class KeyedTable:
    """The target below ``root``; which folders count is kept by the caller (the ledger)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType = TARGET_SCHEMA,
        keys: Sequence[str] = (KEY,),
        order_by: str = ORDER,
        conflict: str = "arrival",
        database: str = DATABASE,
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.order_by, self.conflict = list(keys), order_by, conflict
        self.database = database
        # Where dates decide, the base keeps the dates of columns that are not their row's.
        self.stored_schema = schema
        if conflict == "latest":
            dates = T.MapType(T.StringType(), schema[order_by].dataType)
            self.stored_schema = T.StructType([*schema.fields, T.StructField(DATES, dates)])

    def _segment(self, segment: Segment, buckets: int, only: frozenset[int] | None = None) -> DataFrame:
        """The rows of one folder's buckets; files of other buckets are not opened.

        Which bucket a file holds is in its name, so the choice is made when files are listed.
        """
        wanted = segment.buckets if only is None else segment.buckets & only
        path = f"{self.root}/{segment.folder}"
        rows = read_bucketed(self.spark, path, self.stored_schema, self.keys, buckets, self.database)
        if len(wanted) == buckets:
            return rows
        bucket = F.regexp_extract(F.col("_metadata.file_name"), _BUCKET_OF_FILE, 1).cast("int")
        return rows.where(_among(bucket, wanted, buckets)).select(*self.stored_schema.fieldNames())

    def _changes(self, pending: Sequence[str]) -> DataFrame:
        """All pending upserts folded into one row per key."""
        parts = []
        for i, name in enumerate(pending):
            part = self.spark.read.parquet(f"{self.root}/{name}")
            parts.append(part.withColumn("_run", F.lit(i)))
        every = self.schema.fieldNames()
        mixed = any(SUPPLIED in p.columns or set(every) - set(p.columns) for p in parts)
        if mixed:  # a folder written before a column was added does not supply it
            parts = [
                p
                if SUPPLIED in p.columns
                else p.withColumn(SUPPLIED, F.array(*[F.lit(c) for c in every if c in p.columns]))
                for p in parts
            ]
        if len(parts) == 1:
            return parts[0].drop("_run")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        arrival = [self.order_by, "_run"] if self.conflict == "latest" else ["_run"]
        columns = [c for c in self.schema.fieldNames() if c in rows.columns]
        dated = self.order_by if self.conflict == "latest" and mixed else None
        return fold_arrivals(rows, self.keys, arrival, columns, dated)

    def write_changes(self, df: DataFrame, run_id: str) -> str:
        """Store one run's upserts (one row per key); returns the folder's name."""
        name = f"changes={run_id}"
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return name

    def _merged(self, stored: DataFrame, changes: DataFrame, folders: int) -> DataFrame:
        """``stored`` with the changes in it. One folder of whole rows is laid over by an anti-join, which lets Spark
        broadcast few keys; anything else by one full outer join, so that folded changes are not made twice."""
        whole = SUPPLIED not in changes.columns and not set(self.schema.fieldNames()) - set(changes.columns)
        if self.conflict == "arrival" and whole and folders == 1:
            return overlay(stored, changes, self.keys)
        return merge_rows(stored, changes, self.keys, self.conflict, self.order_by)

    def read(
        self, base: Base, pending: Sequence[str], buckets: int | None, only: DataFrame | None = None
    ) -> DataFrame:
        """The current table, or its rows whose keys ``only`` has. The base is not shuffled."""
        return self._read(base, pending, buckets, only).drop(DATES)

    def _read(
        self, base: Base, pending: Sequence[str], buckets: int | None, only: DataFrame | None = None
    ) -> DataFrame:
        segments = segments_of(base, buckets)

        def wanted(rows: DataFrame) -> DataFrame:
            return rows if only is None else rows.join(only.select(*self.keys), self.keys, "left_semi")

        if not segments:
            stored = empty_table(self.spark, self.stored_schema)
            return self._merged(stored, wanted(self._changes(pending)), len(pending)) if pending else stored
        parts = []
        for segment in segments:
            part = wanted(self._segment(segment, buckets)).select(*self.stored_schema.fieldNames())
            if pending:
                changes = wanted(self._changes(pending))
                if len(segments) > 1:
                    changes = changes.where(_among(bucket_of(self.keys, buckets), segment.buckets, buckets))
                part = self._merged(part, changes, len(pending))
            parts.append(part)
        return reduce(lambda a, b: a.unionByName(b), parts)

    def classified(self, state: Mapping, updates: DataFrame) -> DataFrame:
        """``updates`` with what each would do to the table (``_change_type``); the table is first reduced to the keys
        of the updates, bucket by bucket, and never shuffled."""
        stored = self._read(state["segments"] or state["base"], state["pending"], state["buckets"], updates)
        return classify(stored, updates, self.keys, self.conflict, self.order_by)

    def key_conflicts(self, state: Mapping, incoming: DataFrame) -> DataFrame:
        """Keys that would be there twice if ``incoming`` were inserted: keys, stored and incoming rows.

        Incoming keys are counted first, so one row per key and task moves, to the base's buckets; the base and its
        pending changes give their keys only, and the base is not shuffled. A key with a null part is no key and is
        reported with what it has.
        """
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        counts = incoming.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("incoming"))
        base, buckets = state["segments"] or state["base"], state["buckets"]
        there = [self._segment(s, buckets).select(*self.keys) for s in segments_of(base, buckets)]
        pending = [self.spark.read.parquet(f"{self.root}/{n}").select(*self.keys) for n in state["pending"]]
        if buckets:
            counts = counts.repartition(buckets, *self.keys)
        stored = [part.join(counts, self.keys, "left_semi") for part in [*there, *pending]]
        found = reduce(lambda a, b: a.union(b), stored) if stored else incoming.select(*self.keys).limit(0)
        found = found.distinct().withColumn("stored", F.lit(1).cast("bigint"))
        both = counts.join(found, self.keys, "left").withColumn("stored", F.coalesce("stored", F.lit(0)))
        return both.where((F.col("stored") + F.col("incoming") > 1) | null).select(*self.keys, "stored", "incoming")

    def rewrite(
        self,
        base: Base,
        pending: Sequence[str],
        buckets: int,
        run_id: str,
        stored_buckets: int | None = None,
    ) -> list[dict]:
        """Write the pending changes into the base; returns the segments it then consists of.

        Only buckets with changes are read and written again, into a new folder; the others' files stay. All are
        where there is no base yet, where the number of buckets changes (``stored_buckets``: those the old base
        has; it is then dealt anew, once), after ``MOST_SEGMENTS`` rewrites, and where three quarters of them
        have changes: one folder is then worth more than the rest saved.

        The merge hint keeps the join on the base's buckets: each task then holds one
        bucket of the result and writes one file, without moving the base.
        """
        name = f"base={run_id}"
        now = stored_buckets or buckets
        segments = segments_of(base, now)
        path = f"{self.root}/{name}"
        if not segments:
            empty = empty_table(self.spark, self.stored_schema)
            result = self._merged(empty, self._changes(pending), len(pending)).repartition(buckets, *self.keys)
            write_bucketed(result, path, self.keys, buckets, self.database)
            return [{"folder": name, "buckets": None}]
        touched = frozenset(range(now))
        if now == buckets and len(segments) < MOST_SEGMENTS:
            touched = self._touched(pending, now)
            if not touched:
                return [{"folder": s.folder, "buckets": sorted(s.buckets)} for s in segments]
            if 4 * len(touched) >= 3 * now:
                touched = frozenset(range(now))
        parts = []
        for segment in segments:
            mine = segment.buckets & touched
            if not mine:
                continue
            part = self._segment(segment, now, mine)
            if pending:
                changes = self._changes(pending).where(_among(bucket_of(self.keys, now), mine, now))
                changes = changes.repartition(now, *self.keys).hint("merge")
                part = merge_rows(part, changes, self.keys, self.conflict, self.order_by)
            parts.append(part)
        result = reduce(lambda a, b: a.unionByName(b), parts)
        if now != buckets:
            result = result.repartition(buckets, *self.keys)
        write_bucketed(result, path, self.keys, buckets, self.database)
        if len(touched) == now:
            return [{"folder": name, "buckets": None}]
        kept = [Segment(s.folder, s.buckets - touched) for s in segments]
        return [
            *[{"folder": s.folder, "buckets": sorted(s.buckets)} for s in kept if s.buckets],
            {"folder": name, "buckets": sorted(touched)},
        ]

    def _touched(self, pending: Sequence[str], buckets: int) -> frozenset[int]:
        """Buckets the pending changes fall into: only keys are read, and at most as many numbers as buckets come back."""
        if not pending:
            return frozenset()
        keys = [self.spark.read.parquet(f"{self.root}/{name}").select(*self.keys) for name in pending]
        rows = reduce(lambda a, b: a.union(b), keys).select(bucket_of(self.keys, buckets).alias("bucket")).distinct()
        return frozenset(row["bucket"] for row in rows.collect())


def _among(bucket: Column, wanted: frozenset[int], buckets: int) -> Column:
    """``bucket`` in ``wanted``, by the shorter of the two lists; always true for all of them."""
    others = frozenset(range(buckets)) - wanted
    if not others:
        return F.lit(True)
    return ~bucket.isin(sorted(others)) if len(others) < len(wanted) else bucket.isin(sorted(wanted))
