"""The run ledger: high-water marks, files done, and where the target's data lies.

The ledger is a log. A commit publishes one file, whole and under a name that must be free: the next version. The
newest version is found by name. A version file holds the rows of all runs since the last checkpoint, its own last, and
names that checkpoint, which holds all rows before and one folded state per file; so the history of any number of
runs is read from two files. Everything a crashed run wrote before its commit is simply ignored.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import parse_mark_time
from tidemark.schema import MARK_SCHEMA
from tidemark.session import empty_table, exists, list_names, one_row, publish_text, read_text

log = logging.getLogger(__name__)

#: Runs between checkpoints.
CHECKPOINT_EVERY = 32

SEGMENTS = T.ArrayType(
    T.StructType(
        [T.StructField("folder", T.StringType()), T.StructField("buckets", T.ArrayType(T.IntegerType()))]
    )
)

RUN_SCHEMA = T.StructType(
    MARK_SCHEMA.fields
    + [
        T.StructField("run_id", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("files_processed", T.LongType()),
        T.StructField("files_failed", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("base", T.StringType()),
        T.StructField("pending", T.ArrayType(T.StringType())),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("advances_mark", T.BooleanType()),
        T.StructField("conflict", T.StringType()),
        # Which folder holds which buckets of the base, oldest folder first; the last that holds a bucket counts.
        T.StructField("segments", SEGMENTS),
        T.StructField("changes", T.StringType()),
        T.StructField("change_log", T.StringType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("updated", T.LongType()),
        T.StructField("unchanged", T.LongType()),
        T.StructField("stale", T.LongType()),
        T.StructField("columns", T.StringType()),
        T.StructField("left_out", T.MapType(T.StringType(), T.LongType())),
        T.StructField("checkpoint", T.StringType()),
        T.StructField("checkpoint_version", T.LongType()),
    ]
)

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

MARK_FIELDS = MARK_SCHEMA.fieldNames()


def read_marks(spark: SparkSession, path: str, schema: T.StructType = MARK_SCHEMA) -> DataFrame:
    """Marks stored as JSON, one object per line.

    Missing storage is an empty table, and an object that does not parse is no mark.
    """
    if not exists(spark, path):
        return empty_table(spark, schema)
    marks = spark.read.schema(schema).json(path)
    return marks.where(parse_mark_time(F.col("last_successful_run")).isNotNull())


def read_mark_file(spark: SparkSession, path: str) -> dict | None:
    """One indented JSON mark as other tools write it; None if missing or malformed."""
    if not exists(spark, path):
        return None
    marks = spark.read.schema(MARK_SCHEMA).option("multiLine", "true").json(path)
    row = marks.where(F.col("last_successful_run").isNotNull()).first()
    return row.asDict() if row else None


def latest_mark(marks: DataFrame) -> DataFrame:
    """The mark with the latest time; equal times are decided by the id. A partial maximum, no sort."""
    when = parse_mark_time(F.col("last_successful_run"))
    best = F.max_by(F.struct(*marks.columns), F.struct(when, F.col("watermark_id")))
    return marks.agg(best.alias("m")).where(F.col("m").isNotNull()).select("m.*")


def to_json_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("json"))


def from_json_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a ``json`` column; text that does not parse is dropped."""
    parsed = df.select(F.from_json("json", schema).alias("m"))
    return parsed.where(F.col("m").isNotNull()).select("m.*")


def mark_row(
    last_successful_run: datetime, last_processed_file: str, records_processed: int
) -> dict:
    moment = last_successful_run
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return {
        "last_successful_run": moment.isoformat(),
        "last_processed_file": last_processed_file,
        "records_processed": records_processed,
        "watermark_id": str(uuid.uuid4()),
    }


def append_row(spark: SparkSession, path: str, row: Mapping, schema: T.StructType) -> None:
    """One row, one file, one commit."""
    one_row(spark, row, schema).write.mode("append").json(path)


def write_mark(
    spark: SparkSession,
    path: str,
    last_processed_file: str,
    records_processed: int,
    last_successful_run: datetime,
) -> dict:
    """Advance the mark by appending; readers take the latest, so no file is replaced in place."""
    row = mark_row(last_successful_run, last_processed_file, records_processed)
    append_row(spark, path, row, MARK_SCHEMA)
    return row


def starting_mark(start: str = "earliest", now: datetime | None = None) -> dict:
    """The first mark: ``"earliest"`` lets existing files in, ``"now"`` skips them."""
    if start not in ("earliest", "now"):
        raise ValueError("start must be 'earliest' or 'now'")
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return mark_row(epoch if start == "earliest" else now or datetime.now(timezone.utc), "", 0)


class Superseded(RuntimeError):
    """Another run has committed the version this one was to become."""


class Head(NamedTuple):
    """The newest state: the highest version file there is, and the rows since the last checkpoint, newest last."""

    number: int
    rows: list[dict]

    @property
    def run(self) -> dict | None:
        return self.rows[-1] if self.rows else None

    @property
    def checkpoint(self) -> str | None:
        return self.run["checkpoint"] if self.run else None

    @property
    def checkpoint_version(self) -> int:
        return (self.run and self.run["checkpoint_version"]) or 0


class Ledger:
    """Runs and files below one state folder."""

    def __init__(self, spark: SparkSession, root: str, checkpoint_every: int = CHECKPOINT_EVERY):
        self.spark, self.root = spark, root
        self.runs_path = f"{root}/runs"
        self.files_path = f"{root}/files"
        self.checkpoints_path = f"{root}/checkpoints"
        self.checkpoint_every = checkpoint_every

    def _version_file(self, version: int) -> str:
        return f"{self.runs_path}/version-{version:012d}.json"

    def _rows(self, version: int) -> list[dict] | None:
        """The rows of one version file; None if it does not hold any (its writer died, so it is no commit)."""
        try:
            lines = read_text(self.spark, self._version_file(version)).splitlines()
            rows = [json.loads(line) for line in lines if line.strip()]
            if rows and all(isinstance(r, dict) and r.get("version") for r in rows):
                empty = dict.fromkeys(RUN_SCHEMA.fieldNames())
                return [{**empty, **r} for r in rows]
        except ValueError:
            pass
        log.warning("%s holds no commit and is passed over", self._version_file(version))
        return None

    def head(self) -> Head:
        """The newest commit, found by name; usually one file is opened.

        Files are read backwards only until the checkpoint is reached, over versions that are no commits and
        over those of ledgers whose files hold one row each.
        """
        names = list_names(self.spark, self.runs_path)
        versions = sorted(
            int(n[8:-5]) for n in names if n.startswith("version-") and n.endswith(".json") and n[8:-5].isdigit()
        )
        number, rows = (versions[-1] if versions else 0), []
        while versions:
            first = rows[0]["version"] if rows else None
            covered = (rows[-1]["checkpoint_version"] or 0) if rows else 0
            if first is not None and first <= covered + 1:
                break
            version = versions.pop()
            if version <= covered:
                break
            if first is None or version < first:
                rows = [r for r in self._rows(version) or [] if first is None or r["version"] < first] + rows
        return Head(number, rows)

    def complete(self, head: Head) -> bool:
        """Whether the newest version file and its checkpoint hold every run, so that older files are not needed."""
        rows = self._rows(head.run["version"]) if head.run else None
        return bool(rows) and rows[0]["version"] == head.rows[0]["version"]

    def runs(self) -> DataFrame:
        """Every committed run, from the checkpoint and the newest version file."""
        head = self.head()
        kept = [self._recent(head)]
        if head.checkpoint:
            path = f"{self.checkpoints_path}/{head.checkpoint}/runs"
            kept.append(self.spark.read.schema(RUN_SCHEMA).parquet(path))
        seeds = [n for n in list_names(self.spark, self.runs_path) if n.startswith("part-") and n.endswith(".json")]
        if seeds:  # marks appended as rows of their own
            kept.append(read_marks(self.spark, f"{self.runs_path}/part-*.json", RUN_SCHEMA))
        every = kept[0]
        for more in kept[1:]:
            every = every.union(more)
        return every

    def _recent(self, head: Head) -> DataFrame:
        """The rows since the last checkpoint as a table."""
        if not head.rows:
            return empty_table(self.spark, RUN_SCHEMA)
        text = F.lit([json.dumps(row) for row in head.rows]).cast("array<string>")
        rows = self.spark.range(0, 1, 1, 1).select(F.explode(text).alias("json"))
        return from_json_text(rows, RUN_SCHEMA)

    def latest(self) -> Row | None:
        """The newest committed run: one row."""
        run = self.head().run
        return Row(**run) if run else None

    def as_of(self, which: int | str | datetime) -> Row:
        """The run of a version, the run of an id, or the last run that had ended at a time."""
        runs = self.runs()
        if isinstance(which, datetime):
            moment = which if which.tzinfo else which.replace(tzinfo=timezone.utc)
            runs = runs.where(parse_mark_time(F.col("end_time")) <= F.lit(moment.isoformat()).cast("timestamp"))
        elif isinstance(which, str):
            runs = runs.where(F.col("run_id") == which)
        else:
            runs = runs.where(F.col("version") <= which)
        row = runs.orderBy(F.col("version").desc()).first()
        if row is None:
            raise ValueError(f"no run as of {which}")
        return row

    def before(self, version: int) -> Row | None:
        """The run before a version."""
        return self.runs().where(F.col("version") < version).orderBy(F.col("version").desc()).first()

    def files_of(self, run_ids: Sequence[str]) -> DataFrame:
        """Per-file results of some runs, committed or not."""
        folders = [f"{self.files_path}/run_id={r}" for r in run_ids]
        there = [f for f in folders if exists(self.spark, f)]
        if not there:
            return empty_table(self.spark, FILE_SCHEMA)
        rows = self.spark.read.schema(FILE_SCHEMA).option("basePath", self.files_path).parquet(*there)
        return rows.select(*FILE_SCHEMA.fieldNames())

    def has(self, run_id: str) -> bool:
        return not self.runs().where(F.col("run_id") == run_id).isEmpty()

    def mark(self) -> dict | None:
        """The high-water mark: from the newest run that was to advance it."""
        row = latest_mark(self.runs().where("advances_mark").select(*MARK_FIELDS)).first()
        return row.asDict() if row else None

    def seed(self, mark: Mapping) -> None:
        """Begin with a mark instead of a run: a starting mark, or one another tool left behind."""
        head = self.head()
        row = {"watermark_id": str(uuid.uuid4()), **{k: v for k, v in mark.items() if v is not None}}
        state = ("base", "pending", "buckets", "conflict", "segments", "columns")
        row |= {k: head.run[k] for k in state if head.run}
        row |= {"run_id": f"seed-{row['watermark_id']}", "version": head.number + 1, "advances_mark": True}
        self.commit(row)

    def _file_rows(self, head: Head) -> DataFrame:
        """Per-file results of committed runs that advance, with the version of their run."""
        runs = [r for r in head.rows if r["advances_mark"]]
        schema = T.StructType([*FILE_SCHEMA.fields, T.StructField("version", T.LongType())])
        rows = empty_table(self.spark, schema)
        if runs:
            named = F.lit([r["run_id"] for r in runs]).cast("array<string>")
            numbers = F.lit([r["version"] for r in runs]).cast("array<bigint>")
            version = F.map_from_arrays(named, numbers)[F.col("run_id")]
            rows = self.files_of([r["run_id"] for r in runs]).withColumn("version", version)
        if head.checkpoint:
            path = f"{self.checkpoints_path}/{head.checkpoint}/files"
            rows = rows.union(self.spark.read.schema(schema).parquet(path))
        return rows

    def files(self) -> DataFrame:
        """The newest result of every path, modification time and outcome, but for runs told not to advance."""
        return _folded(self._file_rows(self.head())).select(*FILE_SCHEMA.fieldNames())

    def failed(self) -> DataFrame:
        """Paths whose newest result is a failure."""
        newest = self._file_rows(self.head()).groupBy("path").agg(F.max_by("status", "version").alias("status"))
        return newest.where("status = 'failed'").select("path")

    def _checkpoint(self, head: Head) -> dict:
        """Write all rows up to ``head`` and the folded state of all files into a fresh folder."""
        name = f"version-{head.run['version']:012d}-{uuid.uuid4().hex}"
        path = f"{self.checkpoints_path}/{name}"
        runs = self._recent(head)
        if head.checkpoint:
            runs = runs.union(
                self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.checkpoints_path}/{head.checkpoint}/runs")
            )
        runs.coalesce(1).write.parquet(f"{path}/runs")
        _folded(self._file_rows(head)).write.parquet(f"{path}/files")
        return {"checkpoint": name, "checkpoint_version": head.run["version"]}

    def commit(self, row: Mapping) -> None:
        """Make a run count, as the version its row names, which must not be there yet.

        Of two runs that began from one state, the second to commit is refused (``Superseded``). From time to time
        the rows before go into a checkpoint, which counts with the commit that names it.
        """
        head = self.head()
        if row["version"] <= head.number:
            raise Superseded(f"another run has committed version {row['version']}; repeat this one")
        known = {k: row[k] for k in RUN_SCHEMA.fieldNames() if row.get(k) is not None}
        rows = head.rows
        known |= {"checkpoint": head.checkpoint, "checkpoint_version": head.checkpoint_version}
        if len(rows) >= self.checkpoint_every:
            known |= self._checkpoint(head)
            rows = []
        lines = [json.dumps({k: v for k, v in r.items() if v is not None}) for r in (*rows, known)]
        if not publish_text(self.spark, self._version_file(row["version"]), "\n".join(lines) + "\n"):
            raise Superseded(f"another run has committed version {row['version']}; repeat this one")


def _folded(rows: DataFrame) -> DataFrame:
    """One row, the newest, per path, modification time and outcome."""
    keys = ["path", "modificationTime", "status"]
    others = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct("version", "run_id")).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*rows.columns)
