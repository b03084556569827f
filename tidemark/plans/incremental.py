"""The incremental run: new files in, target changed, ledger advanced."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.text import new_batch_id, slice_batch_id
from tidemark.operators.audit import add_audit_columns, utc_now
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.metrics import run_totals
from tidemark.operators.normalize import fill_nulls, normalize
from tidemark.operators.slices import number_batches
from tidemark.operators.upsert import CONFLICTS, classify, fold_arrivals
from tidemark.operators.validate import check_rows, enforce_error_rate
from tidemark.schema import (
    AUDIT_COLUMNS,
    BATCH,
    BATCH_SIZE,
    DATES,
    ERRORS,
    KEY,
    ORDER,
    PATH,
    RAW,
    RAW_SCHEMA,
    ROW,
    SEQ,
    SUPPLIED,
    TARGET_SCHEMA,
)
from tidemark.session import empty_table, folder_bytes, remove, settings
from tidemark.sinks.keyed import DATABASE, KeyedTable
from tidemark.sinks.processed import write_processed
from tidemark.sources.discovery import changed_listing
from tidemark.sources.listing import (
    exclude_state,
    list_files,
    listing_splits,
    new_or_changed,
    newer_than_mark,
    only_parquet,
)
from tidemark.sources.parquet import NANOS, explicit_files, read_footers, read_parquet, signature_schema
from tidemark.state.deadletter import failed_rows, write_failed_log
from tidemark.state.ledger import CHECKPOINT_EVERY, Head, Ledger, Superseded, mark_row

log = logging.getLogger(__name__)

MODES = ("ledger", "highwater", "all")
SCOPES = ("file", "batch", "run")

# A bucket of the target's base is to hold about this much.
BUCKET_BYTES = 512 << 20

# A task of the fold sorts the rows it reads, which take some ten times their bytes in a file (the path of each row alone
# takes more than all of its values). Splits end at row groups, so both are limited: bytes of a split, and bytes of a
# staged row group before compression. What a task gathers from the shuffle is sorted again.
FOLD_SPLIT_BYTES = 16 << 20
STAGED_GROUP_BYTES = 8 << 20


@dataclass
class RunOptions:
    """How a run picks files, and what wins when rows collide.

    ``mode``: ``"ledger"`` takes every file no successful run recorded at its present
    modification time; ``"highwater"`` takes files after the mark; ``"all"`` takes all.
    ``scope``: where the latest row per key is chosen before arrival order decides:
    within a ``"file"``, a ``"batch"`` (slice) of it, or the whole ``"run"``.
    ``conflict``: ``"arrival"`` lets the later arrival overwrite, ``"latest"`` the later date.
    ``update_mark=False`` changes the target but leaves the files to be picked again.
    ``defaults`` replace NULL in columns a file has; they do not add columns.
    ``compact_every``: runs between rewrites of the target's base; a rewrite waits, at most three times
    as long, while the changes are less than ``compact_share`` of the base.
    ``buckets``: of the base from its next rewrite on; by default its size decides.
    ``keep_staging`` keeps the rows as read and checked, which are deleted after the commit.
    ``track_changes`` compares the upserts with the target: only inserts and updates are stored as
    changes, and all of them with what they were in the run's change log; the run returns their counts.
    ``extra_columns``: ``"drop"`` takes no columns but the target's and records the names of the others,
    ``"add"`` adds them to the target, NULL in all rows so far.
    ``wave_files``: files whose paths the driver holds, and that are read, at a time.
    ``staging``: ``"rows"`` stores the rows as read and checked, so files are read once; ``"none"`` reads them
    twice, first only to count and check, and stores nothing of a sound load but its changes.
    ``discovery``: ``"full"`` lists all below the source, ``"folders"`` only folders that have changed since the last
    run, for stores where a folder's time tells (see ``sources.discovery``).
    ``database``: where bucketed folders are declared while a read or write of them is planned.
    """

    mode: str = "ledger"
    scope: str = "file"
    conflict: str = "arrival"
    batch_size: int = BATCH_SIZE
    update_mark: bool = True
    defaults: Mapping[str, object] = field(default_factory=dict)
    max_error_rate: float | None = None
    compact_every: int = 8
    buckets: int | None = None
    processed_root: str | None = None
    keep_staging: bool = False
    compact_share: float = 0.0
    track_changes: bool = False
    extra_columns: str = "drop"
    wave_files: int = 20_000
    staging: str = "rows"
    discovery: str = "full"
    checkpoint_every: int = CHECKPOINT_EVERY
    database: str = DATABASE

    def __post_init__(self) -> None:
        for value, allowed in (
            (self.mode, MODES),
            (self.scope, SCOPES),
            (self.conflict, CONFLICTS),
            (self.extra_columns, ("drop", "add")),
            (self.staging, ("rows", "none")),
            (self.discovery, ("full", "folders")),
        ):
            if value not in allowed:
                raise ValueError(f"{value!r} is not one of {allowed}")


def run_incremental(
    spark: SparkSession,
    source: str,
    root: str,
    options: RunOptions | None = None,
    files: Sequence[str] | DataFrame | None = None,
    run_id: str | None = None,
    now: datetime | None = None,
) -> dict:
    """Process new files below ``source`` (or exactly ``files``) into the target below ``root``.

    ``files`` is a list of paths, whose order is the arrival order, or a listing.

    Unreadable, damaged or schema-less files are logged and left for a later run; the
    others go through as one job. Rows that fail validation are set aside. Nothing
    counts until the ledger row at the end is written; a run that died may be repeated
    under its ``run_id``, one that was committed may not. Returns the run's totals.

    Of two runs at a time on one ``root``, the second to commit finds the other's version. If they have
    processed different files it publishes what it has written on top of that version; if they share one, it is
    refused and its files are picked again.
    """
    options = options or RunOptions()
    started = now or utc_now()
    ledger = Ledger(spark, f"{root}/state", options.checkpoint_every)
    if run_id is not None and ledger.has(run_id):
        raise ValueError(f"run {run_id} is committed; its folders must not be written again")
    run_id = run_id or new_batch_id()
    head = ledger.head()
    _check_rule(head, options)
    stage = f"{root}/staging/{run_id}"

    picked = _pick_files(spark, source, ledger, options, files)
    with listing_splits(spark):
        footers = _store(read_footers(picked), f"{stage}/footers")
    if footers.isEmpty():
        log.info("no files to process")
        remove(spark, stage)
        return _no_files(run_id, started)

    state = _pointers(head.run)
    columns, left_out = _target_columns(footers, state["columns"], options.extra_columns)
    state["columns"] = columns
    ordered = files is not None and not isinstance(files, DataFrame)
    reader = _Reader(spark, footers, stage, options, ordered, columns)
    rows = reader.staged() if options.staging == "rows" else None
    read = _per_file(rows) if rows is not None else reader.counted() if options.staging == "none" else None
    results = _store(_file_results(footers, read), f"{ledger.files_path}/run_id={run_id}")
    last = F.max_by("path", F.struct(SEQ, "path")).alias("last_file")
    totals = run_totals(results, last).first().asDict()
    failures = results.where("status = 'failed'")
    if totals["files_failed"]:
        write_failed_log(failed_rows(failures, started.isoformat()), f"{root}/failed", run_id)
    if options.staging == "none" and totals["files_processed"]:
        rows = reader.again(results.where("status = 'ok'"))
    elif rows is not None and totals["files_processed"]:
        if totals["files_failed"]:
            rows = rows.join(failures.select(F.col("path").alias(PATH)), PATH, "left_anti")
    if totals["records_failed"]:
        rows.where(F.size(ERRORS) > 0).write.mode("overwrite").parquet(f"{root}/quarantine/run_id={run_id}")
    # The gate comes after the evidence: what it refuses can be looked up.
    enforce_error_rate(
        totals["records_processed"] + totals["records_failed"],
        totals["records_failed"],
        options.max_error_rate,
    )
    good = None
    if rows is not None and totals["files_processed"]:
        good = rows.where(F.size(ERRORS) == 0).drop(ERRORS, RAW)
    state, counts = _apply(spark, good, root, state, options, run_id, started)
    if options.staging == "none":
        _refuse_changed_files(results)

    ended = now or utc_now()
    _commit(
        ledger,
        head,
        {
            **mark_row(started, totals["last_file"], counts["records_processed"]),
            **state,
            **counts,
            "run_id": run_id,
            "start_time": started.isoformat(),
            "end_time": ended.isoformat(),
            "files_processed": totals["files_processed"],
            "files_failed": totals["files_failed"],
            "records_failed": totals["records_failed"],
            "advances_mark": options.update_mark,
            "conflict": options.conflict,
            "left_out": left_out or None,
        },
        KeyedTable(spark, f"{root}/target", target_schema(columns), conflict=options.conflict, database=options.database),
        results,
    )
    if not options.keep_staging:
        remove(spark, stage)
    return {
        "run_id": run_id,
        "files_processed": totals["files_processed"],
        "files_failed": totals["files_failed"],
        "records_failed": totals["records_failed"],
        **counts,
        "start_time": started.isoformat(),
        "end_time": ended.isoformat(),
    }


def _check_rule(head: Head, options: RunOptions) -> None:
    kept = head.run["conflict"] if head.run else None
    if kept and kept != options.conflict:
        raise ValueError(f"the target is kept by conflict={kept!r}; a run cannot change that")


def _commit(ledger: Ledger, head: Head, row: dict, table: KeyedTable, results: DataFrame) -> None:
    """Commit a run that began at ``head``; if others have committed since, on top of what they left.

    Only the run's own folder of changes is published again. A rewrite of the base that it made is dropped, since
    it does not hold the others' changes; a change log is made anew, since it says what the changes were against.
    """
    while True:
        try:
            return ledger.commit({**row, "version": head.number + 1})
        except Superseded:
            newer = ledger.head()
            others = ledger.runs().where(F.col("version") > head.number)
            if not newer.run or newer.number <= head.number:
                raise
            _refuse_shared_files(ledger, others, results)
            if newer.run["conflict"] not in (None, row["conflict"]):
                raise
            row = _rebased(row, _pointers(newer.run), table, newer.number + 1)
            head = newer


def _refuse_shared_files(ledger: Ledger, others: DataFrame, results: DataFrame) -> None:
    ids = [r["run_id"] for r in others.select("run_id").collect()]
    theirs = ledger.files_of(ids)
    shared = results.join(theirs.where("status = 'ok'"), ["path", "modificationTime"], "left_semi")
    if not shared.where("status = 'ok'").isEmpty():
        raise Superseded("another run has committed some of these files; repeat this one")


def _rebased(row: dict, state: dict, table: KeyedTable, version: int) -> dict:
    """The run's row on top of a newer state."""
    mine = StructType.fromJson(json.loads(row["columns"])) if row["columns"] else StructType()
    theirs = StructType.fromJson(json.loads(state["columns"])) if state["columns"] else StructType()
    known = {f.name.lower(): f for f in theirs}
    if any(f.name.lower() in known and known[f.name.lower()].dataType != f.dataType for f in mine):
        raise Superseded("another run has added a column of this name with another type; repeat this one")
    columns = StructType([*theirs.fields, *[f for f in mine if f.name.lower() not in known]])
    out = {**row, **state, "columns": json.dumps(columns.jsonValue()) if columns.fields else None}
    if row["change_log"]:
        updates = table.spark.read.parquet(f"{table.root}/{row['change_log']}").drop("_change_type")
        out |= _tracked(table, state, updates, f"{row['run_id']}-{version}")
    return {**out, "pending": [*state["pending"], *([out["changes"]] if out["changes"] else [])]}


def target_schema(columns: str | None) -> StructType:
    """The target's schema with the columns a ledger has recorded as added."""
    added = StructType.fromJson(json.loads(columns)).fields if columns else []
    return StructType([*TARGET_SCHEMA.fields, *added])


def _table_at(spark: SparkSession, root: str, run, database: str) -> tuple[KeyedTable, dict]:
    state = _pointers(run)
    conflict = (run["conflict"] if run else None) or "arrival"
    schema = target_schema(state["columns"])
    return KeyedTable(spark, f"{root}/target", schema, conflict=conflict, database=database), state


def read_target(
    spark: SparkSession, root: str, as_of: int | str | datetime | None = None, database: str = DATABASE
) -> DataFrame:
    """The target by the rule of conflict its runs keep: as of the newest committed run, or of an earlier one.

    ``as_of`` is a version, a run's id, or a time, of which the last run that had ended by then counts. Folders are
    written once, so an earlier table is what it was, unless it has expired.
    """
    ledger = Ledger(spark, f"{root}/state")
    run = ledger.latest() if as_of is None else ledger.as_of(as_of)
    table, state = _table_at(spark, root, run, database)
    return table.read(state["segments"] or state["base"], state["pending"], state["buckets"])


def run_changes(spark: SparkSession, root: str, run: int | str, database: str = DATABASE) -> DataFrame:
    """The upserts of one run with what each did (``_change_type``): from its change log, or else by comparing them
    with the table as it was before."""
    ledger = Ledger(spark, f"{root}/state")
    row = ledger.as_of(run)
    if row["change_log"]:
        return spark.read.parquet(f"{root}/target/{row['change_log']}").drop(SUPPLIED, DATES)
    table, _ = _table_at(spark, root, row, database)
    if not row["changes"]:
        return empty_table(spark, table.schema.add("_change_type", "string"))
    _, before = _table_at(spark, root, ledger.before(row["version"]), database)
    updates = spark.read.parquet(f"{root}/target/{row['changes']}")
    return table.classified(before, updates).drop(SUPPLIED, DATES)


def target_diff(
    spark: SparkSession,
    root: str,
    before: int | str | datetime,
    after: int | str | datetime | None = None,
    database: str = DATABASE,
) -> DataFrame:
    """Rows that differ between two versions of the target: ``insert`` or ``update`` and the later values.

    Only keys that the runs between have changed are compared; the base is reduced to them bucket by bucket. Rows are
    never deleted. Audit columns do not make a difference by themselves.
    """
    ledger = Ledger(spark, f"{root}/state")
    first = ledger.as_of(before)
    last = ledger.latest() if after is None else ledger.as_of(after)
    table, now = _table_at(spark, root, last, database)
    between = ledger.runs().where(
        (F.col("version") > first["version"]) & (F.col("version") <= last["version"]) & F.col("changes").isNotNull()
    )
    folders = [f"{root}/target/{r['changes']}" for r in between.select("changes").collect()]
    if not folders:
        return empty_table(spark, table.schema.add("_change_type", "string"))
    keys = reduce(lambda a, b: a.union(b), [spark.read.parquet(f).select(KEY) for f in folders]).distinct()
    old_table, old = _table_at(spark, root, first, database)
    new_rows = table.read(now["segments"] or now["base"], now["pending"], now["buckets"], keys)
    old_rows = old_table.read(old["segments"] or old["base"], old["pending"], old["buckets"], keys)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in table.schema if f.name not in old_rows.columns}
    kinds = classify(old_rows.withColumns(missing), new_rows)
    return kinds.where(F.col("_change_type").isin("insert", "update"))


def _no_files(run_id: str, started: datetime) -> dict:
    return {
        "run_id": run_id,
        "files_processed": 0,
        "files_failed": 0,
        "records_processed": 0,
        "records_failed": 0,
        "start_time": started.isoformat(),
        "end_time": started.isoformat(),
    }


def _pointers(run) -> dict:
    if run is None:
        return {"base": None, "pending": [], "buckets": None, "segments": None, "columns": None}
    return {
        "base": run["base"],
        "pending": list(run["pending"] or []),
        "buckets": run["buckets"],
        "segments": [{"folder": s["folder"], "buckets": s["buckets"]} for s in run["segments"] or []] or None,
        "columns": run["columns"],
    }


def _target_columns(footers: DataFrame, columns: str | None, extra: str) -> tuple[str | None, dict[str, int]]:
    """The columns added to the target, these files' included if wanted; and the names of columns that are left
    out, with the number of files that have them.

    A new column has the type its files agree on, or else is text. Names that begin with an underscore, nested
    types and nanosecond times are not taken.
    """
    known = target_schema(columns)
    found = footers.where("error_type IS NULL AND others IS NOT NULL").select(
        F.explode(F.from_json("others", "map<string,string>")).alias("name", "type")
    )
    new = (
        found.groupBy(F.lower("name").alias("lower"))
        .agg(F.min("name").alias("name"), F.collect_set("type").alias("types"), F.count(F.lit(1)).alias("files"))
        .collect()
    )
    have, added, left_out = {f.name.lower() for f in known}, [], {}
    for row in sorted(new, key=lambda r: r["lower"]):
        if row["lower"] in have and row["lower"] not in {f.name.lower() for f in TARGET_SCHEMA}:
            continue
        usable = all(t and t != NANOS for t in row["types"]) and not row["name"].startswith("_")
        if extra == "add" and usable and row["lower"] not in have:
            kind = row["types"][0] if len(row["types"]) == 1 else "string"
            added.append(StructType.fromDDL(f"`{row['name']}` {kind}").fields[0])
        else:
            left_out[row["name"]] = row["files"]
    fields = [*known.fields[len(TARGET_SCHEMA.fields) :], *added]
    return (json.dumps(StructType(fields).jsonValue()) if fields else None), left_out


def _store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and go on from what was written; later steps never recompute it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pick_files(
    spark: SparkSession,
    source: str,
    ledger: Ledger,
    options: RunOptions,
    files: Sequence[str] | DataFrame | None,
) -> DataFrame:
    if isinstance(files, DataFrame):
        return files.select("path", "modificationTime", "length")
    if files is not None:
        return explicit_files(spark, files)
    if options.discovery == "folders":
        mark = ledger.mark()
        since = mark["last_successful_run"] if mark else None
        listing = changed_listing(spark, source, f"{ledger.root}/listing", since).files
    else:
        listing = list_files(spark, source)
    if options.mode == "highwater":
        # A file that failed stays due, whatever came after it.
        again = only_parquet(listing).join(ledger.failed(), "path", "left_semi")
        return newer_than_mark(listing, ledger.mark()).union(again.select(*listing.columns)).distinct()
    listing = only_parquet(listing)
    if options.mode == "ledger":
        return new_or_changed(listing, ledger.files())
    return exclude_state(listing)


class _Reader:
    """The rows of a run's usable files, normalised and checked.

    Files go in waves, so the driver holds the paths of one wave. In a wave they are read in groups of equal column
    types; there are as many groups as there are distinct type combinations of the expected columns.
    """

    def __init__(
        self, spark: SparkSession, footers: DataFrame, stage: str, options: RunOptions, ordered: bool, columns: str | None
    ):
        self.spark, self.footers, self.stage, self.options, self.ordered = spark, footers, stage, options, ordered
        self.schema = StructType([*RAW_SCHEMA.fields, *target_schema(columns).fields[len(TARGET_SCHEMA.fields) :]])

    def _waves(self, footers: DataFrame, skip_damaged: bool):
        """The rows of each wave, and whether all its files supply all columns."""
        usable = footers.where("error_type IS NULL").select("signature", "others", "path")
        files = usable.count()
        waves = -(-files // self.options.wave_files)
        # Which wave a file is in does not matter to the result, so waves are dealt by a hash of the path.
        wave = F.pmod(F.xxhash64("path"), F.lit(max(1, waves)))
        known = {f.name.lower() for f in self.schema}
        for n in range(waves):
            groups: dict[str, list[str]] = {}
            for row in usable.where(wave == n).collect():
                extra = {k: v for k, v in json.loads(row["others"] or "{}").items() if k.lower() in known}
                read = json.dumps({**json.loads(row["signature"]), **dict(sorted(extra.items()))})
                groups.setdefault(read, []).append(row["path"])
            if groups:
                yield self._rows(dict(sorted(groups.items())), skip_damaged)

    def _rows(self, groups: Mapping[str, Sequence[str]], skip_damaged: bool) -> tuple[DataFrame, bool]:
        parts = [_normalized(self.spark, paths, read, self.schema, skip_damaged) for read, paths in groups.items()]
        whole = all(supplied == tuple(self.schema.fieldNames()) for _, supplied in parts)
        rows = reduce(lambda a, b: a.unionByName(b), [part for part, _ in parts])
        rows = check_rows(fill_nulls(rows, self.options.defaults))
        rows = number_batches(rows, self.options.batch_size)
        if self.ordered:
            return rows.join(self.footers.select(F.col("path").alias(PATH), SEQ), PATH), whole
        return rows.withColumn(SEQ, F.lit(0).cast("bigint")), whole

    def staged(self) -> DataFrame | None:
        """All rows, read once and stored; None without a usable file.

        The stored rows give the row count of each file, which no separate count can: counting without a column
        never touches its damaged pages. They also keep later steps from reading a source that may change meanwhile.
        """
        folders, every, schema = [], True, None
        for rows, whole in self._waves(self.footers, skip_damaged=True):
            folders.append(f"{self.stage}/rows/wave={len(folders)}")
            writer = rows.write.option("parquet.block.size", STAGED_GROUP_BYTES)
            writer.mode("overwrite").parquet(folders[-1])
            every, schema = every and whole, rows.schema
        if not folders:
            return None
        rows = self.spark.read.schema(schema).parquet(*folders)
        return rows.drop(SUPPLIED) if every else rows

    def counted(self) -> DataFrame | None:
        """path, n_read, n_bad of every file, from a read that stores nothing else.

        The hash of all values makes it decode every page of the columns in use, so a damaged one is noticed.
        """
        folders = []
        for rows, _ in self._waves(self.footers, skip_damaged=True):
            values = F.bit_xor(F.xxhash64(*[c for c in rows.columns if c not in (SUPPLIED, SEQ)])).alias("hash")
            folders.append(f"{self.stage}/counts/wave={len(folders)}")
            _per_file(rows, values).write.mode("overwrite").parquet(folders[-1])
        return self.spark.read.parquet(*folders).drop("wave") if folders else None

    def again(self, ok: DataFrame) -> DataFrame:
        """The rows of sound files, read once more; now an unreadable page is an error and the task is repeated.

        Of several waves each is folded to one row per key, set of columns and outcome before the next, which the fold
        over all of them does not notice.
        """
        footers = self.footers.join(ok.select("path"), "path", "left_semi")
        parts = list(self._waves(footers, skip_damaged=False))
        every = all(whole for _, whole in parts)
        if len(parts) == 1:
            return parts[0][0].drop(SUPPLIED) if every else parts[0][0]
        order = arrival_order(self.options.scope, self.options.conflict)
        folders = [f"{self.stage}/folds/wave={n}" for n in range(len(parts))]
        for (rows, _), folder in zip(parts, folders):
            bad = F.size(ERRORS) > 0
            folded = dedup_latest(rows.where(~bad), [KEY, SUPPLIED], order, ())
            with fold_splits(self.spark):
                folded.unionByName(rows.where(bad)).write.option("parquet.block.size", STAGED_GROUP_BYTES).mode(
                    "overwrite"
                ).parquet(folder)
        rows = self.spark.read.schema(parts[0][0].schema).parquet(*folders)
        return rows.drop(SUPPLIED) if every else rows


def _per_file(rows: DataFrame, *more) -> DataFrame:
    return rows.groupBy(F.col(PATH).alias("path")).agg(
        F.count(F.lit(1)).alias("n_read"), F.count_if(F.size(ERRORS) > 0).alias("n_bad"), *more
    )


def _refuse_changed_files(results: DataFrame) -> None:
    """Files that were read twice must be what they were when they were listed."""
    ok = results.where("status = 'ok'")
    now = read_footers(ok.select("path"), required=()).select(
        "path", F.col("modificationTime").alias("time"), F.col("length").alias("size"), F.col("error_type").alias("problem")
    )
    same = F.col("time").eqNullSafe(F.col("modificationTime")) & (F.col("size") == F.col("length"))
    changed = ok.join(now, "path").where(F.col("problem").isNotNull() | ~same).select("path").limit(5).collect()
    if changed:
        raise RuntimeError(f"files changed while they were read, repeat the run: {[r['path'] for r in changed]}")


def _normalized(
    spark: SparkSession, paths: Sequence[str], signature: str, schema: StructType, skip_damaged: bool
) -> tuple[DataFrame, tuple[str, ...]]:
    """The rows of files of one signature in the columns of ``schema``, and which of them they supply."""
    have, units = signature_schema(signature)
    raw = read_parquet(spark, paths, have, skip_damaged=skip_damaged)
    spelled = {f.name.lower(): f.name for f in schema}
    raw = raw.withColumnsRenamed({n: spelled[n.lower()] for n in have.fieldNames()})
    part = normalize(raw, schema, on_error="quarantine", units=units)
    present = tuple(f.name for f in schema if f.name.lower() in {n.lower() for n in have.fieldNames()})
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in present}
    supplied = {SUPPLIED: F.array(*[F.lit(c) for c in present])}
    return part.withColumns({**absent, **supplied}), present


def _file_results(footers: DataFrame, read: DataFrame | None) -> DataFrame:
    """Outcome per file: a file of which other than its footer's rows could be read failed as a whole."""
    if read is None:
        read = empty_table(
            footers.sparkSession, StructType.fromDDL("path string, n_read bigint, n_bad bigint")
        )
    n_read, n_bad = F.coalesce("n_read", F.lit(0)), F.coalesce("n_bad", F.lit(0))
    short = F.col("error_type").isNull() & (n_read != F.col("num_rows"))
    failed = F.col("error_type").isNotNull() | short
    message = F.concat(
        F.lit("footer declares "), F.col("num_rows"), F.lit(" rows, "), n_read, F.lit(" could be read")
    )
    return footers.join(read, "path", "left").select(
        "path",
        "modificationTime",
        "length",
        SEQ,
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.when(failed, F.coalesce("num_rows", F.lit(0))).otherwise(n_read - n_bad).alias("records"),
        F.when(failed, 0).otherwise(n_bad).cast("bigint").alias("records_failed"),
        F.when(short, "RowCountMismatch").otherwise(F.col("error_type")).alias("error_type"),
        F.when(short, message).otherwise(F.col("error_message")).alias("error_message"),
    )


def bucket_count(size: int, now: int | None, target: int | None = None) -> int:
    """Buckets for a base of ``size`` bytes: as they are while they fit, else doubled until they do."""
    target = target or BUCKET_BYTES
    if now is None:
        return max(1, -(-size // target))
    while size > 2 * target * now:
        now *= 2
    return now


def fold_splits(spark: SparkSession):
    """Smaller splits, and partitions gathered from a shuffle, while a fold is planned and run; the session's own sizes
    where they are smaller still."""
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return settings(spark, {n: str(min(in_bytes(spark.conf.get(n)), FOLD_SPLIT_BYTES)) for n in sizes})


def arrival_order(scope: str, conflict: str) -> list[str]:
    """Sort key, most significant first, of the row that survives a run."""
    place = [SEQ, PATH]
    if conflict == "latest" or scope == "run":
        return [ORDER, *place, ROW]
    if scope == "batch":
        return [*place, BATCH, ORDER, ROW]
    return [*place, ORDER, ROW]


def _apply(
    spark: SparkSession,
    good: DataFrame | None,
    root: str,
    state: dict,
    options: RunOptions,
    run_id: str,
    started: datetime,
) -> tuple[dict, dict]:
    """Fold the rows to one per key, store them, and compact when it is due.

    Returns what the run's ledger row says of the target, and the counts of its changes.
    """
    if good is None:
        return {**state, "changes": None, "change_log": None}, {"records_processed": 0}
    schema = target_schema(state["columns"])
    table = KeyedTable(spark, f"{root}/target", schema, conflict=options.conflict, database=options.database)
    batch = slice_batch_id(run_id, F.col(BATCH)) if options.scope == "batch" else run_id
    rows = add_audit_columns(good, batch, started)
    partial = SUPPLIED in rows.columns
    if partial:
        audit = F.array(*[F.lit(c) for c in AUDIT_COLUMNS])
        rows = rows.withColumn(SUPPLIED, F.concat(SUPPLIED, audit))
    dated = ORDER if partial and options.conflict == "latest" else None
    updates = fold_arrivals(
        rows, [KEY], arrival_order(options.scope, options.conflict), table.schema.fieldNames(), dated
    )
    if options.track_changes:
        with fold_splits(spark):
            made = _tracked(table, state, updates, run_id)
        counts = {k: made.pop(k) for k in ("records_processed", "inserted", "updated", "unchanged", "stale")}
    else:
        counted = Observation()
        with fold_splits(spark):
            changes = table.write_changes(updates.observe(counted, F.count(F.lit(1)).alias("n")), run_id)
        made, counts = {"changes": changes, "change_log": None}, {"records_processed": counted.get["n"]}
    if options.processed_root and counts["records_processed"]:
        stored = spark.read.parquet(f"{table.root}/{made['changes']}").drop(SUPPLIED, DATES)
        write_processed(stored, options.processed_root, started.date(), run_id)

    pending = [*state["pending"], *([made["changes"]] if made["changes"] else [])]
    base = state["segments"] or state["base"]
    if not pending or not _rewrite_due(spark, table, base, pending, options):
        return {**state, **made, "pending": pending}, counts
    folders = [f"{table.root}/{name}" for name in [*pending, *_folders(base)]]
    size = sum(folder_bytes(spark, folder) for folder in folders)
    buckets = options.buckets or bucket_count(size, state["buckets"])
    segments = table.rewrite(base, pending, buckets, run_id, state["buckets"])
    rewritten = {"base": segments[-1]["folder"], "segments": segments, "pending": [], "buckets": buckets}
    return {**state, **made, **rewritten}, counts


def _folders(base) -> list[str]:
    return [] if base is None else [base] if isinstance(base, str) else [s["folder"] for s in base]


def _rewrite_due(spark: SparkSession, table: KeyedTable, base, pending: list[str], options: RunOptions) -> bool:
    if len(pending) < options.compact_every:
        return False
    if base is None or not options.compact_share or len(pending) >= 3 * options.compact_every:
        return True
    changed = sum(folder_bytes(spark, f"{table.root}/{name}") for name in pending)
    kept = sum(folder_bytes(spark, f"{table.root}/{name}") for name in _folders(base))
    return changed >= options.compact_share * kept


def _tracked(table: KeyedTable, state: dict, updates: DataFrame, name: str) -> dict:
    """Write the upserts with what each does into the run's change log, and those that change something as its changes."""
    path = f"{table.root}/log={name}"
    logged = _store(table.classified(state, updates), path)
    counts = {r["_change_type"]: r["count"] for r in logged.groupBy("_change_type").count().collect()}
    inserted, updated = counts.get("insert", 0), counts.get("update", 0)
    changes = None
    if inserted or updated:
        kept = logged.where(F.col("_change_type").isin("insert", "update")).drop("_change_type")
        changes = table.write_changes(kept, name)
    return {
        "changes": changes,
        "change_log": f"log={name}",
        "records_processed": inserted + updated,
        "inserted": inserted,
        "updated": updated,
        "unchanged": counts.get("unchanged", 0),
        "stale": counts.get("stale", 0),
    }
