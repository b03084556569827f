"""Rows set aside by earlier runs, validated again under other rules and applied once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import new_batch_id
from tidemark.operators.audit import utc_now
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.normalize import normalize
from tidemark.operators.upsert import fold_arrivals
from tidemark.operators.validate import check_rows
from tidemark.plans.incremental import _pointers, _store, target_schema
from tidemark.schema import (
    AUDIT_COLUMNS,
    BATCH_ID,
    ERRORS,
    KEY,
    ORDER,
    PATH,
    PROCESSED_AT,
    RAW,
    RAW_SCHEMA,
    ROW,
    SEQ,
    SUPPLIED,
    VARCHAR_LIMITS,
)
from tidemark.session import empty_table, exists, remove, settings
from tidemark.sinks.keyed import DATABASE, KeyedTable
from tidemark.state.ledger import Ledger, mark_row

#: What tells one quarantined row from another.
IDENTITY = ["path", "modificationTime", "row"]

_VERSION = "_version"

#: A run's id is text, whatever it looks like in the name of a folder.
_AS_TEXT = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """The rows set aside by committed runs and not applied since, as they were: values that could not be cast are
    text again. ``path``, ``modificationTime`` and ``row`` identify a row; ``_version`` is when it arrived.

    A row that several runs have set aside counts once, as of the last.
    """
    ledger = Ledger(spark, f"{root}/state")
    folder = f"{root}/quarantine"
    if not exists(spark, folder):
        return empty_table(spark, RAW_SCHEMA.add("path", "string").add("modificationTime", "timestamp").add("row", "long"))
    runs = ledger.runs().select("run_id", F.col("version").alias(_VERSION))
    with settings(spark, _AS_TEXT):
        rows = spark.read.option("mergeSchema", "true").parquet(folder).join(runs, "run_id")
    times = ledger.files_of([r["run_id"] for r in rows.select("run_id").distinct().collect()])
    times = times.select("run_id", F.col("path").alias(PATH), "modificationTime")
    rows = rows.join(times, ["run_id", PATH]).withColumnsRenamed({PATH: "path", ROW: "row"})
    schema = ledger.latest()
    names = [f.name for f in target_schema(schema["columns"]) if f.name in rows.columns and f.name not in AUDIT_COLUMNS]
    raw = F.from_json(RAW, "map<string,string>")
    texts = {
        n: F.when(F.array_contains(ERRORS, f"cast:{n}"), raw[n]).otherwise(F.col(n).cast("string")) for n in names
    }
    texts[ORDER] = F.when(F.array_contains(ERRORS, f"cast:{ORDER}"), raw[ORDER]).otherwise(
        F.date_format(ORDER, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    rows = dedup_latest(rows, IDENTITY, [_VERSION], ())
    rows = rows.withColumns(texts)
    if exists(spark, f"{root}/replayed"):
        with settings(spark, _AS_TEXT):
            done = spark.read.parquet(f"{root}/replayed").join(runs, "run_id", "left_semi")
        rows = rows.join(done.select(*IDENTITY), IDENTITY, "left_anti")
    return rows


def replay_quarantine(
    spark: SparkSession,
    root: str,
    mend: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    limits: Mapping[str, int] = VARCHAR_LIMITS,
    run_id: str | None = None,
    now: datetime | None = None,
    database: str = DATABASE,
) -> dict:
    """Validate quarantined rows again, after ``mend`` and under ``limits``, and upsert those that pass, once.

    ``mend`` gets the rows with their values as text and changes values, not rows. A row takes the place it had
    when its file arrived: where arrival decides, it does not overwrite what a later run has brought, and of its own
    run's rows only older ones; where dates decide, the target's rule does it. It keeps the batch id of its run.
    What fails again stays where it is. Committed like a run; a run that commits meanwhile makes it fail, to be
    repeated.
    """
    ledger = Ledger(spark, f"{root}/state")
    head = ledger.head()
    run_id, started = run_id or new_batch_id(), now or utc_now()
    totals = {"run_id": run_id, "records_processed": 0, "records_failed": 0}
    if not head.run:
        return totals
    state, conflict = _pointers(head.run), head.run["conflict"] or "arrival"
    schema = target_schema(state["columns"])
    table = KeyedTable(spark, f"{root}/target", schema, conflict=conflict, database=database)
    rows = mend(quarantined(spark, root))
    wanted = type(schema)([f for f in schema if f.name in rows.columns and f.name not in AUDIT_COLUMNS])
    before = rows.drop(ERRORS, RAW)
    judged = check_rows(normalize(before, wanted, on_error="quarantine"), limits=limits)
    stage = f"{root}/staging/{run_id}"
    judged = _store(judged.drop(RAW), f"{stage}/rows")
    good = judged.where(F.size(ERRORS) == 0)
    totals["records_failed"] = judged.where(F.size(ERRORS) > 0).count()
    audit = {PROCESSED_AT: F.lit(started.replace(tzinfo=None)).cast("timestamp_ntz"), BATCH_ID: F.col("run_id")}
    stamped = good.withColumns(audit)
    updates = _folded(stamped, schema.fieldNames(), conflict)
    if conflict == "arrival":
        updates = _in_order(table, state, updates, ledger)
    updates = updates.drop(_VERSION)
    changes = table.write_changes(updates, run_id)
    totals["records_processed"] = spark.read.parquet(f"{table.root}/{changes}").count()
    good.select(*IDENTITY).write.mode("overwrite").parquet(f"{root}/replayed/run_id={run_id}")
    ledger.commit(
        {
            **mark_row(started, "", totals["records_processed"]),
            **state,
            "pending": [*state["pending"], changes],
            "changes": changes,
            "run_id": run_id,
            "start_time": started.isoformat(),
            "end_time": (now or utc_now()).isoformat(),
            "files_processed": 0,
            "files_failed": 0,
            "records_processed": totals["records_processed"],
            "records_failed": totals["records_failed"],
            "advances_mark": False,
            "conflict": conflict,
            "version": head.number + 1,
        }
    )
    remove(spark, stage)
    return totals


def _folded(rows: DataFrame, names: list[str], conflict: str) -> DataFrame:
    """One row per key: the last to arrive, or the latest; with the version it arrived in."""
    place = [_VERSION, SEQ, "path", ORDER, "row"]
    arrival = [ORDER, *place] if conflict == "latest" else place
    if SUPPLIED in rows.columns:
        whole = F.array(*[F.lit(n) for n in names if n in rows.columns])
        own = F.array(*[F.lit(n) for n in (*AUDIT_COLUMNS, _VERSION)])
        rows = rows.withColumn(SUPPLIED, F.array_union(F.coalesce(SUPPLIED, whole), own))
    columns = [n for n in names if n in rows.columns]
    dated = ORDER if conflict == "latest" and SUPPLIED in rows.columns else None
    return fold_arrivals(rows, [KEY], arrival, [*columns, _VERSION], dated)


def _in_order(table: KeyedTable, state: dict, updates: DataFrame, ledger: Ledger) -> DataFrame:
    """Without the rows whose key holds something that arrived later; the target is reduced to the updates' keys."""
    runs = ledger.runs().select(F.col("run_id").alias("_run"), F.col("version").alias("_stored_version"))
    stored = table.read(state["segments"] or state["base"], state["pending"], state["buckets"], updates)
    stored = stored.select(
        F.col(KEY), F.regexp_replace(BATCH_ID, "_b[0-9]+$", "").alias("_of"), F.col(ORDER).alias("_date")
    )
    exact = stored.join(runs, F.col("_run") == F.col("_of"), "left")
    known = exact.select(F.col(KEY).alias("_key"), "_stored_version", "_date")
    older = F.col("_date").isNull() | (F.col(ORDER) >= F.col("_date"))
    fits = F.col("_stored_version").isNull() | (F.col("_stored_version") < F.col(_VERSION))
    fits = fits | ((F.col("_stored_version") == F.col(_VERSION)) & F.coalesce(older, F.lit(False)))
    return updates.join(known, updates[KEY] == F.col("_key"), "left").where(fits).select(*updates.columns)
