"""Expiry: folders that no kept version of the ledger refers to are found by an anti-join and removed."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import list_names, qualify, remove
from tidemark.sources.listing import list_files, listing_splits
from tidemark.state.ledger import Head, Ledger

#: Folders below a root whose members come and go, and what a member is called there.
AREAS = ("target", "state/files", "state/checkpoints", "staging")


def _members(spark: SparkSession, root: str) -> DataFrame:
    """area, folder and the time of its newest file, from one parallel listing of each area."""
    parts = []
    for area in AREAS:
        prefix = f"{qualify(spark, f'{root}/{area}')}/"
        inner = F.substring("path", len(prefix) + 1, 1 << 30)
        files = list_files(spark, f"{root}/{area}").select(
            F.lit(area).alias("area"), F.substring_index(inner, "/", 1).alias("folder"), "modificationTime"
        )
        parts.append(files)
    every = reduce(lambda a, b: a.union(b), parts)
    return every.groupBy("area", "folder").agg(F.max("modificationTime").alias("newest"))


def _referenced(ledger: Ledger, oldest: int) -> DataFrame:
    """area, folder of everything the versions from ``oldest`` on need: their tables, the changes between them, and
    the ledger's own files."""
    runs = ledger.runs()
    kept = runs.where(F.col("version") >= oldest)
    needed = {
        "target": F.array_union(
            F.coalesce("pending", F.array().cast("array<string>")),
            F.concat(
                F.coalesce(F.col("segments").getField("folder"), F.array().cast("array<string>")),
                F.array("base", "changes", "change_log"),
            ),
        ),
        "state/checkpoints": F.array("checkpoint"),
    }

    def named(rows: DataFrame, area: str, folders: Column) -> DataFrame:
        return rows.select(F.lit(area).alias("area"), F.explode(folders).alias("folder")).where("folder IS NOT NULL")

    # Results of files are in the checkpoint up to its version; later ones are read run by run.
    covered = kept.agg(F.min(F.coalesce("checkpoint_version", F.lit(0))).alias("v")).first()["v"] or 0
    recent = runs.where(F.col("version") > covered)
    parts = [named(kept, area, folders) for area, folders in needed.items()]
    parts.append(named(recent, "state/files", F.array(F.concat(F.lit("run_id="), "run_id"))))
    return reduce(lambda a, b: a.union(b), parts).distinct()


def unreferenced(
    spark: SparkSession,
    root: str,
    keep_versions: int = 10,
    older_than: timedelta = timedelta(days=7),
    now: datetime | None = None,
) -> DataFrame:
    """area, folder, newest of what none of the newest ``keep_versions`` versions refers to and no one has written to
    for ``older_than``.

    A run in progress refers to nothing yet; its folders are safe while it takes less than ``older_than``. Quarantined
    rows and failed logs are evidence and never listed.
    """
    ledger = Ledger(spark, f"{root}/state")
    before = (now or datetime.now(timezone.utc)) - older_than
    with listing_splits(spark):
        members = _members(spark, root)
    old = members.where(F.col("newest") < F.lit(before.isoformat()).cast("timestamp"))
    old = old.join(_referenced(ledger, _oldest_kept(ledger.head(), keep_versions)), ["area", "folder"], "left_anti")
    # Quarantined rows are told apart by what the results of their run say of their file.
    aside = list_names(spark, f"{root}/quarantine")
    return old.where(~((F.col("area") == "state/files") & F.col("folder").isin(aside))) if aside else old


def _oldest_kept(head: Head, keep_versions: int) -> int:
    if keep_versions < 1:
        raise ValueError("at least the newest version is kept")
    return head.number - keep_versions + 1


def expire(
    spark: SparkSession,
    root: str,
    keep_versions: int = 10,
    older_than: timedelta = timedelta(days=7),
    now: datetime | None = None,
) -> list[str]:
    """Remove what ``unreferenced`` finds, and version files whose rows newer ones repeat; returns their names.

    First all is found, then removed, so a run that commits meanwhile loses nothing: it can only refer to folders of the
    kept versions and to its own. Earlier versions can no longer be read.
    """
    ledger = Ledger(spark, f"{root}/state")
    head = ledger.head()
    if not head.run:
        return []
    found = unreferenced(spark, root, keep_versions, older_than, now).select("area", "folder").collect()
    oldest = _oldest_kept(head, keep_versions)
    gone = []
    for row in sorted(found):
        remove(spark, f"{root}/{row['area']}/{row['folder']}")
        gone.append(f"{row['area']}/{row['folder']}")
    if ledger.complete(head):
        for name in list_names(spark, ledger.runs_path):
            number = name.removeprefix("version-").removesuffix(".json")
            if number.isdigit() and int(number) < oldest:
                remove(spark, f"{ledger.runs_path}/{name}")
                gone.append(f"state/runs/{name}")
    return gone
