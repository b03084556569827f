"""File listings as DataFrames, and the rules that pick the files a run has to read."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.convert import parse_mark_time
from tidemark.schema import LISTING_SCHEMA
from tidemark.session import empty_table, exists, settings

# Fixed value: part of the path that marks state files, which are never input.
STATE_MARKER = ".watermark/"

PARQUET = "*.parquet"


def list_files(
    spark: SparkSession,
    prefix: str,
    start_after: str | None = None,
    glob: str | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """``path, modificationTime, length`` of every file below ``prefix``.

    File contents are never opened: the content column is pruned. Large folders are
    listed by Spark's parallel listing job. A missing prefix is an empty listing.
    """
    if not exists(spark, prefix):
        return empty_table(spark, LISTING_SCHEMA)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    files = reader.load(prefix).select("path", "modificationTime", "length")
    if start_after:
        files = files.where(F.col("path") > start_after)
    return files


def listing_splits(spark: SparkSession):
    """Pack many listed files into each task while a listing is being written.

    The planner sizes splits by file length, which for a listing is the size of data
    nobody reads: 100 TB would become a million tasks of one row each.
    """
    return settings(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 40)})


def exclude_state(files: DataFrame, marker: str = STATE_MARKER) -> DataFrame:
    return files.where(~F.col("path").contains(marker))


def only_parquet(files: DataFrame) -> DataFrame:
    return files.where(F.col("path").endswith(".parquet"))


def newer_than_mark(files: DataFrame, mark: Mapping | None) -> DataFrame:
    """Files after the high-water mark: both a later path and a later modification time.

    An unset or empty part of the mark does not restrict. ``last_successful_run`` may
    be ISO text (``Z`` allowed) or a datetime.
    """
    files = exclude_state(files)
    if not mark:
        return files
    last_file = mark.get("last_processed_file")
    if last_file:
        files = files.where(F.col("path") > last_file)
    moment = mark.get("last_successful_run")
    if moment:
        if isinstance(moment, datetime):
            moment = moment.isoformat()
        files = files.where(F.col("modificationTime") > parse_mark_time(F.lit(moment)))
    return files


def new_or_changed(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose (path, modification time) no successful run has recorded.

    A file deposited again under an old name is picked up; one that failed is retried.
    """
    seen = done.where(F.col("status") == "ok").select("path", "modificationTime")
    return exclude_state(files).join(seen, ["path", "modificationTime"], "left_anti")
