"""Counts of a table, a slice or a run, gathered without extra scans where possible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


class TableStats:
    """Input and output rows of one step, observed while its result is being written.

    ``watch_input`` and ``watch_output`` pass the table through; the numbers are
    there once an action has run. No second scan takes place.
    """

    def __init__(self, batch_id: str):
        self.batch_id = batch_id
        self._before = Observation()
        self._after = Observation()

    def watch_input(self, df: DataFrame) -> DataFrame:
        return df.observe(self._before, F.count(F.lit(1)).alias("rows"))

    def watch_output(self, df: DataFrame) -> DataFrame:
        return df.observe(self._after, F.count(F.lit(1)).alias("rows"))

    def result(self) -> dict:
        """Blocks until the watched action has finished."""
        before, after = self._before.get["rows"], self._after.get["rows"]
        return {
            "batch_id": self.batch_id,
            "input_rows": before,
            "output_rows": after,
            "duplicates_removed": before - after,
        }


def run_totals(files: DataFrame, *more: Column) -> DataFrame:
    """Totals over per-file results with ``status``, ``records`` and ``records_failed``.

    Rows of a failed file count in neither sum: none of them reached the target. ``more``
    are aggregates to take in the same pass.
    """
    ok = F.col("status") == "ok"
    return files.agg(
        F.count_if(ok).cast("bigint").alias("files_processed"),
        F.count_if(~ok).cast("bigint").alias("files_failed"),
        F.coalesce(F.sum(F.when(ok, F.col("records"))), F.lit(0)).cast("bigint").alias("records_processed"),
        F.coalesce(F.sum(F.when(ok, F.col("records_failed"))), F.lit(0)).cast("bigint").alias("records_failed"),
        *more,
    )


def throughput(runs: DataFrame) -> DataFrame:
    """Latency and rows per second of each run in a ledger; its times are instants or ISO text."""
    start, end = (F.unix_micros(F.col(name).cast("timestamp")) for name in ("start_time", "end_time"))
    seconds = (end - start) / F.lit(1e6)
    return runs.select(
        "run_id",
        seconds.alias("latency_seconds"),
        F.when(seconds > 0, F.col("records_processed") / seconds).alias("rows_per_second"),
    )
