"""Append-only output of processed rows in folders by date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_processed(df: DataFrame, root: str, processed_date: date | str, run_id: str) -> str:
    """Write one run's rows below ``root/processed_date=.../run_id=...``.

    Earlier runs are never touched. The run's own folder is replaced as a whole, so
    repeating a run that died does not double its rows.
    """
    folder = f"{root}/processed_date={processed_date}/run_id={run_id}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def read_processed(spark, root: str, processed_date: date | str | None = None) -> DataFrame:
    rows = spark.read.parquet(root)
    if processed_date is not None:
        rows = rows.where(F.col("processed_date") == F.lit(str(processed_date)).cast("date"))
    return rows
