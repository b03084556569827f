"""Fixed-size row slices of a file, numbered from the position each row has in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import BATCH, BATCH_SIZE, KEY, PATH, ROW


def batch_number(row: Column, batch_size: int = BATCH_SIZE) -> Column:
    """1 for the first ``batch_size`` rows of a file, 2 for the next, and so on."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    return (F.call_function("div", row, F.lit(batch_size)) + 1).cast("int")


def number_batches(df: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add ``_batch``. Rows need ``_row`` (see ``sources.parquet.read_parquet``); no shuffle."""
    return df.withColumn(BATCH, batch_number(F.col(ROW), batch_size))


def batch_stats(
    df: DataFrame, keys: Sequence[str] = (KEY,), by: Sequence[str] = (PATH, BATCH)
) -> DataFrame:
    """Rows in, rows kept and duplicates per slice.

    Keys are counted inside a struct, because a plain distinct count skips NULL
    while deduplication keeps one row for it.
    """
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("input_rows"),
            F.count_distinct(F.struct(*keys)).cast("bigint").alias("output_rows"),
        )
        .withColumn("duplicates_removed", F.col("input_rows") - F.col("output_rows"))
    )
