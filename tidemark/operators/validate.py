"""Row checks that stand in for the target's constraints, and the split they drive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.normalize import error_list
from tidemark.schema import ERRORS, KEY, VARCHAR_LIMITS


class ErrorRateExceeded(RuntimeError):
    """Too large a share of the rows failed validation."""


def check_rows(
    df: DataFrame,
    required: Sequence[str] = (KEY,),
    limits: Mapping[str, int] = VARCHAR_LIMITS,
) -> DataFrame:
    """Append ``null:<column>`` and ``length:<column>`` to the ``_errors`` array.

    A required column that the earlier casts already rejected is reported once,
    as the cast error.
    """
    known = F.col(ERRORS) if ERRORS in df.columns else None
    flags = {}
    for name in required:
        empty = F.col(name).isNull() if name in df.columns else F.lit(True)
        if known is not None:
            empty = empty & ~F.array_contains(known, f"cast:{name}")
        flags[f"null:{name}"] = empty
    for name, limit in limits.items():
        if name in df.columns:
            too_long = F.char_length(F.col(name)) > limit
            flags[f"length:{name}"] = F.coalesce(too_long, F.lit(False))
    found = error_list(flags)
    return df.withColumn(ERRORS, found if known is None else F.concat(known, found))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without errors, rows with errors)."""
    return df.where(F.size(ERRORS) == 0), df.where(F.size(ERRORS) > 0)


def key_violations(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Keys that break a primary key: present more than once, or with a NULL part.

    Only counts travel, one row per key and task, so a hot key is harmless.
    """
    null_part = F.lit(False)
    for key in keys:
        null_part = null_part | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) | null_part)
        .select(*keys, F.col("n").cast("bigint").alias("n"))
    )


def error_rate(df: DataFrame, threshold: float = 0.001) -> DataFrame:
    """One row: rows seen, rows failing validation, their ratio, and whether it is below the threshold.

    The default threshold is the published target of under 0.1 percent.
    """
    total = F.count(F.lit(1)).cast("bigint")
    failed = F.count_if(F.size(ERRORS) > 0).cast("bigint")
    ratio = F.when(F.col("rows_total") > 0, F.col("rows_failed") / F.col("rows_total")).otherwise(0.0)
    return (
        df.agg(total.alias("rows_total"), failed.alias("rows_failed"))
        .withColumn("error_rate", ratio)
        .withColumn("within_limit", F.col("error_rate") < F.lit(threshold))
    )


def enforce_error_rate(total: int, failed: int, threshold: float | None) -> None:
    if threshold is not None and total and failed / total >= threshold:
        raise ErrorRateExceeded(f"{failed} of {total} rows failed validation, limit {threshold:.4%}")
