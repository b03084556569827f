"""Audit columns: when a row was processed, and in which batch."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import new_batch_id
from tidemark.schema import BATCH_ID, KEY, PROCESSED_AT


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def wall_clock(moment: datetime) -> Column:
    """A driver-side moment as a zone-free UTC literal; naive values are taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def add_audit_columns(
    df: DataFrame, batch_id: str | Column | None = None, processed_at: datetime | None = None
) -> DataFrame:
    """One time and one id for the whole table, fixed before the job starts."""
    identifier = batch_id if isinstance(batch_id, Column) else F.lit(batch_id or new_batch_id())
    return df.withColumns(
        {PROCESSED_AT: wall_clock(processed_at or utc_now()), BATCH_ID: identifier}
    )


def key_first(df: DataFrame, key: str = KEY) -> DataFrame:
    """The key column in front, the others in their order."""
    return df.select(key, *[c for c in df.columns if c != key])
