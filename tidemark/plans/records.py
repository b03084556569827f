"""From raw rows to target rows: one table, or every slice of its files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import new_batch_id, slice_batch_id
from tidemark.operators.audit import add_audit_columns
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.metrics import TableStats
from tidemark.operators.normalize import normalize
from tidemark.operators.slices import number_batches
from tidemark.schema import BATCH, BATCH_SIZE, PATH, ROW


def process_table(
    df: DataFrame,
    batch_id: str | None = None,
    processed_at: datetime | None = None,
    tiebreak: list[str] | None = None,
    stats: TableStats | None = None,
) -> DataFrame:
    """Normalise, keep the latest row per id, add audit columns.

    Pass a ``TableStats`` to learn the row counts once the result has been written.
    Working columns (position, tiebreak columns outside the record) stay in the result.
    """
    batch_id = batch_id or new_batch_id()
    rows = normalize(df)
    if stats is not None:
        rows = stats.watch_input(rows)
    rows = dedup_latest(rows, tiebreak=tiebreak)
    if stats is not None:
        rows = stats.watch_output(rows)
    return add_audit_columns(rows, batch_id, processed_at)


def process_slices(
    df: DataFrame,
    batch_size: int = BATCH_SIZE,
    batch_id: str | None = None,
    processed_at: datetime | None = None,
) -> DataFrame:
    """The same for each fixed-size slice of each file, all slices in one job.

    Needs rows with positions. Adds ``_batch``; the batch id gets the suffix ``_b<n>``.
    """
    rows = number_batches(normalize(df), batch_size)
    rows = dedup_latest(rows, within=(PATH, BATCH), tiebreak=[ROW])
    return add_audit_columns(rows, slice_batch_id(batch_id or new_batch_id(), F.col(BATCH)), processed_at)
