"""Latest row per key, in one shuffle of rows already cut down to one per key and task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schema import KEY, ORDER, PATH, ROW


def recency(order: Sequence[str]) -> Column:
    """A never-NULL value that is largest for the most recent row, for ``max_by``.

    Structs compare field by field with NULL smallest, so a NULL date loses to any
    date. The struct itself is never NULL: ``max_by`` ignores NULL orderings and would
    drop a key whose dates are all NULL.
    """
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = (KEY,),
    order: Sequence[str] = (ORDER,),
    tiebreak: Sequence[str] | None = None,
    nulls: str = "last",
    within: Sequence[str] = (),
) -> DataFrame:
    """One row per key (and per ``within`` group): the one latest by ``order``.

    Rows equal on ``order`` are told apart by ``tiebreak``, largest first; by default
    the later file and then the later row in it, or all other columns where the
    position is unknown. A NULL key counts as one key.

    Spark plans a rank filtered to 1 with a group limit on both sides of the shuffle:
    each map task sends at most one row per key, so a key holding a third of the input
    costs no more to shuffle than any other.
    """
    if nulls not in ("first", "last"):
        raise ValueError("nulls must be 'first' or 'last'")
    # Keys lead: they differ early, where a path repeats through a whole file.
    group = [*keys, *within]
    if tiebreak is None:
        positioned = [c for c in (PATH, ROW) if c in df.columns]
        tiebreak = positioned or [c for c in df.columns if c not in group and c not in order]
    latest_first = [F.desc_nulls_last(c) for c in [*order, *tiebreak]]
    if nulls == "first":
        latest_first[0] = F.desc_nulls_first(order[0])
    if not latest_first:
        return df.distinct()
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*latest_first))
    name = free_name("_rank", df)
    return df.withColumn(name, rank).where(F.col(name) == 1).drop(name)


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, or a like one that no table has as a column."""
    used = {c.lower() for t in tables for c in t.columns}
    while name in used:
        name = f"_{name}"
    return name
