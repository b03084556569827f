"""Keyed upsert, change feed, and the closed form of many upserts in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_latest, free_name, recency
from tidemark.schema import AUDIT_COLUMNS, DATES, KEY, ORDER, SUPPLIED

CONFLICTS = ("arrival", "latest")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = (KEY,),
    conflict: str = "arrival",
    order_by: str = ORDER,
) -> DataFrame:
    """``target`` after inserting or overwriting the rows of ``updates`` (one per key).

    Supplied values overwrite, NULL included. A column ``updates`` lacks, or that a
    row's optional ``_supplied`` array leaves out, keeps its stored value on update
    and is NULL on insert. ``conflict="latest"`` ignores an incoming row that is
    older than the stored one; a NULL date counts as oldest.

    One full outer join decides every column, so neither side is evaluated twice.
    """
    return merge_rows(target, updates, keys, conflict, order_by)


def overlay(target: DataFrame, updates: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Upsert of whole rows in arrival order: the target without the incoming keys, and the incoming rows.

    Reads ``updates`` twice, so it suits stored ones; Spark can broadcast few keys and then neither moves nor sorts
    the target.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


def merge_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = (KEY,),
    conflict: str = "arrival",
    order_by: str = ORDER,
) -> DataFrame:
    """The general form of ``upsert``: one full outer join, every column decided by itself.

    With ``conflict="latest"`` a column is taken if its date is not before the stored
    column's. A column's date is its row's, but for those the hidden ``_dates`` map names: a
    target that has this map keeps it up to date, so partial rows may come in any order
    and any grouping. A column no row has supplied yet is older than any date.
    """
    _check(target, updates, keys, conflict)
    joined, _, taken, dates = _decided(target, updates, keys, conflict, order_by, "full_outer")
    out = []
    for name in target.columns:
        if name == DATES:
            continue
        if name in keys:
            out.append(F.coalesce(F.col(f"t.{name}"), F.col(f"u.{name}")).alias(name))
            continue
        fresh = F.col(f"u.{name}") if name in updates.columns else F.lit(None)
        out.append(F.when(taken[name], fresh).otherwise(F.col(f"t.{name}")).alias(name))
    if DATES not in target.columns:
        return joined.select(*out)
    return joined.select(*out, _own_dates(dates, order_by).alias(DATES))


def _decided(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], conflict: str, order_by: str, how: str
) -> tuple[DataFrame, tuple[str, str], dict[str, Column], dict[str, Column]]:
    """Both sides joined by key (as ``t`` and ``u``), names of the two flags of presence, and for every column of the
    target whether the incoming value is taken and, where dates decide, the date it then has."""
    if conflict == "latest" and order_by not in updates.columns:
        raise ValueError(f"updates have no column {order_by} to be compared by")
    in_target, in_updates = free_name("_in_target", target, updates), free_name("_in_updates", target, updates)
    t = target.withColumn(in_target, F.lit(True)).alias("t")
    u = updates.withColumn(in_updates, F.lit(True)).alias("u")
    joined = t.join(u, _same_key(keys), how)
    present = F.coalesce(F.col(f"u.{in_updates}"), F.lit(False))
    kind = target.schema[order_by].dataType if order_by in target.columns else None
    taken, dates = {}, {}
    for name in target.columns:
        if name == DATES or name in keys:
            continue
        given = F.lit(name in updates.columns)
        if name in updates.columns and SUPPLIED in updates.columns:
            given = F.array_contains(F.col(f"u.{SUPPLIED}"), name)
        take = present & F.coalesce(given, F.lit(False))
        if conflict == "latest":
            stored = _date_of("t", name, target, order_by)
            incoming = _date_of("u", name, updates, order_by)
            newer = F.col(f"t.{in_target}").isNull() | stored.isNull() | (incoming >= stored)
            take = take & F.coalesce(newer, F.lit(False))
            dates[name] = F.when(take, incoming).when(F.col(f"t.{in_target}"), stored).cast(kind)
        taken[name] = take
    return joined, (in_target, in_updates), taken, dates


def classify(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = (KEY,),
    conflict: str = "arrival",
    order_by: str = ORDER,
) -> DataFrame:
    """The rows of ``updates`` (one per key) with what upserting them would do, as ``_change_type``.

    ``insert``: the key is new; ``update``: a column but the audit columns gets another value; ``stale``: dates decide
    and no column is taken; ``unchanged``: all that is taken is there already.
    """
    _check(target, updates, keys, conflict)
    joined, (in_target, _), taken, _ = _decided(target, updates, keys, conflict, order_by, "right_outer")
    differs, any_taken = F.lit(False), F.lit(False)
    for name, take in taken.items():
        any_taken = any_taken | take
        if name not in AUDIT_COLUMNS and name in updates.columns:
            differs = differs | (take & ~F.col(f"t.{name}").eqNullSafe(F.col(f"u.{name}")))
    kind = F.when(F.col(f"t.{in_target}").isNull(), "insert").when(differs, "update")
    if conflict == "latest":
        kind = kind.when(~any_taken, "stale")
    return joined.select(*[F.col(f"u.{c}") for c in updates.columns], kind.otherwise("unchanged").alias("_change_type"))


def _date_of(alias: str, name: str, df: DataFrame, order_by: str) -> Column:
    """The date of a column in a row: its own, where the row has one for it, else the row's."""
    row = F.col(f"{alias}.{order_by}")
    if DATES not in df.columns:
        return row
    own = F.col(f"{alias}.{DATES}")
    return F.when(F.coalesce(F.map_contains_key(own, name), F.lit(False)), own[name]).otherwise(row)


def _own_dates(dates: dict[str, Column], order_by: str) -> Column:
    """The map of the columns whose date is not the row's; NULL where there is none."""
    every = F.map_from_arrays(F.array(*[F.lit(c) for c in dates]), F.array(*dates.values()))
    own = F.map_filter(every, lambda c, d: ~d.eqNullSafe(dates[order_by]))
    return F.when(F.size(own) > 0, own)


def fold_arrivals(
    df: DataFrame,
    keys: Sequence[str] = (KEY,),
    arrival: Sequence[str] = (ORDER,),
    columns: Sequence[str] | None = None,
    dated: str | None = None,
) -> DataFrame:
    """What remains per key after upserting all rows one by one in ``arrival`` order.

    The last row wins. With a ``_supplied`` array on the rows, each column comes from
    the last row that supplies it, and the result carries the union of the arrays.
    At most one row per key and task is shuffled (with ``_supplied``: per key and set of
    supplied columns, then once more), however many files or slices the rows came from.

    ``dated`` names the date that leads ``arrival``: columns are then compared by their own
    dates (``_dates`` of the rows, else the row's), and the result has such a map.
    """
    columns = [c for c in (columns or df.columns) if c not in keys and c not in (SUPPLIED, DATES)]
    if SUPPLIED not in df.columns:
        needed = dict.fromkeys([*keys, *columns, *arrival])
        return dedup_latest(df.select(*needed), keys, arrival, ()).select(*keys, *columns)
    # First the last row of each set of supplied columns, then each column's last among
    # those few: the wide comparison never sees the full input.
    aged = dated is not None and DATES in df.columns
    needed = dict.fromkeys([*keys, SUPPLIED, *columns, *arrival, *([DATES] if aged else [])])
    rows = df.select(*needed)
    if not aged:  # columns as old as their rows: of each set of columns, one row has the last of all
        rows = dedup_latest(rows, [*keys, SUPPLIED], arrival, ())
    rows = rows.alias("r")
    last, per_dates = recency(arrival), []
    # Boxing each value in a struct keeps a supplied NULL apart from "not supplied".
    per_column = []
    for c in columns:
        given = F.array_contains(SUPPLIED, c)
        if dated:
            date = _date_of("r", c, rows, dated)
            last = F.struct(date.alias("o0"), *[F.col(x).alias(f"o{i}") for i, x in enumerate(arrival[1:], 1)])
            box = F.when(given, F.struct(F.col(c).alias("v"), date.alias("d")))
        else:
            box = F.when(given, F.struct(F.col(c).alias("v")))
        per_column.append(F.max_by(box, F.when(given, last)).alias(f"_last_{c}"))
    folded = rows.groupBy(*keys).agg(*per_column)
    boxes = {c: F.col(f"_last_{c}") for c in columns}
    supplied = F.array_compact(
        F.array(
            *[F.lit(k) for k in keys],
            *[F.when(box.isNotNull(), F.lit(c)) for c, box in boxes.items()],
        )
    )
    if dated:
        per_dates = [_own_dates({c: box.getField("d") for c, box in boxes.items()}, dated).alias(DATES)]
    return folded.select(
        *keys, *[box.getField("v").alias(c) for c, box in boxes.items()], supplied.alias(SUPPLIED), *per_dates
    )


def change_feed(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = (KEY,),
    order_by: str | None = ORDER,
    compare: Sequence[str] | None = None,
    include_untouched: bool = False,
) -> DataFrame:
    """What each key of ``updates`` would do: insert, update, unchanged or stale.

    The row shown is the incoming one. ``include_untouched`` adds the stored rows no
    update mentions. Without it the target is first reduced to the incoming keys: while
    those are few Spark broadcasts them and the target is never shuffled; otherwise both
    joins share one shuffle by key.
    """
    if compare is None:
        compare = [
            c
            for c in updates.columns
            if c in target.columns and c not in keys and c not in AUDIT_COLUMNS
        ]
    if not include_untouched:
        target = target.join(updates.select(*keys), list(keys), "left_semi")
    in_target, in_updates = free_name("_in_target", target, updates), free_name("_in_updates", target, updates)
    t = target.withColumn(in_target, F.lit(True)).alias("t")
    u = updates.withColumn(in_updates, F.lit(True)).alias("u")
    joined = t.join(u, _same_key(keys), "full_outer" if include_untouched else "right_outer")
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}"))
    kind = F.when(F.col(f"u.{in_updates}").isNull(), "untouched").when(
        F.col(f"t.{in_target}").isNull(), "insert"
    )
    if order_by is not None:
        stored, incoming = F.col(f"t.{order_by}"), F.col(f"u.{order_by}")
        older = stored.isNotNull() & (incoming.isNull() | (incoming < stored))
        kind = kind.when(older, "stale")
    kind = kind.when(same, "unchanged").otherwise("update")

    def shown(name: str) -> Column:
        if include_untouched and name in target.columns:
            return F.when(F.col(f"u.{in_updates}").isNull(), F.col(f"t.{name}")).otherwise(
                F.col(f"u.{name}")
            )
        return F.col(f"u.{name}")

    return joined.select(*[shown(c).alias(c) for c in updates.columns], kind.alias("_change_type"))


def merge_into_table(updates: DataFrame, table: str, keys: Sequence[str] = (KEY,)) -> None:
    """Upsert into a catalog table whose format supports row-level operations."""
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"{table}.{k}") == F.col(f"incoming.{k}"))
    values = {c: F.col(f"incoming.{c}") for c in updates.columns}
    (
        updates.alias("incoming")
        .mergeInto(table, on)
        .whenMatched()
        .update({c: v for c, v in values.items() if c not in keys})
        .whenNotMatched()
        .insert(values)
        .merge()
    )


def _same_key(keys: Sequence[str]) -> Column:
    on = None
    for k in keys:
        same = F.col(f"t.{k}") == F.col(f"u.{k}")
        on = same if on is None else on & same
    return on


def _check(target: DataFrame, updates: DataFrame, keys: Sequence[str], conflict: str) -> None:
    if conflict not in CONFLICTS:
        raise ValueError(f"conflict must be one of {CONFLICTS}")
    unknown = set(updates.columns) - set(target.columns) - {SUPPLIED}
    missing = [k for k in keys if k not in target.columns or k not in updates.columns]
    if unknown or missing:
        raise ValueError(f"columns unknown to the target: {sorted(unknown)}, missing keys: {missing}")
