"""Bring a table to the expected column types, with a choice of what a bad value means."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import convert
from tidemark.schema import ERRORS, RAW, RAW_SCHEMA

log = logging.getLogger(__name__)

POLICIES = ("null", "keep_column", "quarantine")


def _conversions(
    df: DataFrame, schema: T.StructType, units: Mapping[str, str]
) -> dict[str, Column]:
    """Converted value of each expected column the table has."""
    have = {f.name: f.dataType for f in df.schema}
    return {
        f.name: convert(
            F.col(f"`{f.name}`"),
            have[f.name],
            f.dataType,
            unit=units.get(f.name, ""),
            any_type=f.name not in RAW_SCHEMA.fieldNames(),
        )
        for f in schema
        if f.name in have
    }


def _rejected(before: Column, after: Column) -> Column:
    return before.isNotNull() & after.isNull()


def cast_failure_counts(
    df: DataFrame, schema: T.StructType = RAW_SCHEMA, units: Mapping[str, str] | None = None
) -> DataFrame:
    """One row: for each expected column present, how many values cannot be converted."""
    found = _conversions(df, schema, units or {})
    return df.agg(
        *[F.count_if(_rejected(F.col(f"`{c}`"), v)).cast("bigint").alias(c) for c, v in found.items()]
    )


def normalize(
    df: DataFrame,
    schema: T.StructType = RAW_SCHEMA,
    on_error: str = "null",
    units: Mapping[str, str] | None = None,
) -> DataFrame:
    """Cast the expected columns; other columns pass through, missing ones are not added.

    ``on_error``
        ``"null"`` turns a bad value into NULL. ``"keep_column"`` leaves a column
        uncast if any of its values is bad (costs one counting pass).
        ``"quarantine"`` turns it into NULL and adds the array column ``_errors``
        (``cast:<column>``) plus ``_raw_record``, the untouched row as JSON, filled
        only for rows with errors.
    """
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}")
    found = _conversions(df, schema, units or {})
    if on_error == "keep_column":
        counts = cast_failure_counts(df, schema, units).first() if found else {}
        for name in [c for c in found if counts[c]]:
            log.warning("column %s left uncast: %d values cannot be converted", name, counts[name])
            del found[name]
    if on_error != "quarantine":
        return df.select(*[found[c].alias(c) if c in found else F.col(f"`{c}`") for c in df.columns])
    # The values are computed in one step and judged in the next, so each is cast once.
    cast = df.select("*", *[v.alias(f"_cast_{c}") for c, v in found.items()])
    bad = {c: _rejected(F.col(f"`{c}`"), F.col(f"`_cast_{c}`")) for c in found}
    failed = reduce(or_, bad.values(), F.lit(False))
    untouched = F.to_json(F.struct(*[F.col(f"`{c}`") for c in found]))
    return cast.select(
        *[F.col(f"`_cast_{c}`").alias(c) if c in found else F.col(f"`{c}`") for c in df.columns],
        error_list({f"cast:{c}": flag for c, flag in bad.items()}).alias(ERRORS),
        F.when(failed, untouched).alias(RAW),
    )


def error_list(flags: Mapping[str, Column]) -> Column:
    """The names of the flags that are set, as an array.

    The list is only put together for rows with an error; for all others the flags are
    tested and that is it.
    """
    none = F.array().cast("array<string>")
    if not flags:
        return none
    found = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))
    return F.when(reduce(or_, flags.values()), found).otherwise(none)


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default, column by column; columns without a default keep theirs."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
            for name, value in defaults.items()
            if name in df.columns
        }
    )
