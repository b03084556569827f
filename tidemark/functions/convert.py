"""Conversions between column types that never fail a task.

Every function builds a Catalyst expression, so it stays inside generated code.
A value that cannot be converted becomes NULL; the caller compares the result
with the input to learn that it was rejected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import INTEGER_TEXT, ISO_TIMESTAMP

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def to_text(value: Column) -> Column:
    return value.cast("string")


def to_bigint(value: Column) -> Column:
    return value.try_cast("bigint")


def text_to_bigint(value: Column) -> Column:
    """Integer text to a number. Other text is sorted out by its shape first: ``try_cast``
    alone gives the same result, but raises and catches an exception for every bad value.
    """
    return F.when(value.rlike(INTEGER_TEXT), to_bigint(value))


def parse_iso(value: Column) -> Column:
    """ISO text to a zone-free timestamp.

    A plain ``try_cast`` would also take a space separator, a bare date or a
    trailing zone; those are rejected here.
    """
    return F.when(value.rlike(ISO_TIMESTAMP), value.try_cast("timestamp_ntz"))


def iso_text(value: Column) -> Column:
    """Timestamp as ISO text with six fraction digits, for text sinks."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def micros_to_ntz(micros: Column) -> Column:
    """Microseconds since the epoch as a UTC wall-clock value, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH))


def instant_to_ntz(value: Column) -> Column:
    return micros_to_ntz(F.unix_micros(value))


def parse_mark_time(value: Column) -> Column:
    """ISO text of a high-water mark to an instant; ``Z`` and offsets are understood."""
    return value.try_cast("timestamp")


_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def convert(
    value: Column, have: T.DataType, want: T.DataType, *, unit: str = "", any_type: bool = False
) -> Column:
    """``value`` of type ``have`` as ``want``; NULL where that is impossible.

    ``unit="ns"`` marks an integer column that holds nanosecond timestamps. ``any_type`` allows types beyond those of
    the record model, by Spark's own rules.
    """
    if unit == "ns" and isinstance(have, T.LongType):
        value = micros_to_ntz(_floor_div(value, 1000))
        have = T.TimestampNTZType()
    if have == want:
        return value
    if isinstance(want, T.StringType):
        return to_text(value)
    if isinstance(want, T.LongType):
        if isinstance(have, T.StringType):
            return text_to_bigint(value)
        if isinstance(have, (T.BooleanType, *_NUMBERS)):
            return to_bigint(value)
        return F.lit(None).cast(want)
    if isinstance(want, T.TimestampNTZType):
        if isinstance(have, T.StringType):
            return parse_iso(value)
        if isinstance(have, T.TimestampType):
            return instant_to_ntz(value)
        if isinstance(have, T.DateType):
            return value.cast(want)
        return F.lit(None).cast(want)
    if any_type and isinstance(have, T.AtomicType) and isinstance(want, T.AtomicType):
        return value.try_cast(want)
    raise ValueError(f"no conversion to {want.simpleString()}")


def _floor_div(value: Column, by: int) -> Column:
    """Floor division on integers; ``/`` would go through a double."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))
