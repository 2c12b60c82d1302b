"""Column expressions shared by the reports (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trip_duration_minutes(pickup: str | Column, dropoff: str | Column) -> Column:
    """Whole seconds between pickup and dropoff, in minutes.

    The difference of two timestamps is an exact day-time interval; cast to
    seconds it does not move with the session time zone. (``timestamp_diff``
    on TIMESTAMP_NTZ passes through the session zone and gains an hour across
    a DST gap.)
    """
    p = F.col(pickup) if isinstance(pickup, str) else pickup
    d = F.col(dropoff) if isinstance(dropoff, str) else dropoff
    seconds = (d - p).cast(T.DayTimeIntervalType(T.DayTimeIntervalType.SECOND,
                                                   T.DayTimeIntervalType.SECOND)).cast("bigint")
    return seconds / F.lit(60.0)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole rounded; 0 for an empty whole (no division by zero)."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole), digits), F.lit(0.0))


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    """Order-insensitive fingerprint of a table: sum of per-row xxhash64.

    Each column is hashed with its null flag, as ``xxhash64`` skips nulls and
    would not see a null move to another column. The sum is taken as a decimal
    so it cannot overflow; equal multisets of rows give equal sums.
    """
    flagged = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.sum(F.xxhash64(*flagged).cast("decimal(38,0)"))


def sql_string_literal(text: str) -> str:
    """Quote text for a SQL string literal (``'`` doubled)."""
    return "'" + text.replace("'", "''") + "'"
