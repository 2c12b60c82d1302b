"""Gold layer: silver tables of all trip sources, unioned, with a date floor."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import layout


def ts_literal(df: DataFrame, column: str, value: dt.datetime) -> Column:
    """A literal of the column's own timestamp type (NTZ or LTZ), folded at plan time.

    Comparing like with like keeps the predicate a plain literal comparison
    that reaches ``PushedFilters`` of the parquet scan.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(df.schema[column].dataType)


# Gold is Hive-partitioned by the month of pickup (a date, first of the month).
PARTITION_COLUMN = "pickup_month"


def month_bounds(start: dt.datetime | None, end: dt.datetime | None) -> tuple:
    """First and last ``pickup_month`` that can hold a pickup in ``[start, end)``.

    The last month is that of the instant just before ``end``, so a period
    ending on the first of a month does not reach into that month's folder.
    """
    first = dt.date(start.year, start.month, 1) if start is not None else None
    if end is None:
        return first, None
    before = end - dt.timedelta(microseconds=1)
    return first, dt.date(before.year, before.month, 1)


def _date_literal(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def in_period(df: DataFrame, start: dt.datetime | None, end: dt.datetime | None,
              column: str = "pickup_datetime") -> Column:
    """``start <= column < end``; either bound may be absent.

    On a table partitioned by ``pickup_month`` the matching predicate on the
    partition column is added (``month_bounds``), so the scan prunes whole
    month directories instead of opening every file's footer.
    """
    cond = F.lit(True)
    pruned = column == "pickup_datetime" and PARTITION_COLUMN in df.columns
    first, last = month_bounds(start, end)
    if pruned and isinstance(df.schema[column].dataType, T.TimestampType):
        # an instant's month was taken in the writer's zone, the bounds are in the reader's: a day more on both sides
        day = dt.timedelta(days=1)
        first, last = month_bounds(start and start - day, end and end + day)
    if start is not None:
        cond = cond & (F.col(column) >= ts_literal(df, column, start))
        if pruned:
            cond = cond & (F.col(PARTITION_COLUMN) >= _date_literal(first))
    if end is not None:
        cond = cond & (F.col(column) < ts_literal(df, column, end))
        if pruned:
            cond = cond & (F.col(PARTITION_COLUMN) <= _date_literal(last))
    return cond


def gold_frame(silver: list[DataFrame], start: dt.datetime, end: dt.datetime | None = None) -> DataFrame:
    """U1 + F2 + P4: union by name, keep pickups on or after ``start`` (and before ``end``)."""
    union = reduce(DataFrame.unionByName, silver)
    return union.filter(in_period(union, start, end)).withColumn("_computed_at", F.current_timestamp())


def build_gold(silver: list[DataFrame], path: str, start: dt.datetime,
               end: dt.datetime | None = None,
               types: tuple[str, ...] = ("yellow", "green")) -> dict[str, int]:
    """K4 + K5 + K9: overwrite gold; returns rows per taxi type, observed on the write.

    Files are range-clustered on pickup time and Hive-partitioned by pickup month.
    """
    df = gold_frame(silver, start, end).withColumn(
        PARTITION_COLUMN, F.trunc(F.col("pickup_datetime").cast("date"), "month"))
    obs = Observation("gold")
    layout.write_clustered(df, path, observation=obs,
                           metrics=[F.count(F.lit(1)).alias("rows"),
                                    *[F.count_if(F.col("taxi_type") == t).alias(t) for t in types]],
                           partition_by=(PARTITION_COLUMN,))
    got = obs.get
    return {"total": int(got["rows"]), **{t: int(got[t]) for t in types}}
