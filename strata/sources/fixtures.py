"""Raw trip records derived from the driver tables (the mapping of FIXTURES.md).

The reference ingests monthly trip files of a public publisher. The test
harness ships TPC-H-like tables instead, so each raw source is a projection
of one of them, with the defects the pipeline must handle built in: nulls,
cross-file duplicates, same-file reversals, zero/negative amounts, dates
before the period and dropoffs before pickups. Every expression here is a
built-in column expression, so the whole derivation stays in codegen and
scales with the input table.

Each frame carries ``file_month``: the month file the row is delivered in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Driver table behind each raw source.
SOURCE_TABLE = {"yellow": "lineitem", "green": "orders", "fhv": "events", "fhvhv": "events"}


def read_table(spark: SparkSession, tables_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables_dir.rstrip('/')}/{name}.parquet")


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), ts)


def _vendor(key: Column) -> Column:
    k = key % 10
    return (F.when(k == 0, F.lit(None)).when(k < 6, F.lit(1))
            .when(k < 9, F.lit(2)).otherwise(F.lit(6)).cast("bigint"))


def yellow_raw(lineitem: DataFrame) -> DataFrame:
    pk40 = F.col("l_partkey") % 40
    pk50 = F.col("l_partkey") % 50
    offset = (F.col("l_orderkey") % 24) * 60 + F.col("l_partkey") % 60
    sign = F.when(pk50 == 17, F.lit(-1)).otherwise(F.lit(1))
    base = lineitem.select(
        _vendor(F.col("l_partkey")).alias("VendorID"),
        (F.nullif(F.col("l_linenumber"), F.lit(7)) - 1).cast("bigint").alias("passenger_count"),
        F.when(pk40 == 3, F.lit(None).cast("double"))
        .when(pk40 == 5, -F.col("l_quantity"))
        .when(pk40 == 7, F.lit(0.0))
        .otherwise(F.col("l_extendedprice")).alias("total_amount"),
        F.when(pk50 == 11, F.lit(None))
        .otherwise(plus_minutes(F.col("l_shipdate"), offset)).alias("tpep_pickup_datetime"),
        F.when(pk50 == 13, F.lit(None))
        .otherwise(plus_minutes(F.col("l_shipdate"),
                                offset + F.col("l_quantity").cast("bigint") * sign))
        .alias("tpep_dropoff_datetime"),
        F.when(pk40 == 5, F.lit(4)).when(pk40 == 7, F.lit(3)).otherwise(F.lit(1))
        .cast("bigint").alias("payment_type"),
        F.col("l_orderkey").alias("_k"),
        (F.col("l_orderkey") % 5 + 1).alias("file_month"),
    )
    cols = ["VendorID", "passenger_count", "total_amount", "tpep_pickup_datetime",
            "tpep_dropoff_datetime", "payment_type", "_k", "file_month"]
    # same trip delivered again in the next month's file, with a different amount
    redelivered = base.filter(F.col("_k") % 20 == 0).select(
        *[F.col(c) for c in cols[:2]], (F.col("total_amount") + 1).alias("total_amount"),
        *[F.col(c) for c in cols[3:7]], (F.col("file_month") % 5 + 1).alias("file_month"))
    # a charge reversal in the same file: same key, negated amount, dispute payment type
    reversal = base.filter(F.col("_k") % 50 == 1).select(
        *[F.col(c) for c in cols[:2]], (-F.col("total_amount")).alias("total_amount"),
        *[F.col(c) for c in cols[3:5]], F.lit(4).cast("bigint").alias("payment_type"),
        F.col("_k"), F.col("file_month"))
    return base.unionByName(redelivered).unionByName(reversal).drop("_k")


def green_raw(orders: DataFrame) -> DataFrame:
    ck40 = F.col("o_custkey") % 40
    ck50 = F.col("o_custkey") % 50
    offset = (F.col("o_custkey") % 24) * 60 + F.col("o_orderkey") % 60
    return orders.select(
        _vendor(F.col("o_custkey")).alias("VendorID"),
        F.nullif(F.col("o_orderkey") % 7, F.lit(6)).cast("bigint").alias("passenger_count"),
        F.when(ck40 == 3, F.lit(None).cast("double"))
        .when(ck40 == 5, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice")).alias("total_amount"),
        F.when(ck50 == 11, F.lit(None))
        .otherwise(plus_minutes(F.col("o_orderdate"), offset)).alias("lpep_pickup_datetime"),
        F.when(ck50 == 13, F.lit(None))
        .otherwise(plus_minutes(F.col("o_orderdate"), offset + 5 + F.col("o_orderkey") % 45))
        .alias("lpep_dropoff_datetime"),
        (F.col("o_orderkey") % 5 + 1).alias("file_month"),
    )


def fhvhv_raw(events: DataFrame, with_fare: bool = True) -> DataFrame:
    cols = [
        plus_minutes(F.col("ts"), F.lit(0)).alias("pickup_datetime"),
        plus_minutes(F.col("ts"), 5 + F.col("event_id") % 40).alias("dropoff_datetime"),
    ]
    if with_fare:
        cols.append(F.col("value").alias("base_passenger_fare"))
    cols.append((F.col("event_id") % 5 + 1).alias("file_month"))
    return events.select(*cols)


def raw_trips(spark: SparkSession, tables_dir: str, source: str) -> DataFrame:
    """All raw rows of one source, tagged with the month file they belong to."""
    table = read_table(spark, tables_dir, SOURCE_TABLE[source])
    if source == "yellow":
        return yellow_raw(table)
    if source == "green":
        return green_raw(table)
    if source == "fhvhv":
        return fhvhv_raw(table, with_fare=True)
    if source == "fhv":
        return fhvhv_raw(table, with_fare=False)
    raise ValueError(f"unknown source {source!r}")


def delivered_month(df: DataFrame, source: str, month: int) -> DataFrame:
    """Rows of one month file, in the schema the publisher used that month.

    The publisher's schema drifts: counters ship as BIGINT in months 1-2 and
    as DOUBLE from month 3 on, and ``payment_type`` first appears in month 3.
    """
    part = df.filter(F.col("file_month") == month).drop("file_month")
    if month >= 3:
        drifted = {c: F.col(c).cast("double") for c in ("VendorID", "passenger_count")
                   if c in part.columns}
        part = part.withColumns(drifted) if drifted else part
    elif "payment_type" in part.columns:
        part = part.drop("payment_type")
    return part
