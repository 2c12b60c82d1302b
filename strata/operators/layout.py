"""K5: clustered file layout on ``pickup_datetime`` (the plain-parquet form of CLUSTER BY + OPTIMIZE).

Rows are range-partitioned on (pickup, dropoff, vendor) and sorted inside each
partition, so every file covers its own slice of time and parquet min/max
statistics let range filters skip row groups. The trailing keys let the range
partitioner split a pickup instant that holds many rows across files. No
partition count is fixed: AQE coalesces adjacent ranges to the advisory size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.session import shared_root

CLUSTER_KEYS = ("pickup_datetime", "dropoff_datetime", "VendorID")


def clustered(df: DataFrame, keys: tuple[str, ...] = CLUSTER_KEYS,
              leading: tuple[str, ...] = ()) -> DataFrame:
    """Range-partition on ``keys`` and sort each partition by ``leading + keys``.

    ``leading`` holds the Hive partition columns of the write. A partitioned
    write needs its rows ordered by them; when the plan's order does not start
    with them, Spark drops the sort below and sorts by the partition columns
    alone, which loses the key order inside each file. A leading column that is
    a coarse, monotone function of the first key (the pickup month) gives the
    same order as ``keys`` and satisfies the write, so no sort is added.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*leading, *keys)


def write_clustered(df: DataFrame, path: str, keys: tuple[str, ...] = CLUSTER_KEYS,
                    observation: Observation | None = None, metrics: list | None = None,
                    partition_by: tuple[str, ...] = ()) -> None:
    """Write ``df`` clustered; optional metrics are observed *after* the range
    exchange, because the exchange's sampling job runs its input a second time.

    With ``partition_by`` (a coarse function of the first key, such as the
    pickup month) each range partition spans one or two directories, so the
    partitioned write adds no small-file fan-out.
    """
    out = clustered(df, keys, leading=partition_by)
    if observation is not None:
        out = out.observe(observation, *metrics)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def file_ranges(df: DataFrame, key: str = "pickup_datetime") -> DataFrame:
    """Per data file: rows and [min, max] of the clustering key."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"), F.col(key).alias("_k"))
            .groupBy("file_path")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("_k").alias("min_key"),
                 F.max("_k").alias("max_key")))


def overlap_violations(df: DataFrame, key: str = "pickup_datetime") -> DataFrame:
    """Files whose key range starts before an earlier file's range ends.

    Files are ordered by (min, max, path); a file is a violation when its min
    lies strictly below the max of all earlier files. Touching ranges (a
    boundary instant split over two files) are fine. No pairs are emitted and
    no step orders all files:

    * files are bucketed by the day of their min; a window per day gives the
      max of the earlier files of the same day;
    * an earlier day's file can only overlap a later day's file if its range
      reaches past that day's start. Such a file emits one row per later day
      it reaches into, carrying its max; the max per day of those rows is the
      max of all earlier days' files that matter.

    The per-file ranges (one row per file) are checkpointed to the shared
    folder first, so both parts read them instead of scanning the table twice.
    """
    shared_root(df.sparkSession)
    return range_violations(file_ranges(df, key).checkpoint(eager=True))


def range_violations(ranges: DataFrame) -> DataFrame:
    """``overlap_violations`` over per-file rows (file_path, rows, min_key, max_key)."""
    ranges = ranges.filter(F.col("min_key").isNotNull()).withColumn("_day", F.to_date("min_key"))
    in_day = Window.partitionBy("_day").orderBy("min_key", "max_key", "file_path") \
        .rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranges.withColumn("_prev_max", F.max("max_key").over(in_day))
    reach = (ranges.filter(F.to_date("max_key") > F.col("_day"))
             .select(F.explode(F.sequence(F.date_add("_day", 1), F.to_date("max_key"))).alias("_day"),
                     "max_key")
             .groupBy("_day").agg(F.max("max_key").alias("_prior_max")))
    return (ranked.join(reach, "_day", "left")
            .agg(F.count(F.lit(1)).alias("files"),
                 F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                 F.count_if(F.col("min_key") < F.greatest("_prev_max", "_prior_max"))
                 .alias("violations")))
