"""Incremental bronze ingestion with Structured Streaming.

New raw month files are noticed by a file stream over the raw folder of a
source. The ``binaryFile`` source yields one row per new file, and its content
is never read because only ``path`` is selected. ``foreachBatch`` reduces the
paths of a micro-batch to the (year, month) files they belong to and runs the
batch month replace (K1) for each.

* Exactly-once: the stream checkpoint records which files were seen, and the
  month replace is an idempotent overwrite. A replayed batch, or a month whose
  part files arrive over two batches, ends in the same bronze partition.
* ``availableNow`` processes everything that has landed and stops, so the
  same code serves a scheduled job and a continuous one
  (``processingTime``).
* Per batch only the distinct month files reach the driver: a handful of
  rows, never data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import LakeConfig
from strata.operators import bronze
from strata.sources import raw

_MONTH_STAMP = r"_tripdata_([0-9]{4})-([0-9]{2})\.parquet$"
# Fixed value: the schema of Spark's binaryFile source.
_BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, raw_root: str, source: str,
             max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of newly landed raw files of one source (paths only)."""
    reader = (spark.readStream.format("binaryFile").schema(_BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(f"{raw_root}/{source}").select("path")


def touched_months(batch: DataFrame) -> DataFrame:
    """Distinct (year, month) of the raw month files a batch of paths belongs to."""
    logical = raw.logical_source_file(F.col("path"))
    return (batch.select(logical.alias("_f")).distinct()
            .select(F.regexp_extract("_f", _MONTH_STAMP, 1).cast("int").alias("year"),
                    F.regexp_extract("_f", _MONTH_STAMP, 2).cast("int").alias("month"))
            .filter(F.col("year").isNotNull() & (F.col("year") > 0))
            .distinct())


def ingest_arrivals(spark: SparkSession, raw_root: str, bronze_root: str, source: str,
                    checkpoint: str, cfg: LakeConfig | None = None,
                    trigger: dict | None = None,
                    max_files_per_trigger: int | None = None) -> list[bronze.IngestResult]:
    """Run the ingestion stream until everything landed so far is in bronze.

    Returns the month replaces it ran, in order. With ``max_files_per_trigger``
    a month's part files may be spread over several micro-batches; each one
    replaces the month from all of its files present, so the last one leaves
    the month complete.
    """
    cfg = cfg or LakeConfig()
    done: list[bronze.IngestResult] = []

    def on_batch(batch: DataFrame, _epoch: int) -> None:
        months = [(r["year"], r["month"]) for r in touched_months(batch).orderBy("year", "month").collect()]
        # the months of a catch-up batch are independent replaces, a bounded number of them side by side
        done.extend(bronze.ingest_months(spark, raw_root, bronze_root, source, months, cfg))

    query = (arrivals(spark, raw_root, source, max_files_per_trigger).writeStream
             .foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"availableNow": True}))
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return done
