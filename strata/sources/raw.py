"""Raw landing zone: one parquet file (or Spark file directory) per source and month."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import RAW_FILE_TEMPLATE, LakeConfig
from strata.session import concurrently
from strata.sources import fixtures

log = logging.getLogger(__name__)

# Fixed value: the suffix of a raw file, or of a raw file directory holding part files.
_PARQUET_DIR = ".parquet/"


def raw_path(raw_root: str, source: str, year: int, month: int) -> str:
    return f"{raw_root}/{source}/" + RAW_FILE_TEMPLATE.format(source=source, year=year, month=month)


def logical_source_file(path: Column) -> Column:
    """The raw file a row came from.

    A publisher file is a single parquet file; a landed fixture month is a
    directory of part files. Both map to the ``..._tripdata_YYYY-MM.parquet``
    path so lineage, and the dedup order built on it, do not depend on how
    many part files a month has. This runs on every ingested row: one search of
    bytes, no regex and no count of characters.
    """
    before = F.substring_index(path, _PARQUET_DIR, 1)
    return F.when(F.octet_length(before) < F.octet_length(path),
                  F.concat(before, F.lit(".parquet"))).otherwise(path)


def file_name(path: Column) -> Column:
    """Last path segment, for reports that must not depend on the lake location."""
    return F.substring_index(path, "/", -1)


def land_raw(spark: SparkSession, tables_dir: str, raw_root: str, cfg: LakeConfig,
             sources: tuple[str, ...] | None = None) -> None:
    """Write the fixture as monthly raw files, each month in its delivered schema.

    One write per month file is inherent to the landing format (the schema
    differs by month); each write is a parallel, narrow job, and the jobs are
    submitted concurrently so small months do not leave the cluster idle.
    Each write scans the table and filters its month before it derives any
    column. Nothing is persisted: the concurrent months of a source would wait
    for one another's blocks, or derive and store them once for each executor,
    and all its rows would stay in memory meanwhile.
    """
    jobs = []
    for source in sources or cfg.sources:
        trips = fixtures.raw_trips(spark, tables_dir, source)
        for year, month in cfg.year_months():
            jobs.append((fixtures.delivered_month(trips, source, month),
                         raw_path(raw_root, source, year, month)))
    with ThreadPoolExecutor(max_workers=min(8, len(jobs) or 1)) as pool:
        for f in [pool.submit(lambda j: j[0].write.mode("overwrite").parquet(j[1]), j)
                  for j in jobs]:
            f.result()


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """Scan one raw file; ``None`` (with a warning) when it is missing or unreadable.

    A missing path fails analysis; a corrupt footer fails the schema-inference
    job with a plain Spark error, so any failure of the read counts.
    """
    try:
        return spark.read.parquet(path)
    except Exception as exc:  # noqa: BLE001 - every unreadable month is skipped, as in S3
        log.warning("skipping unreadable raw file %s: %s", path, str(exc).strip().splitlines()[0])
        return None


def read_raw(spark: SparkSession, raw_root: str, source: str, year: int, month: int) -> DataFrame:
    """Scan one (source, year, month) file with its inferred schema."""
    return spark.read.parquet(raw_path(raw_root, source, year, month))


def landed_files(spark: SparkSession, raw_root: str) -> dict[str, set[str]]:
    """Names of the raw month files that exist, per source folder.

    A listing, not a data read: the ``binaryFile`` source yields one row per
    file and never opens a file when only its path is selected. Part files of
    a month directory map to the month file, so only one name per (source,
    month) reaches the driver, however many files the months have.
    """
    try:
        listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                   .option("pathGlobFilter", "*.parquet").load(raw_root))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":  # nothing was ever landed; any other failure is one
            return {}
        raise
    month_file = logical_source_file(F.col("path"))
    names = listing.select(
        F.element_at(F.split(month_file, "/"), -2).alias("source"),
        file_name(month_file).alias("name")).distinct()
    landed: dict[str, set[str]] = {}
    for row in names.collect():
        landed.setdefault(row["source"], set()).add(row["name"])
    return landed


def landed_months(spark: SparkSession, raw_root: str, source: str, year_months: list[tuple[int, int]],
                  landed: dict[str, set[str]] | None = None) -> list[tuple[int, int]]:
    """The months asked for that have a raw file; the others are named in a warning.

    ``landed`` is a listing from ``landed_files``; it is taken when not given.
    """
    names = (landed if landed is not None else landed_files(spark, raw_root)).get(source, set())
    present = []
    for y, m in year_months:
        if RAW_FILE_TEMPLATE.format(source=source, year=y, month=m) in names:
            present.append((y, m))
        else:
            log.warning("skipping missing raw file %s", raw_path(raw_root, source, y, m))
    return present


def _scans(read, present: list[tuple[int, int]]) -> list:
    """``read`` of each month; footers are read concurrently."""
    with ThreadPoolExecutor(max_workers=min(8, len(present) or 1)) as pool:
        return list(pool.map(read, present))


def month_scans(spark: SparkSession, raw_root: str, source: str, year_months: list[tuple[int, int]],
                landed: dict[str, set[str]] | None = None) -> list[tuple[int, int, DataFrame]]:
    """Scans of the landed months: a landed file that cannot be read is an error."""
    present = landed_months(spark, raw_root, source, year_months, landed)
    scans = _scans(lambda ym: read_raw(spark, raw_root, source, *ym), present)
    return [(y, m, df) for (y, m), df in zip(present, scans, strict=True)]


def readable_months(spark: SparkSession, raw_root: str, source: str,
                    year_months: list[tuple[int, int]],
                    landed: dict[str, set[str]] | None = None) -> list[tuple[int, int, DataFrame]]:
    """Scans of the months that exist and can be read, for ``volume_by_month`` (S3) alone.

    A missing or unreadable file is skipped with a warning. All others use
    ``month_scans``, which never skips a landed file.
    """
    present = landed_months(spark, raw_root, source, year_months, landed)
    scans = _scans(lambda ym: try_read(spark, raw_path(raw_root, source, *ym)), present)
    return [(y, m, df) for (y, m), df in zip(present, scans, strict=True) if df is not None]


def schema_groups(spark: SparkSession, raw_root: str, source: str,
                  year_months: list[tuple[int, int]],
                  landed: dict[str, set[str]] | None = None, scans=month_scans
                  ) -> list[tuple[T.StructType, list[tuple[int, int]]]]:
    """The months of ``scans`` grouped by identical file schema (footer metadata only)."""
    groups: dict[str, tuple[T.StructType, list[tuple[int, int]]]] = {}
    for year, month, df in scans(spark, raw_root, source, year_months, landed):
        groups.setdefault(df.schema.json(), (df.schema, []))[1].append((year, month))
    return list(groups.values())


def volume_by_month(spark: SparkSession, raw_root: str, cfg: LakeConfig,
                    year_months: list[tuple[int, int]] | None = None) -> DataFrame:
    """S3: rows per (source, year, month) over every readable raw file.

    Missing months are skipped with a warning. Months that share a schema
    are read together, so the job is one union of a few scans, counted by
    a two-phase aggregate on the file path.
    """
    wanted = year_months or cfg.year_months()
    landed = landed_files(spark, raw_root)
    by_source = concurrently({s: (lambda s=s: schema_groups(spark, raw_root, s, wanted, landed, readable_months))
                              for s in cfg.sources})
    parts, months_read = [], []
    for source in cfg.sources:
        for file_schema, months in by_source[source]:
            months_read += [(source, y, m) for y, m in months]
            paths = [raw_path(raw_root, source, y, m) for y, m in months]
            # the group's schema is known from its footers; no second inference
            parts.append(spark.read.schema(file_schema).parquet(*paths).select(
                F.lit(source).alias("taxi_type"), F.col("_metadata.file_path").alias("_path")))
    schema = "taxi_type string, year int, month int, trips bigint"
    if not parts:
        return spark.createDataFrame([], schema)
    stamp = r"_tripdata_([0-9]{4})-([0-9]{2})\.parquet$"
    # count per physical file first (map-side combined), name the few groups after
    per_file = (reduce(DataFrame.unionByName, parts)
                .groupBy("taxi_type", "_path").agg(F.count(F.lit(1)).alias("trips"))
                .withColumn("_file", file_name(logical_source_file(F.col("_path")))))
    counted = (per_file.groupBy("taxi_type",
                                F.regexp_extract("_file", stamp, 1).cast("int").alias("year"),
                                F.regexp_extract("_file", stamp, 2).cast("int").alias("month"))
               .agg(F.sum("trips").alias("trips")))
    # a readable month without rows counts 0; one row for each month and source
    every = spark.createDataFrame(months_read, "taxi_type string, year int, month int")
    return (every.join(counted, ["taxi_type", "year", "month"], "left")
            .select("taxi_type", "year", "month", F.coalesce("trips", F.lit(0).cast("bigint")).alias("trips")))
