"""Bronze layer: raw months, typed and tagged with lineage, partitioned by year and month.

The raw schema drifts between months, so every month is normalised on its own
scan *before* anything is unioned or written; after that all months share one
recorded type per column. A source is one partitioned table whose months are
replaced by a swap of their folder (``operators/months.py``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import LakeConfig
from strata.operators import months as month_store
from strata.sources import raw

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
LINEAGE_COLUMNS = ("_source_file", "_ingested_at", "_source_system")


class SchemaDriftError(ValueError):
    """Two months of one source disagree on a column type that cannot be widened."""


def normalize_types(df: DataFrame) -> DataFrame:
    """Every integer-family column becomes double, in one projection."""
    return df.select([
        F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, _INTEGRAL) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def bronze_month(scan: DataFrame, year: int, month: int, source_system: str) -> DataFrame:
    """S2 + P2 + P3: one raw month scan with lineage, normalised types and partition values.

    ``scan`` must be the file scan itself: the lineage column comes from its
    hidden ``_metadata`` struct.
    """
    tagged = scan.select(
        "*", raw.logical_source_file(F.col("_metadata.file_path")).alias("_source_file"))
    return normalize_types(tagged).withColumns({
        "_ingested_at": F.current_timestamp(),
        "_source_system": F.lit(source_system),
        "year": F.lit(year),
        "month": F.lit(month),
    })


@dataclass(frozen=True)
class IngestResult:
    source: str
    year: int
    month: int
    rows: int


def _recorded_types(spark: SparkSession, bronze_root: str, source: str) -> dict[str, tuple[T.DataType, str]]:
    """Recorded column types, and where they are from; empty before the first load."""
    columns = month_store.recorded_columns(spark, bronze_root, source)
    return {f.name: (f.dataType, "bronze") for f in columns.fields} if columns else {}


def _conformed(month: DataFrame, recorded: dict[str, tuple[T.DataType, str]], source: str, label: str) -> DataFrame:
    """The month with every numeric column in its recorded type; any other difference is an error.

    Columns not seen before are added to ``recorded``.
    """
    columns = []
    for f in month.schema.fields:
        kind, where = recorded.setdefault(f.name, (f.dataType, label))
        column = F.col(f"`{f.name}`")
        if kind != f.dataType:
            if not (isinstance(kind, _NUMERIC) and isinstance(f.dataType, _NUMERIC)):
                raise SchemaDriftError(f"{source}: column {f.name!r} is {kind.simpleString()} in {where} "
                                       f"but {f.dataType.simpleString()} in {label}")
            column = column.cast(kind).alias(f.name)
        columns.append(column)
    return month.select(columns)


def _write(month: DataFrame, bronze_root: str, source: str, year: int, number: int) -> IngestResult:
    """Write one month to a fresh folder and mark it complete; nobody reads it yet."""
    folder = month_store.month_folder(bronze_root, source, year, number, month_store.new_version())
    obs = Observation(f"bronze_{source}_{year}_{number}")
    month.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    month_store.mark_complete(month.sparkSession, folder)
    return IngestResult(source, year, number, int(obs.get.get("rows", 0)))


# Months of one source that are written side by side.
CONCURRENT_MONTHS = 8


def _replace(spark: SparkSession, bronze_root: str, source: str, scans: list[tuple[int, int, DataFrame]],
             cfg: LakeConfig) -> list[IngestResult]:
    """Replace the months of ``scans``: compare all, extend the recorded columns, write all, then swap."""
    recorded = _recorded_types(spark, bronze_root, source)
    before = len(recorded)
    frames = []
    for year, month, scan in scans:
        frame = bronze_month(scan, year, month, cfg.source_system).drop("year", "month")
        frames.append((year, month, _conformed(frame, recorded, source, f"{year}-{month:02d}")))
    if len(recorded) > before:
        month_store.record_columns(spark, bronze_root, source, T.StructType(
            [T.StructField(name, kind) for name, (kind, _) in recorded.items()]))
    with ThreadPoolExecutor(max_workers=CONCURRENT_MONTHS) as pool:
        done = list(pool.map(lambda x: _write(x[2], bronze_root, source, x[0], x[1]), frames))
    month_store.synchronise(spark, bronze_root, source)
    for year, month, _ in scans:
        month_store.drop_superseded(spark, bronze_root, source, year, month)
    return done


def ingest_months(spark: SparkSession, raw_root: str, bronze_root: str, source: str,
                  months: list[tuple[int, int]], cfg: LakeConfig,
                  landed: dict[str, set[str]] | None = None) -> list[IngestResult]:
    """Replace each landed month asked for; every other month of bronze stays as it is.

    All months are read and compared with the recorded types before the first
    one is written, so an unreadable landed file or a clash of types raises
    with bronze untouched. Each month is then a K1 replace: narrow, and its
    plan is the same however many months there are.
    """
    return _replace(spark, bronze_root, source, raw.month_scans(spark, raw_root, source, months, landed), cfg)


def ingest_month(spark: SparkSession, raw_root: str, bronze_root: str, source: str,
                 year: int, month: int, cfg: LakeConfig) -> IngestResult:
    """K1: replace exactly one month partition, idempotently and at once.

    The month's rows go to a fresh folder; the table's partition moves to it
    when it is complete. Other months are untouched, an empty month file
    empties its partition, and a write that fails leaves the old month whole.
    The row count is observed during the write, so there is no read-back scan.
    A month without a raw file, or one that clashes with the recorded types,
    is an error.
    """
    scan = raw.read_raw(spark, raw_root, source, year, month)
    return _replace(spark, bronze_root, source, [(year, month, scan)], cfg)[0]


def ingest_source(spark: SparkSession, raw_root: str, bronze_root: str, source: str,
                  cfg: LakeConfig, landed: dict[str, set[str]] | None = None) -> dict[tuple[int, int], int]:
    """Every configured month of a source; rows per landed (year, month)."""
    done = ingest_months(spark, raw_root, bronze_root, source, cfg.year_months(), cfg, landed)
    return {(r.year, r.month): r.rows for r in done}


def read_bronze(spark: SparkSession, bronze_root: str, source: str) -> DataFrame:
    """The whole bronze table of a source, found by its path; new columns are null in old months.

    Types come from the recorded columns: no footer is opened and no job runs.
    """
    name = month_store.synchronise(spark, bronze_root, source)
    if name is None:
        raise FileNotFoundError(f"nothing of {source} was ever written to {bronze_root}")
    return spark.table(name)


def partition_count(bronze: DataFrame, source: str, year: int, month: int) -> DataFrame:
    """Rows of one partition, 0 if it is empty; the predicate becomes a partition filter.

    ``bronze`` is the dataset with its known schema, so no footer is read to infer one.
    """
    return (bronze.filter((F.col("year") == year) & (F.col("month") == month))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(source).alias("taxi_type"), F.lit(year).alias("year"), F.lit(month).alias("month"), "rows"))
