"""Every report and operator as a ``(spark, tables_dir) -> DataFrame`` callable.

Each callable opens (building on first use) the lake of ``tables_dir`` and
reads its layers, so the work of every entry grows with the input tables.
Entries that mutate storage (month replace, idempotency) work in a fresh
scratch lake below the shared root and never touch the main one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import YELLOW, LakeConfig
from strata.lake import Lake, open_lake
from strata.operators import bronze, layout, silver
from strata.plans import analytics, profile, quality
from strata.session import concurrently, scratch_dir
from strata.sources import raw
from strata.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
CFG = LakeConfig()
REPLACED_MONTH = 3


def _lake(spark: SparkSession, tables_dir: str) -> Lake:
    return open_lake(spark, tables_dir, CFG)


def _bronze_frames(lake: Lake, sources=None) -> dict[str, DataFrame]:
    return {s: lake.bronze(s) for s in (sources or lake.cfg.sources)}


def _trip_bronze(lake: Lake) -> dict[str, DataFrame]:
    return {s.name: lake.bronze(s.name) for s in lake.cfg.trip_sources}


def _table_view(df: DataFrame) -> DataFrame:
    """Layer rows without audit timestamps, lineage reduced to the file name."""
    return df.select(*[c for c in df.columns if c not in ("_silver_processed_at", "_computed_at",
                                                           "_bronze_source_file", "pickup_month")],
                     raw.file_name(F.col("_bronze_source_file")).alias("source_file"))


# ---- queries over gold -------------------------------------------------------

def q1(spark, d):
    return analytics.avg_total_amount_by_month(_lake(spark, d).gold(), CFG)


def q1_sql(spark, d):
    """Query 1 as SQL text, over the gold table read by name."""
    return analytics.query1_sql(spark, _lake(spark, d).by_name("gold"), CFG)


def q2(spark, d):
    return analytics.avg_passengers_by_hour(_lake(spark, d).gold(), CFG)


def q2_sql(spark, d):
    """Query 2 as SQL text, over the gold table read by name."""
    return analytics.query2_sql(spark, _lake(spark, d).by_name("gold"), CFG)


def q1_labelled(spark, d):
    return analytics.query1_labelled(_lake(spark, d).gold(), CFG)


def compare_by_type_month(spark, d):
    return analytics.compare_by_type_month(_lake(spark, d).gold(), CFG)


def type_summary(spark, d):
    return analytics.type_summary(_lake(spark, d).gold(), CFG)


def hourly_revenue(spark, d):
    return analytics.hourly_revenue(_lake(spark, d).gold(), CFG)


def peak_hours(spark, d):
    return analytics.peak_hours(_lake(spark, d).gold(), CFG)


def gold_counts_by_type(spark, d):
    return analytics.counts_by_type(_lake(spark, d).gold())


def quality_report(spark, d):
    return quality.quality_report(_lake(spark, d).gold(), "gold", CFG.warn_pct)


def silver_quality_report(spark, d):
    lake = _lake(spark, d)
    return reduce(DataFrame.unionByName,
                  [quality.quality_report(lake.silver(s.name), f"silver_{s.name}", CFG.warn_pct)
                   for s in CFG.trip_sources])


def bronze_cast_report(spark, d):
    """Counters that the silver projection cannot cast, per trip source."""
    lake = _lake(spark, d)
    return reduce(DataFrame.unionByName, [quality.cast_report(lake.bronze(s.name), s, CFG.warn_pct) for s in CFG.trip_sources])


def audit_trail(spark, d):
    lake = _lake(spark, d)
    return quality.audit_trail(_trip_bronze(lake), {s.name: lake.silver(s.name) for s in CFG.trip_sources},
                               lake.gold(), CFG)


def layer_counts(spark, d):
    lake = _lake(spark, d)
    layers = {f"bronze_{s}": lake.bronze(s) for s in CFG.sources}
    layers.update({f"silver_{s.name}": lake.silver(s.name) for s in CFG.trip_sources})
    layers["gold"] = lake.gold()
    return quality.layer_counts(layers)


# ---- layer contents ----------------------------------------------------------

def silver_yellow(spark, d):
    return _table_view(_lake(spark, d).silver("yellow"))


def silver_green(spark, d):
    return _table_view(_lake(spark, d).silver("green"))


def gold_trips(spark, d):
    return _table_view(_lake(spark, d).gold())


def silver_project(spark, d):
    lake = _lake(spark, d)
    parts = [silver.project_canonical(lake.bronze(s.name), s) for s in CFG.trip_sources]
    return _table_view(reduce(DataFrame.unionByName, parts))


def filter_valid_records(spark, d):
    lake = _lake(spark, d)
    parts = []
    for s in CFG.trip_sources:
        projected = silver.project_canonical(lake.bronze(s.name), s)
        parts.append(projected.select("taxi_type", F.lit(True).alias("all_rows"))
                     .unionByName(silver.filter_valid_records(projected)
                                  .select("taxi_type", F.lit(False).alias("all_rows"))))
    return (reduce(DataFrame.unionByName, parts).groupBy("taxi_type")
            .agg(F.count_if("all_rows").alias("rows_in"),
                 F.count_if(~F.col("all_rows")).alias("rows_valid"))
            .orderBy("taxi_type"))


def _valid_trips(lake: Lake) -> list[DataFrame]:
    return [silver.filter_valid_records(silver.project_canonical(lake.bronze(s.name), s)) for s in CFG.trip_sources]


def deduplicate(spark, d):
    """W1 over both trip sources: the rows it keeps."""
    return _table_view(reduce(DataFrame.unionByName, map(silver.deduplicate_trips, _valid_trips(_lake(spark, d)))))


def dropped_duplicates(spark, d):
    """The rows W1 removes."""
    return _table_view(reduce(DataFrame.unionByName, map(silver.dropped_duplicates, _valid_trips(_lake(spark, d)))))


# ---- raw and bronze storage ---------------------------------------------------

def raw_scan(spark, d):
    """S1 on every landed month of every source, each scanned by its path with its own inferred schema.

    The months disagree (counters BIGINT in months 1-2 and DOUBLE after,
    ``payment_type`` only from month 3), and so do the sources; the union by
    name widens the counters to DOUBLE and leaves a column null where it is
    absent. A landed month that cannot be read is an error.
    """
    lake = _lake(spark, d)
    landed = raw.landed_files(spark, lake.raw_root)
    scans = [scan.withColumns({"taxi_type": F.lit(s), "year": F.lit(y), "month": F.lit(m)})
             for s in lake.cfg.sources for y, m, scan in raw.month_scans(spark, lake.raw_root, s, lake.cfg.year_months(), landed)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def volume_by_month(spark, d):
    lake = _lake(spark, d)
    # one month past the landed ones is asked for and skipped as unreadable
    wanted = CFG.year_months() + [(CFG.years[-1], CFG.months[-1] + 1)]
    return raw.volume_by_month(spark, lake.raw_root, CFG, wanted).orderBy("taxi_type", "year", "month")


def bronze_lineage(spark, d):
    lake = _lake(spark, d)
    parts = [lake.bronze(s).groupBy(F.lit(s).alias("taxi_type"), "_source_file", "_source_system", "year", "month")
             .agg(F.count(F.lit(1)).alias("rows")) for s in CFG.sources]
    return (reduce(DataFrame.unionByName, parts)
            .select("taxi_type", raw.file_name(F.col("_source_file")).alias("source_file"),
                    "_source_system", "year", "month", "rows")
            .orderBy("taxi_type", "year", "month"))


def bronze_counts(spark, d):
    lake = _lake(spark, d)
    parts = [lake.bronze(s).groupBy(F.lit(s).alias("taxi_type"), "year", "month")
             .agg(F.count(F.lit(1)).alias("rows")) for s in CFG.sources]
    return reduce(DataFrame.unionByName, parts).orderBy("taxi_type", "year", "month")


def bronze_partition_count(spark, d):
    """S5/F10 for every source and month: each count reads only its own partition directory."""
    lake = _lake(spark, d)
    return reduce(DataFrame.unionByName,
                  [bronze.partition_count(lake.bronze(s), s, y, m)
                   for s in CFG.sources for y, m in CFG.year_months()]).orderBy("taxi_type", "year", "month")


def normalize_types(spark, d):
    lake = _lake(spark, d)
    parts = []
    for s in CFG.sources:
        b = lake.bronze(s)
        cols = profile.data_columns(b)
        types = {f.name: f.dataType.simpleString() for f in b.schema.fields}
        entries = ", ".join(f"'{c}', '{types[c]}', `nn_{c}`" for c in cols)
        parts.append(b.agg(*[F.count(F.col(f"`{c}`")).alias(f"nn_{c}") for c in cols])
                     .selectExpr(f"'{s}' AS taxi_type",
                                 f"stack({len(cols)}, {entries}) AS (column_name, data_type, non_nulls)"))
    return reduce(DataFrame.unionByName, parts).orderBy("taxi_type", "column_name")


def _month_rows(lake: Lake, *more) -> DataFrame:
    """Rows of each month of every bronze source, by its table."""
    parts = [lake.bronze(s).groupBy(F.lit(s).alias("taxi_type"), "year", "month")
             .agg(F.count(F.lit(1)).alias("rows"), *[m(lake.bronze(s)) for m in more]) for s in lake.cfg.sources]
    return reduce(DataFrame.unionByName, parts).orderBy("taxi_type", "year", "month")


def bronze_schema_evolution(spark, d):
    """K3 on every source: rows of each month, and values of the column that appears in month 3 (sources without it: 0)."""
    column = "payment_type"
    return _month_rows(_lake(spark, d), lambda b: (
        F.count(column) if column in b.columns else F.lit(0).cast("long")).alias("payment_type_values"))


def bronze_replace_month(spark, d):
    """K1 in a scratch lake, on every source: a corrected month file arrives and replaces its partition.

    The corrected file drops the month's rows without a pickup time; it is
    ingested twice to show the replace is idempotent; the other months keep
    the first load.
    """
    main = _lake(spark, d)
    work = Lake(spark, d, scratch_dir(spark, "replace-month"), CFG)
    year = CFG.years[0]
    landed = raw.landed_files(spark, main.raw_root)

    def replaced(source: str) -> None:
        bronze.ingest_source(spark, main.raw_root, work.bronze_root, source, CFG, landed)
        delivered = raw.read_raw(spark, main.raw_root, source, year, REPLACED_MONTH)
        corrected = delivered.filter(F.col(CFG.spec(source).pickup).isNotNull())
        corrected.write.mode("overwrite").parquet(raw.raw_path(work.raw_root, source, year, REPLACED_MONTH))
        for _ in range(2):
            bronze.ingest_month(spark, work.raw_root, work.bronze_root, source, year, REPLACED_MONTH, CFG)

    concurrently({s: (lambda s=s: replaced(s)) for s in CFG.sources})
    return _month_rows(work)


def bronze_incremental(spark, d):
    """Streaming ingest in a scratch lake, on every source: months 1-3 land and are ingested, then 4-5.

    The second run of a source's stream only picks up the new files; the result
    must equal the first load of the main lake.
    """
    main = _lake(spark, d)
    work = Lake(spark, d, scratch_dir(spark, "incremental"), CFG)

    def arrive(source: str) -> None:
        for months in (CFG.months[:3], CFG.months[3:]):
            for m in months:
                raw.read_raw(spark, main.raw_root, source, CFG.years[0], m).write.mode("overwrite").parquet(
                    raw.raw_path(work.raw_root, source, CFG.years[0], m))
            incremental.ingest_arrivals(spark, work.raw_root, work.bronze_root, source,
                                        f"{work.root}/_stream_checkpoint/{source}", CFG)

    concurrently({s: (lambda s=s: arrive(s)) for s in CFG.sources})
    return _month_rows(work)


def bronze_reingest_months(spark, d):
    """K10 as a loop of K1, in a scratch lake: a full load, then two months again; the others stay."""
    main = _lake(spark, d)
    work = Lake(spark, d, scratch_dir(spark, "reingest"), CFG)
    landed = raw.landed_files(spark, main.raw_root)
    again = CFG.year_months()[1:3]

    def load(source: str) -> None:
        bronze.ingest_source(spark, main.raw_root, work.bronze_root, source, CFG, landed)
        bronze.ingest_months(spark, main.raw_root, work.bronze_root, source, again, CFG, landed)

    concurrently({s: (lambda s=s: load(s)) for s in CFG.sources})
    work.forget_schemas()
    parts = [work.bronze(s).groupBy(F.lit(s).alias("taxi_type"), "year", "month").agg(F.count(F.lit(1)).alias("rows"))
             for s in CFG.sources]
    return reduce(DataFrame.unionByName, parts).orderBy("taxi_type", "year", "month")


def clustered_layout(spark, d):
    lake = _lake(spark, d)
    layers = {f"silver_{s.name}": lake.silver(s.name) for s in CFG.trip_sources}
    layers["gold"] = lake.gold()
    # each check checkpoints its per-file ranges first; the layers' jobs run side by side
    checks = concurrently({name: (lambda df=df: layout.overlap_violations(df))
                           for name, df in layers.items()})
    parts = [checks[name].select(F.lit(name).alias("layer"), "rows", "violations") for name in layers]
    return reduce(DataFrame.unionByName, parts).orderBy("layer")


def _layer_months(lake: Lake) -> DataFrame:
    """The fingerprint of every month of every layer."""
    parts = []
    for s in CFG.sources:
        df = lake.bronze(s)
        parts.append(quality.month_fingerprints(df, f"bronze_{s}", F.col("year") * 100 + F.col("month"),
                                                tuple(c for c in df.columns if c != "_ingested_at")))
    layers = {f"silver_{s.name}": lake.silver(s.name) for s in CFG.trip_sources} | {"gold": lake.gold()}
    pickup = F.year("pickup_datetime") * 100 + F.month("pickup_datetime")
    parts += [quality.month_fingerprints(df, name, pickup) for name, df in layers.items()]
    return reduce(DataFrame.unionByName, parts)


def idempotency(spark, d):
    """Q8: a second run from the same landed files, in a scratch lake, gives the main lake's months; nothing may change.

    In the scratch lake one month of every source is also ingested again, on top of the first.
    """
    main = _lake(spark, d)
    work = Lake(spark, None, scratch_dir(spark, "idempotency"), CFG, landed_at=main.raw_root)
    work.build()
    landed = raw.landed_files(spark, main.raw_root)
    concurrently({s: (lambda s=s: bronze.ingest_months(spark, main.raw_root, work.bronze_root, s, [(CFG.years[0], REPLACED_MONTH)],
                                                       CFG, landed)) for s in CFG.sources})
    work.forget_schemas()
    return quality.compare_months(_layer_months(main), _layer_months(work))


# ---- profiles of the typed raw data ------------------------------------------

def pickup_year_distribution(spark, d):
    lake = _lake(spark, d)
    return profile.pickup_year_distribution(_trip_bronze(lake), list(CFG.trip_sources))


def passenger_distribution(spark, d):
    return profile.passenger_distribution(_lake(spark, d).bronze("yellow"), YELLOW)


def vendor_distribution(spark, d):
    lake = _lake(spark, d)
    return profile.vendor_distribution(_trip_bronze(lake), list(CFG.trip_sources))


def amount_stats(spark, d):
    return profile.amount_stats(spark, _lake(spark, d).bronze("yellow"), YELLOW)


def duration_stats(spark, d):
    return profile.duration_stats(spark, _lake(spark, d).bronze("yellow"), YELLOW)


def amount_stats_approx(spark, d):
    return profile.amount_stats_approx(_lake(spark, d).bronze("yellow"), YELLOW)


def duration_stats_approx(spark, d):
    return profile.duration_stats_approx(_lake(spark, d).bronze("yellow"), YELLOW)


def negative_duration(spark, d):
    return profile.negative_duration(_lake(spark, d).bronze("yellow"), YELLOW)


def passenger_avg_compare(spark, d):
    return profile.passenger_avg_compare(_lake(spark, d).bronze("yellow"), YELLOW)


def passenger_problem_rate(spark, d):
    return profile.passenger_problem_rate(_lake(spark, d).bronze("yellow"), YELLOW)


def amount_anomalies(spark, d):
    return profile.amount_anomalies(_lake(spark, d).bronze("yellow"), YELLOW, CFG.outlier_threshold)


def top_outliers(spark, d):
    return profile.top_outliers(_lake(spark, d).bronze("yellow"), YELLOW, CFG.outlier_threshold)


def negative_amount_sample(spark, d):
    return profile.negative_amount_sample(_lake(spark, d).bronze("yellow"), YELLOW)


def null_report(spark, d):
    return profile.null_report(_bronze_frames(_lake(spark, d)))


def column_profile(spark, d):
    return profile.column_profile(spark, _lake(spark, d).raw_root, CFG)


def schema_drift(spark, d):
    return profile.schema_drift(spark, _lake(spark, d).raw_root, CFG)


def key_column_presence(spark, d):
    return profile.key_column_presence(spark, _lake(spark, d).raw_root, CFG)


def column_overlap(spark, d):
    return profile.column_overlap(spark, _lake(spark, d).raw_root, CFG)


def monetary_columns(spark, d):
    return profile.monetary_columns(_bronze_frames(_lake(spark, d)))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    q1, q1_sql, q2, q2_sql, q1_labelled, compare_by_type_month, type_summary, hourly_revenue,
    peak_hours, gold_counts_by_type, quality_report, silver_quality_report, bronze_cast_report, audit_trail,
    layer_counts, silver_yellow, silver_green, gold_trips, silver_project, filter_valid_records,
    deduplicate, dropped_duplicates, raw_scan, volume_by_month, bronze_lineage, bronze_counts, bronze_partition_count,
    normalize_types, bronze_schema_evolution, bronze_replace_month, bronze_reingest_months, bronze_incremental, clustered_layout, idempotency,
    pickup_year_distribution, passenger_distribution, vendor_distribution,
    amount_stats, duration_stats, amount_stats_approx, duration_stats_approx, negative_duration, passenger_avg_compare, passenger_problem_rate,
    amount_anomalies, top_outliers, negative_amount_sample, null_report, column_profile,
    schema_drift, key_column_presence, column_overlap, monetary_columns)}
