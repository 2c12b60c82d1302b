"""Exploratory profiles of the typed raw data (bronze) and of the raw file schemas.

A7-A13, T2, T3, T5, F8, F9, Q2-Q6 and U3. The reference prints each figure
from its own job; here every report is a DataFrame built from one scan per
source (wide aggregates unpivoted to rows where it reports per column).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import MONETARY_KEYWORDS, LakeConfig, SourceSpec
from strata.functions.expressions import pct, trip_duration_minutes
from strata.functions.quantiles import percentile_profile
from strata.operators.bronze import LINEAGE_COLUMNS
from strata.session import concurrently
from strata.sources import raw

PARTITION_COLUMNS = ("year", "month")


def data_columns(df: DataFrame) -> list[str]:
    """Columns as delivered by the publisher (lineage and partition columns left out)."""
    return [c for c in df.columns if c not in LINEAGE_COLUMNS + PARTITION_COLUMNS]


# ---- distributions (A7-A9) --------------------------------------------------

def pickup_year_distribution(frames: dict[str, DataFrame], specs: list[SourceSpec]) -> DataFrame:
    """Trips per calendar year of pickup (null year is its own group)."""
    parts = [frames[s.name].select(F.lit(s.name).alias("taxi_type"),
                                   F.year(s.pickup).alias("pickup_year")) for s in specs]
    return (reduce(DataFrame.unionByName, parts)
            .groupBy("taxi_type", "pickup_year").agg(F.count(F.lit(1)).alias("trips"))
            .orderBy("taxi_type", F.col("pickup_year").asc_nulls_first()))


def passenger_distribution(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Trips per passenger count, null included."""
    return (df.groupBy(F.col(spec.passengers).alias("passenger_count"))
            .agg(F.count(F.lit(1)).alias("trips"))
            .orderBy(F.col("passenger_count").asc_nulls_first()))


def vendor_distribution(frames: dict[str, DataFrame], specs: list[SourceSpec]) -> DataFrame:
    """Trips per vendor and source, in one aggregate."""
    parts = [frames[s.name].select(F.lit(s.name).alias("taxi_type"), F.col(s.vendor).alias("VendorID"))
             for s in specs]
    return (reduce(DataFrame.unionByName, parts)
            .groupBy("taxi_type", "VendorID").agg(F.count(F.lit(1)).alias("trips"))
            .orderBy("taxi_type", F.col("VendorID").asc_nulls_first()))


# ---- numeric profiles (A10-A13, F8, F9) ------------------------------------

AMOUNT_PROBS = {"p1": 0.01, "p25": 0.25, "median": 0.5, "p75": 0.75, "p99": 0.99}
DURATION_PROBS = {"p1": 0.01, "median": 0.5, "p99": 0.99}


def _profile(df: DataFrame, value, probs: dict[str, float], with_mean: bool) -> DataFrame:
    summary = {"min": F.min, "max": F.max}
    if with_mean:
        summary["mean"] = lambda c: F.round(F.avg(c), 4)
    columns = ["min", *probs, "max", *(["mean"] if with_mean else [])]
    return percentile_profile(df, value, probs, summary, columns)


def amount_stats(spark: SparkSession, df: DataFrame, spec: SourceSpec) -> DataFrame:
    """A10: min, p1, p25, median, p75, p99, max and mean of the amount (exact percentiles)."""
    return _profile(df, F.col(spec.amount), AMOUNT_PROBS, with_mean=True)


def duration_stats(spark: SparkSession, df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Min, p1, median, p99 and max of the trip duration in minutes (exact percentiles)."""
    return _profile(df, trip_duration_minutes(spec.pickup, spec.dropoff), DURATION_PROBS,
                    with_mean=False)


# Spark's default accuracy of percentile_approx, which the reference's profiles use.
APPROX_ACCURACY = 10_000


def _approx_profile(df: DataFrame, value, probs: dict[str, float], with_mean: bool) -> DataFrame:
    """One pass: min, max, (mean) and one GK sketch read at every p; rank error <= n/accuracy."""
    v = value.alias("_v")
    aggs = [F.min("_v").alias("min"), F.max("_v").alias("max"),
            F.percentile_approx("_v", list(probs.values()), APPROX_ACCURACY).alias("_q")]
    if with_mean:
        aggs.append(F.round(F.avg("_v"), 4).alias("mean"))
    row = df.select(v).agg(*aggs)
    return row.select("min", *[F.col("_q")[i].alias(k) for i, k in enumerate(probs)], "max",
                      *(["mean"] if with_mean else []))


def amount_stats_approx(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """A10 as the reference computes it: approximate percentiles, in one pass."""
    return _approx_profile(df, F.col(spec.amount), AMOUNT_PROBS, with_mean=True)


def duration_stats_approx(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """A11 as the reference computes it: approximate percentiles, in one pass."""
    return _approx_profile(df, trip_duration_minutes(spec.pickup, spec.dropoff), DURATION_PROBS,
                           with_mean=False)


def negative_duration(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """trips whose dropoff lies before their pickup."""
    d = trip_duration_minutes(spec.pickup, spec.dropoff)
    return df.agg(F.count_if(d < 0).alias("negative_duration_trips"),
                  F.count(F.lit(1)).alias("trips"))


def passenger_avg_compare(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Mean passenger count with and without zeros (nulls skipped both times)."""
    p = F.col(spec.passengers)
    return df.agg(F.round(F.avg(p), 4).alias("avg_with_zeros"),
                  F.round(F.avg(F.when(p > 0, p)), 4).alias("avg_without_zeros"))


def passenger_problem_rate(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Trips with a null or zero passenger count, and their share."""
    p = F.col(spec.passengers)
    agg = df.agg(F.count_if(p.isNull() | (p == 0)).alias("problematic"),
                 F.count(F.lit(1)).alias("total"))
    return agg.select("problematic", "total", pct(F.col("problematic"), F.col("total")).alias("pct"))


def amount_anomalies(df: DataFrame, spec: SourceSpec, threshold: float) -> DataFrame:
    """F8: negative, zero and above-threshold amounts, counted in one pass."""
    a = F.col(spec.amount)
    return df.agg(F.count_if(a < 0).alias("negative"), F.count_if(a == 0).alias("zero"),
                  F.count_if(a > threshold).alias("above_threshold"),
                  F.count(F.lit(1)).alias("total"))


def top_outliers(df: DataFrame, spec: SourceSpec, threshold: float, k: int = 10) -> DataFrame:
    """The k largest amounts above the threshold (a distributed top-k)."""
    return (df.filter(F.col(spec.amount) > threshold)
            .select(F.col(spec.amount).alias("total_amount"),
                    F.col(spec.pickup).alias("pickup_datetime"),
                    F.col(spec.dropoff).alias("dropoff_datetime"),
                    F.col(spec.passengers).alias("passenger_count"))
            .orderBy(F.desc("total_amount"), "pickup_datetime", "dropoff_datetime",
                     "passenger_count")
            .limit(k))


def negative_amount_sample(df: DataFrame, spec: SourceSpec, k: int = 10) -> DataFrame:
    """K negative amounts; ordered, so the sample is reproducible."""
    cols = [F.col(spec.amount).alias("total_amount"), F.col(spec.pickup).alias("pickup_datetime")]
    if "payment_type" in df.columns:
        cols.append(F.col("payment_type"))
    out = df.filter(F.col(spec.amount) < 0).select(*cols)
    return out.orderBy(*[F.col(c).asc_nulls_first() for c in out.columns]).limit(k)


# ---- per-column reports (Q2, Q4-Q6, U3) --------------------------------------

def _stack(names: list[str], value_prefix: str) -> str:
    return ", ".join(f"'{c}', `{value_prefix}{c}`" for c in names)


def null_report(frames: dict[str, DataFrame]) -> DataFrame:
    """Q2/T5: nulls per column of every source; only columns with nulls, most first."""
    parts = []
    for name, df in frames.items():
        cols = data_columns(df)
        wide = df.agg(F.count(F.lit(1)).alias("_total"),
                      *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{c}") for c in cols])
        stacked = wide.selectExpr(
            "_total", f"stack({len(cols)}, {_stack(cols, 'n_')}) AS (column_name, nulls)")
        parts.append(stacked.select(F.lit(name).alias("taxi_type"), "column_name", "nulls",
                                    F.col("_total").alias("total"),
                                    pct(F.col("nulls"), F.col("_total")).alias("pct")))
    return (reduce(DataFrame.unionByName, parts).filter(F.col("nulls") > 0)
            .orderBy("taxi_type", F.desc("nulls"), "column_name"))


def schema_groups_of(spark: SparkSession, raw_root: str, cfg: LakeConfig) -> dict[str, list]:
    """Per source its landed months grouped by identical schema; footers of all sources are read side by side."""
    landed = raw.landed_files(spark, raw_root)
    return concurrently({s: (lambda s=s: raw.schema_groups(spark, raw_root, s, cfg.year_months(), landed))
                         for s in cfg.sources})


def _variants(groups: list) -> dict[str, set[str]]:
    """The types a source's columns are delivered with, ``absent`` where a group lacks the column."""
    types = [{f.name: f.dataType.simpleString() for f in schema.fields} for schema, _ in groups]
    return {c: {t.get(c, "absent") for t in types} for c in dict.fromkeys(c for t in types for c in t)}


_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
_TIMES = ("timestamp", "timestamp_ntz", "date")


def _bounds(place: int, data_type: str) -> str:
    """min and max of a column as numbers and as times, each null where it is not of that kind."""
    number, time = data_type in _NUMBERS or data_type.startswith("decimal"), data_type in _TIMES
    return ", ".join(f"CAST({f'`{side}_{place}`' if fits else 'NULL'} AS {kind})"
                     for fits, kind in ((number, "DOUBLE"), (time, "TIMESTAMP_NTZ")) for side in ("lo", "hi"))


BOUND_COLUMNS = ("min_number", "max_number", "min_time", "max_time")


def raw_column_profile(spark: SparkSession, raw_root: str, cfg: LakeConfig, by_source: dict[str, list] | None = None,
                       chosen: dict[str, list[str]] | None = None, bounds: bool = False) -> DataFrame:
    """Per (source, column, type as delivered): months, rows and non-null values.

    Raw months are grouped by identical schema (footer metadata); each group
    is one scan with one wide aggregate, unpivoted; all groups form one job.
    Only the columns ``chosen`` for a source (default: all) are read. With
    ``bounds`` numbers and times also give their min and max. A column missing
    from some months gets a row of type ``absent``. Months are
    listed by number if the lake has one year, as ``YYYY-MM`` if it has more. A
    landed month that cannot be read is an error.
    """
    parts = []
    # the list is put together from numbers that sort by time
    number, listed = ((lambda y, m: m), lambda n: n.cast("string")) if len(set(cfg.years)) == 1 else (
        (lambda y, m: y * 100 + m),
        lambda n: F.format_string("%04d-%02d", F.floor(n / 100).cast("int"), n % 100))
    by_source = by_source or schema_groups_of(spark, raw_root, cfg)
    extra = BOUND_COLUMNS if bounds else ()
    for source in cfg.sources:
        groups = by_source[source]
        names = [c for c in _variants(groups) if chosen is None or c in chosen[source]]
        for schema, months in groups if names else []:
            paths = [raw.raw_path(raw_root, source, y, m) for y, m in months]
            types = {f.name: f.dataType.simpleString() for f in schema.fields}
            aggs = [F.count(F.lit(1)).alias("_rows")]
            for i, c in enumerate(names):
                if c in types:
                    aggs.append(F.count(F.col(f"`{c}`")).alias(f"nn_{i}"))
                    if bounds and (types[c] in _NUMBERS + _TIMES or types[c].startswith("decimal")):
                        aggs += [F.min(F.col(f"`{c}`")).alias(f"lo_{i}"), F.max(F.col(f"`{c}`")).alias(f"hi_{i}")]
            wide = spark.read.schema(schema).parquet(*paths).agg(*aggs)
            month_list = ",".join(str(number(y, m)) for y, m in sorted(months))
            entries = ", ".join(
                f"'{c}', '{types.get(c, 'absent')}', {f'`nn_{i}`' if c in types else 'CAST(0 AS BIGINT)'}"
                + (", " + _bounds(i, types.get(c, "absent")) if bounds else "") for i, c in enumerate(names))
            parts.append(wide.selectExpr(
                "_rows", f"stack({len(names)}, {entries}) AS "
                         f"({', '.join(('column_name', 'data_type', 'non_nulls', *extra))})")
                .select(F.lit(source).alias("taxi_type"), "column_name", "data_type",
                        F.lit(month_list).alias("months"), F.col("_rows").alias("rows"), "non_nulls", *extra))
    if not parts:
        return spark.createDataFrame([], "taxi_type string, column_name string, data_type string, months string, rows long, "
                                         "non_nulls long" + (", min_number double, max_number double, "
                                         "min_time timestamp_ntz, max_time timestamp_ntz" if bounds else ""))
    profile = reduce(DataFrame.unionByName, parts)
    # months of one (source, column, type) from several schema groups merge into one row
    return (profile.groupBy("taxi_type", "column_name", "data_type")
            .agg(F.array_join(F.transform(F.array_sort(F.transform(
                     F.flatten(F.collect_list(F.split("months", ","))), lambda m: m.cast("int"))),
                     listed), ",").alias("months"),
                 F.sum("rows").alias("rows"), F.sum("non_nulls").alias("non_nulls"),
                 *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in extra]))


def column_profile(spark: SparkSession, raw_root: str, cfg: LakeConfig) -> DataFrame:
    """Q4: the schema listing of every source, with row and non-null counts, min and max per type."""
    return raw_column_profile(spark, raw_root, cfg, bounds=True).orderBy("taxi_type", "column_name", "data_type")


def schema_drift(spark: SparkSession, raw_root: str, cfg: LakeConfig) -> DataFrame:
    """Q3: columns whose type differs between months, or that some months lack.

    Footers tell which these are; only they are read.
    """
    by_source = schema_groups_of(spark, raw_root, cfg)
    drifted = {s: [c for c, types in _variants(groups).items() if len(types) > 1] for s, groups in by_source.items()}
    return raw_column_profile(spark, raw_root, cfg, by_source, drifted).orderBy("taxi_type", "column_name", "months")


def key_column_presence(spark: SparkSession, raw_root: str, cfg: LakeConfig,
                        keys: tuple[str, ...] = ("passenger_count", "total_amount")) -> DataFrame:
    """Q5: does each landed source carry the columns the two queries need, and how filled are they.

    Only these columns are read.
    """
    by_source = schema_groups_of(spark, raw_root, cfg)
    prof = raw_column_profile(spark, raw_root, cfg, by_source, {s: list(keys) for s in by_source}) \
        .filter(F.col("data_type") != "absent")
    per_source = prof.groupBy("taxi_type", "column_name").agg(F.sum("non_nulls").alias("non_nulls"))
    wanted = spark.createDataFrame([(s, k) for s, groups in by_source.items() if groups for k in keys],
                                   "taxi_type string, column_name string")
    return (wanted.join(per_source, ["taxi_type", "column_name"], "left")
            .select("taxi_type", "column_name", F.col("non_nulls").isNotNull().alias("present"),
                    F.coalesce("non_nulls", F.lit(0)).alias("non_nulls"))
            .orderBy("taxi_type", "column_name"))


def column_overlap(spark: SparkSession, raw_root: str, cfg: LakeConfig) -> DataFrame:
    """Which sources carry each column; a column of one source only is exclusive."""
    prof = raw_column_profile(spark, raw_root, cfg).filter(F.col("data_type") != "absent")
    return (prof.groupBy("column_name")
            .agg(F.array_join(F.array_sort(F.collect_set("taxi_type")), ",").alias("sources"),
                 F.count_distinct("taxi_type").alias("n_sources"),
                 F.sum("non_nulls").alias("non_nulls"))
            .withColumn("exclusive", F.col("n_sources") == 1)
            .orderBy("column_name"))


def monetary_columns(frames: dict[str, DataFrame],
                     keywords: tuple[str, ...] = MONETARY_KEYWORDS) -> DataFrame:
    """Q6: numeric columns whose lower-cased name holds a money word, with their totals.

    One wide aggregate per source, however many money columns it has.
    """
    schema = ("taxi_type string, column_name string, non_nulls bigint, total double, "
              "mean double, min double, max double")
    parts = []
    for name, df in frames.items():
        cols = [f.name for f in df.schema.fields
                if f.name in data_columns(df) and any(k in f.name.lower() for k in keywords)
                and f.dataType.typeName() in ("double", "float", "decimal", "long", "integer")]
        if not cols:
            continue
        aggs = []
        for i, c in enumerate(cols):
            v = F.col(f"`{c}`").cast("double")
            aggs += [F.count(v).alias(f"c{i}"), F.round(F.sum(v), 2).alias(f"s{i}"),
                     F.round(F.avg(v), 4).alias(f"a{i}"), F.min(v).alias(f"lo{i}"),
                     F.max(v).alias(f"hi{i}")]
        entries = ", ".join(f"'{c}', c{i}, s{i}, a{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
        parts.append(df.agg(*aggs).selectExpr(
            f"'{name}' AS taxi_type",
            f"stack({len(cols)}, {entries}) AS (column_name, non_nulls, total, mean, min, max)"))
    if not parts:
        spark = next(iter(frames.values())).sparkSession
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts).orderBy("taxi_type", "column_name")
