"""Layer quality report (Q1), audit trail (Q7), layer counts (A14), idempotency (Q8).

The reference runs a count job per check (7 jobs per report, 7 per audit);
here each report is one aggregate over one scan per layer, unpivoted to rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import CANONICAL_COLUMNS, QUALITY_CHECKS, LakeConfig, SourceSpec
from strata.functions.expressions import content_hash, pct

_CHECK_CONDITIONS = {
    "null_pickup_datetime": lambda: F.col("pickup_datetime").isNull(),
    "null_dropoff_datetime": lambda: F.col("dropoff_datetime").isNull(),
    "null_total_amount": lambda: F.col("total_amount").isNull(),
    "negative_total_amount": lambda: F.col("total_amount") < 0,
    "null_passenger_count": lambda: F.col("passenger_count").isNull(),
    "zero_passenger_count": lambda: F.col("passenger_count") == 0,
    # NaN passes the null filter and poisons every mean: reported, not filtered
    "nan_total_amount": lambda: F.isnan("total_amount"),
}


def quality_report(df: DataFrame, layer: str, warn_pct: float = 5.0,
                   checks: tuple[str, ...] = QUALITY_CHECKS + ("nan_total_amount",)) -> DataFrame:
    """Q1: failed rows per check, percent of the layer, and PASS/WARN/FAIL.

    PASS when nothing fails, WARN below ``warn_pct`` percent, else FAIL; an
    empty layer has 0 % everywhere and passes.
    """
    return _check_rows(df, layer, {c: _CHECK_CONDITIONS[c]() for c in checks}, warn_pct)


def cast_report(bronze: DataFrame, spec: SourceSpec, warn_pct: float = 5.0) -> DataFrame:
    """Q1 on the casts of P1: bronze counters that silver turns to null because they are no whole number of its range.

    NaN, infinities and values beyond INT fail the cast; nulls do not count.
    """
    lost = {f"uncastable_{name}": F.col(column).isNotNull() & F.col(column).try_cast("int").isNull()
            for name, column in (("vendor", spec.vendor), ("passengers", spec.passengers))}
    return _check_rows(bronze, f"bronze_{spec.name}", lost, warn_pct)


def _check_rows(df: DataFrame, layer: str, conditions: dict[str, Column], warn_pct: float) -> DataFrame:
    """One row per named condition: how many rows of the layer meet it, from one aggregate."""
    wide = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(cond).alias(c) for c, cond in conditions.items()])
    stack = ", ".join(f"'{c}', `{c}`" for c in conditions)
    rows = wide.selectExpr("total", f"stack({len(conditions)}, {stack}) AS (check_name, failed)")
    percent = pct(F.col("failed"), F.col("total"))
    return rows.select(
        F.lit(layer).alias("layer"), "check_name", "failed", "total",
        percent.alias("pct"),
        F.when(F.col("failed") == 0, "PASS").when(percent < warn_pct, "WARN")
        .otherwise("FAIL").alias("status"))


def audit_trail(bronze: dict[str, DataFrame], silver: dict[str, DataFrame], gold: DataFrame,
                cfg: LakeConfig) -> DataFrame:
    """Q7: rows per layer and taxi type, with the reason each drop happened.

    bronze -> silver loses rows with a missing required field *and* duplicates
    (the reference's text names only the first); silver -> gold loses pickups
    before the date floor. One union of tagged scans, one aggregate; the
    row ``all`` sums its result rows.
    """
    parts = []
    for spec in cfg.trip_sources:
        b = bronze[spec.name]
        missing = (F.col(spec.pickup).isNull() | F.col(spec.dropoff).isNull()
                   | F.col(spec.amount).isNull())
        parts.append(b.select(F.lit(spec.name).alias("taxi_type"), F.lit("bronze").alias("layer"),
                              missing.alias("missing")))
        parts.append(silver[spec.name].select(F.lit(spec.name).alias("taxi_type"),
                                              F.lit("silver").alias("layer"), F.lit(False).alias("missing")))
    parts.append(gold.select("taxi_type", F.lit("gold").alias("layer"), F.lit(False).alias("missing")))
    tagged = reduce(DataFrame.unionByName, parts)
    by_type = tagged.groupBy("taxi_type").agg(
        F.count_if(F.col("layer") == "bronze").alias("bronze_rows"),
        F.count_if((F.col("layer") == "bronze") & F.col("missing")).alias("dropped_missing"),
        F.count_if(F.col("layer") == "silver").alias("silver_rows"),
        F.count_if(F.col("layer") == "gold").alias("gold_rows"))
    # the all-types row the reference reports its drop totals on: a sum over the few
    # result rows (a rollup would double every trip row); without any type there is none
    counts = ("bronze_rows", "dropped_missing", "silver_rows", "gold_rows")
    counted = by_type.select(F.explode(F.array(F.col("taxi_type"), F.lit("all"))).alias("taxi_type"), *counts) \
        .groupBy("taxi_type").agg(*[F.sum(c).alias(c) for c in counts])
    return (counted.select(
        "taxi_type", "bronze_rows", "silver_rows", "gold_rows", "dropped_missing",
        (F.col("bronze_rows") - F.col("dropped_missing") - F.col("silver_rows")).alias("dropped_duplicate"),
        (F.col("silver_rows") - F.col("gold_rows")).alias("dropped_before_start"),
        pct(F.col("bronze_rows") - F.col("silver_rows"), F.col("bronze_rows")).alias("silver_drop_pct"),
        pct(F.col("silver_rows") - F.col("gold_rows"), F.col("silver_rows")).alias("gold_drop_pct"))
        .orderBy("taxi_type"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of every layer dataset, as one job over zero-column scans."""
    tagged = reduce(DataFrame.unionByName,
                    [df.select(F.lit(name).alias("layer")) for name, df in layers.items()])
    return tagged.groupBy("layer").agg(F.count(F.lit(1)).alias("rows")).orderBy("layer")


def layer_fingerprint(df: DataFrame, layer: str, columns: tuple[str, ...] = CANONICAL_COLUMNS) -> DataFrame:
    """Rows and content hash of a layer; audit timestamps are left out."""
    cols = [c for c in columns if c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("rows"), content_hash(df, cols).alias("content_hash")) \
             .select(F.lit(layer).alias("layer"), "rows", "content_hash")


def month_fingerprints(df: DataFrame, layer: str, month: Column, columns: tuple[str, ...] = CANONICAL_COLUMNS) -> DataFrame:
    """Rows and content hash of each month of a layer; hashes are sums, so those of the months add up to the layer's.

    Two runs can be compared month by month, and a re-run of one month by that month alone.
    """
    cols = [c for c in columns if c in df.columns]
    return (df.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("rows"), content_hash(df, cols).alias("content_hash"))
            .select(F.lit(layer).alias("layer"), "month", "rows", "content_hash"))


def compare_months(first: DataFrame, second: DataFrame) -> DataFrame:
    """Q8: per layer, rows of both runs and how many of its months differ (0 = idempotent).

    One aggregate over the runs' few month rows; a month that only one run has differs.
    """
    tagged = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    of = lambda run, c: F.max(F.when(F.col("run") == run, F.col(c)))
    months = tagged.groupBy("layer", "month").agg(*[of(run, c).alias(f"{c}_{run}") for run in (1, 2) for c in ("rows", "content_hash")])
    differs = ~(F.col("rows_1").eqNullSafe(F.col("rows_2")) & F.col("content_hash_1").eqNullSafe(F.col("content_hash_2")))
    return (months.groupBy("layer").agg(F.sum("rows_1").alias("rows_first"), F.sum("rows_2").alias("rows_second"),
                                        F.sum(differs.cast("int")).cast("int").alias("violations")).orderBy("layer"))
