"""Exact distributed percentiles against brute force."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.functions.quantiles import exact_percentiles


def brute(values, p):
    vals = sorted(v for v in values if v is not None)
    return vals[max(1, math.ceil(p * len(vals))) - 1]


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_matches_brute_force_with_hot_value(spark):
    rnd = random.Random(7)
    values = [round(rnd.uniform(-50, 500), 2) for _ in range(3000)] + [0.0] * 1500 + [None] * 20
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_percentiles(df, "x", PROBS, accuracy=200)
    assert got == [brute(values, p) for p in PROBS]


def test_empty_column_gives_none(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_percentiles(df, "x", [0.5]) == [None]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-20, max_value=20), min_size=1, max_size=60),
       st.sampled_from([0.01, 0.3, 0.5, 0.9, 0.99]))
def test_property_small_inputs(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert exact_percentiles(df, "x", [p], accuracy=50) == [float(brute(values, p))]


def test_narrowing_bounds_every_bracket(spark):
    # max_pairs far below the distinct count: brackets are narrowed before the window
    rnd = random.Random(11)
    values = [rnd.uniform(-1e6, 1e6) for _ in range(4000)] + [42.0] * 3000
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = exact_percentiles(df, "x", PROBS, accuracy=100, max_pairs=40, grid=16)
    assert got == [brute(values, p) for p in PROBS]


def test_narrowing_recovers_from_a_coarse_sketch(spark):
    # accuracy 10 gives sketch brackets that may miss; the result must stay exact
    rnd = random.Random(3)
    values = [float(rnd.randint(0, 5000)) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_percentiles(df, "x", [0.05, 0.5, 0.95], accuracy=10, max_pairs=30, grid=8)
    assert got == [brute(values, p) for p in (0.05, 0.5, 0.95)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=-300, max_value=300), min_size=1, max_size=200),
       st.sampled_from([0.0, 0.1, 0.5, 0.77, 1.0]))
def test_property_narrowed(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_percentiles(df, "x", [p], accuracy=20, max_pairs=5, grid=4)
    assert got == [float(brute(values, p))]


def test_percentile_profile_matches_brute_force_and_handles_empty(spark):
    from pyspark.sql import functions as F

    from strata.functions.quantiles import percentile_profile
    rnd = random.Random(5)
    values = [round(rnd.gauss(50, 30), 3) for _ in range(2500)] + [None] * 7
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = {"p1": 0.01, "median": 0.5, "p99": 0.99}
    summary = {"min": F.min, "max": F.max, "mean": lambda c: F.round(F.avg(c), 4)}
    cols = ["min", *probs, "max", "mean"]
    row = percentile_profile(df, F.col("x"), probs, summary, cols, max_pairs=50, grid=16).first()
    present = [v for v in values if v is not None]
    assert list(row.asDict()) == cols
    assert row["min"] == min(present) and row["max"] == max(present)
    assert row["mean"] == round(sum(present) / len(present), 4)
    assert [row[k] for k in probs] == [brute(values, p) for p in probs.values()]
    empty = percentile_profile(spark.createDataFrame([(None,)], "x double"), F.col("x"), probs,
                               summary, cols).first()
    assert all(empty[c] is None for c in cols)


def test_hot_ends_and_nan_do_not_stop_the_narrowing(spark):
    # the rank lies in a sliver of distinct values between two hot ones; NaN ranks last
    values = [1.0] * 3000 + [1.5 + i / 1000 for i in range(400)] + [9.0] * 3000 + [math.nan] * 5
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    probs = [0.3, 0.5, 0.52, 0.9]
    got = exact_percentiles(df, "x", probs, accuracy=50, max_pairs=10, grid=8)
    assert got == [values[max(1, math.ceil(p * len(values))) - 1] for p in probs]
    assert math.isnan(exact_percentiles(df, "x", [1.0], accuracy=50, max_pairs=10, grid=8)[0])
    assert math.isnan(exact_percentiles(df.filter("isnan(x)"), "x", [0.5], max_pairs=0)[0])


def test_last_merge_reads_groups_not_map_tasks(spark):
    from pyspark.sql import functions as F

    from strata.functions import quantiles
    vals = spark.range(0, 3000, 1, 700).select(F.col("id").cast("double").alias("_x"))
    merged = quantiles._merged(vals, [(F.lit(False), F.lit(True))], [0.0, 0.5, 1.0], 200)
    plan = merged._jdf.queryExecution().optimizedPlan()
    grouped = plan.toString().index("_group")
    assert plan.toString().count("Aggregate") == 2 and grouped > 0
    row = merged.first()
    assert row["m0"] == 3000 and row["s0"][0] == 0.0 and row["s0"][2] == 2999.0
    assert abs(row["s0"][1] - 1500) < 100 and abs(row["d0"] - 3000) < 200
