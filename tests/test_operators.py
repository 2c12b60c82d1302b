"""Operator unit tests on a handful of literal rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import YELLOW, LakeConfig
from strata.operators import bronze, gold, layout, silver
from strata.plans import quality
from strata.sources import raw

TS = dt.datetime


def bronze_rows(spark, rows):
    schema = ("VendorID double, passenger_count double, total_amount double, "
              "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
              "_source_file string")
    return spark.createDataFrame(rows, schema)


def test_normalize_types_casts_integer_family_only(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 1.5, "x")],
                               "a tinyint, b smallint, c int, d bigint, e float, f string")
    out = bronze.normalize_types(df)
    types = {f.name: f.dataType for f in out.schema.fields}
    assert all(isinstance(types[c], T.DoubleType) for c in "abcd")
    assert isinstance(types["e"], T.FloatType) and isinstance(types["f"], T.StringType)
    assert out.first()["d"] == 4.0


def test_project_canonical_casts_and_tags(spark):
    t = TS(1996, 1, 1, 10)
    df = bronze_rows(spark, [(1.9, 2.7, -0.0, t, t, "f1"), (float("nan"), 1e12, 5.0, t, t, "f1")])
    rows = silver.project_canonical(df, YELLOW).collect()
    assert rows[0]["VendorID"] == 1 and rows[0]["passenger_count"] == 2   # truncation
    assert math.copysign(1, rows[0]["total_amount"]) == 1.0                 # -0.0 -> 0.0
    assert rows[1]["VendorID"] is None and rows[1]["passenger_count"] is None  # NaN, overflow
    assert rows[0]["taxi_type"] == "yellow" and rows[0]["_bronze_source_file"] == "f1"


def test_filter_valid_records_keeps_nan_drops_nulls(spark):
    t = TS(1996, 1, 1)
    df = silver.project_canonical(bronze_rows(spark, [
        (1.0, 1.0, 1.0, t, t, "f"), (1.0, 1.0, None, t, t, "f"), (1.0, 1.0, 2.0, None, t, "f"),
        (1.0, 1.0, 3.0, t, None, "f"), (1.0, 1.0, float("nan"), t, t, "f")]), YELLOW)
    out = silver.filter_valid_records(df).collect()
    assert len(out) == 2 and any(math.isnan(r["total_amount"]) for r in out)


def test_deduplicate_keep_first_rules(spark):
    t0, t1 = TS(1996, 2, 1, 8), TS(1996, 2, 1, 9)
    rows = [
        # cross-file duplicate: the earlier file wins
        (1.0, 1.0, 10.0, t0, t1, "yellow_tripdata_1996-02.parquet"),
        (1.0, 1.0, 11.0, t0, t1, "yellow_tripdata_1996-01.parquet"),
        # same-file reversal: the smaller amount wins, whatever the input order
        (2.0, 1.0, 7.0, t0, t1, "yellow_tripdata_1996-01.parquet"),
        (2.0, 1.0, -7.0, t0, t1, "yellow_tripdata_1996-01.parquet"),
        # null vendors share one key
        (None, 1.0, 3.0, t0, t1, "yellow_tripdata_1996-03.parquet"),
        (None, 2.0, 3.0, t0, t1, "yellow_tripdata_1996-03.parquet"),
    ]
    df = silver.project_canonical(bronze_rows(spark, rows), YELLOW)
    out = {(r["VendorID"], r["total_amount"], r["passenger_count"])
           for r in silver.deduplicate_trips(df).collect()}
    assert out == {(1, 11.0, 1), (2, -7.0, 1), (None, 3.0, 1)}
    dropped = silver.dropped_duplicates(df).count()
    assert dropped == 3
    # dedup is idempotent
    once = silver.deduplicate_trips(df)
    key = lambda rows: sorted(repr(tuple(r)) for r in rows)
    assert key(silver.deduplicate_trips(once).collect()) == key(once.collect())


def test_gold_floor_and_ceiling_are_half_open(spark):
    cfg = LakeConfig()
    mk = lambda ts: (1, 1, 1.0, ts, ts, "yellow", "f")
    df = spark.createDataFrame([mk(TS(1995, 12, 31, 23, 59)), mk(TS(1996, 1, 1)), mk(TS(1996, 6, 1))],
                               "VendorID int, passenger_count int, total_amount double, "
                               "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
                               "taxi_type string, _bronze_source_file string")
    assert gold.gold_frame([df], cfg.start).count() == 2
    assert gold.gold_frame([df], cfg.start, cfg.period_end).count() == 1


def test_quality_report_statuses_and_empty_layer(spark):
    t = TS(1996, 1, 1)
    schema = ("VendorID int, passenger_count int, total_amount double, pickup_datetime timestamp_ntz, "
              "dropoff_datetime timestamp_ntz")
    rows = [(1, 1, 5.0, t, t)] * 97 + [(1, 0, -1.0, t, t)] * 3
    rep = {r["check_name"]: r for r in quality.quality_report(spark.createDataFrame(rows, schema), "x").collect()}
    assert rep["null_pickup_datetime"]["status"] == "PASS"
    assert rep["negative_total_amount"]["failed"] == 3 and rep["negative_total_amount"]["status"] == "WARN"
    assert rep["zero_passenger_count"]["pct"] == 3.0
    many = [(1, 0, 5.0, t, t)] * 10
    rep2 = {r["check_name"]: r for r in quality.quality_report(spark.createDataFrame(many, schema), "x").collect()}
    assert rep2["zero_passenger_count"]["status"] == "FAIL"
    empty = quality.quality_report(spark.createDataFrame([], schema), "x").collect()
    assert all(r["status"] == "PASS" and r["pct"] == 0.0 and r["total"] == 0 for r in empty)


def test_cast_report_counts_what_the_projection_nulls(spark):
    rows = [(1.0, 2.0), (math.nan, 1.0), (3e9, math.inf), (None, None), (2.7, -3e9)]
    df = spark.createDataFrame(rows, "VendorID double, passenger_count double")
    got = {r["check_name"]: (r["failed"], r["total"], r["pct"], r["status"])
           for r in quality.cast_report(df, YELLOW).collect()}
    assert got == {"uncastable_vendor": (2, 5, 40.0, "FAIL"), "uncastable_passengers": (2, 5, 40.0, "FAIL")}
    empty = quality.cast_report(df.limit(0), YELLOW).collect()
    assert {(r["failed"], r["total"], r["pct"], r["status"]) for r in empty} == {(0, 0, 0.0, "PASS")}


def test_overlap_violations_detects_overlapping_files(spark, workdir):
    t = lambda h: TS(1996, 1, 1, h)
    schema = "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, VendorID int"
    a = spark.createDataFrame([(t(1), t(2), 1), (t(5), t(6), 1)], schema)
    b = spark.createDataFrame([(t(3), t(4), 1), (t(7), t(8), 1)], schema)
    a.coalesce(1).write.parquet(f"{workdir}/bad")
    b.coalesce(1).write.mode("append").parquet(f"{workdir}/bad")
    bad = layout.overlap_violations(spark.read.parquet(f"{workdir}/bad")).first()
    assert bad["violations"] == 1 and bad["rows"] == 4
    layout.write_clustered(a.unionByName(b), f"{workdir}/good")
    good = layout.overlap_violations(spark.read.parquet(f"{workdir}/good")).first()
    assert good["violations"] == 0 and good["rows"] == 4


def test_drift_between_incompatible_types_is_named(spark):
    recorded = {}
    bronze._conformed(spark.createDataFrame([(1.0,)], "x double"), recorded, "yellow", "1996-01")
    narrow = bronze._conformed(spark.createDataFrame([(1.0,)], "x float"), recorded, "yellow", "1996-02")
    assert narrow.dtypes == [("x", "double")]
    with pytest.raises(bronze.SchemaDriftError, match="'x' is double in 1996-01 but string in 1996-03"):
        bronze._conformed(spark.createDataFrame([("1",)], "x string"), recorded, "yellow", "1996-03")


def test_content_hash_is_order_insensitive(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    fp = lambda d: quality.layer_fingerprint(d, "t", ("k", "v")).first()["content_hash"]
    assert fp(df) == fp(df.orderBy(F.desc("k")).repartition(3))
    assert fp(df) != fp(df.filter("k < 3"))


def test_month_fingerprints_add_up_and_tell_which_months_differ(spark):
    schema = "m int, v int"
    rows = [(1, 5), (1, 5), (1, 7), (2, 9), (None, 4)]
    months = lambda rows: quality.month_fingerprints(spark.createDataFrame(rows, schema), "x", F.col("m"), ("m", "v"))
    first = months(rows)
    whole = quality.layer_fingerprint(spark.createDataFrame(rows, schema), "x", ("m", "v")).first()
    assert sum(r["rows"] for r in first.collect()) == whole["rows"]
    assert sum(r["content_hash"] for r in first.collect()) == whole["content_hash"]
    compared = lambda other: tuple(quality.compare_months(first, months(other)).first())
    assert compared(rows[::-1]) == ("x", 5, 5, 0)
    assert compared([(1, 5), (1, 7), (1, 7), (2, 9), (None, 4)]) == ("x", 5, 5, 1)  # same rows, other content
    assert compared([*rows, (2, 9), (3, 1)]) == ("x", 5, 7, 2)  # a doubled row, a month more
    assert compared(rows[:4]) == ("x", 5, 4, 1)


def test_duration_ignores_session_time_zone_and_dst(spark):
    from strata.functions.expressions import trip_duration_minutes
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(TS(1996, 4, 7, 1, 30), TS(1996, 4, 7, 2, 20))],
                                   "p timestamp_ntz, d timestamp_ntz")
        assert df.select(trip_duration_minutes("p", "d").alias("m")).first()["m"] == 50.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dropped_duplicates_equals_window_form_on_hot_keys(spark):
    import random

    from pyspark.sql import Window
    rnd = random.Random(3)
    t0 = TS(1996, 3, 1, 8)
    rows = []
    for _ in range(400):
        k = rnd.choice([0, 0, 0, 1, 2])  # key 0 is hot
        rows.append((rnd.choice([None, 1.0]) if k else 1.0, float(rnd.randint(0, 2)),
                     float(rnd.choice([5, -5, 0, 7])), t0, TS(1996, 3, 1, 9 + k),
                     f"yellow_tripdata_1996-0{rnd.randint(1, 3)}.parquet"))
    df = silver.project_canonical(bronze_rows(spark, rows), YELLOW)
    w = Window.partitionBy(*silver.dedup_key()).orderBy(
        *[F.col(c).asc_nulls_first() for c in silver.DEDUP_ORDER])
    window_form = df.withColumn("_rn", F.row_number().over(w)).filter("_rn > 1").drop("_rn")
    key = lambda d: sorted(repr(tuple(r)) for r in d.collect())
    assert key(silver.dropped_duplicates(df)) == key(window_form)
    assert silver.dropped_duplicates(df).count() + silver.deduplicate_trips(df).count() == len(rows)


def test_expand_copies_splits_large_counts_into_chunks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 3)], "v string, n bigint")
    out = silver.expand_copies(df, "n", ["v"], chunk=3)
    assert out.columns == ["v"]
    assert sorted(r["v"] for r in out.collect()) == ["a"] + ["b"] * 7 + ["c"] * 3


def test_overlap_violations_across_day_buckets(spark, workdir):
    # a file spanning three days overlaps the files that start on the later days
    schema = "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, VendorID int"
    long_file = spark.createDataFrame([(TS(1996, 1, 1, 5), TS(1996, 1, 1, 6), 1),
                                       (TS(1996, 1, 3, 12), TS(1996, 1, 3, 13), 1)], schema)
    later = [spark.createDataFrame([(TS(1996, 1, d, 1), TS(1996, 1, d, 2), 1),
                                    (TS(1996, 1, d, 2), TS(1996, 1, d, 3), 1)], schema) for d in (2, 3, 4)]
    long_file.coalesce(1).write.parquet(f"{workdir}/span")
    for part in later:
        part.coalesce(1).write.mode("append").parquet(f"{workdir}/span")
    got = layout.overlap_violations(spark.read.parquet(f"{workdir}/span")).first()
    assert (got["files"], got["rows"], got["violations"]) == (4, 8, 2)


def test_null_vendor_and_vendor_minus_one_have_a_fixed_winner(spark):
    # both rows fall under one dedup key; the null vendor sorts first and wins
    f = "yellow_tripdata_1996-01.parquet"
    rows = [(-1.0, 1.0, 5.0, TS(1996, 1, 2, 8), TS(1996, 1, 2, 9), f),
            (None, 1.0, 5.0, TS(1996, 1, 2, 8), TS(1996, 1, 2, 9), f)]
    for order in (rows, rows[::-1]):
        df = silver.project_canonical(bronze_rows(spark, order).repartition(2), YELLOW)
        kept = silver.deduplicate_trips(df).collect()
        dropped = silver.dropped_duplicates(df).collect()
        assert [r["VendorID"] for r in kept] == [None]
        assert [r["VendorID"] for r in dropped] == [-1]


def test_partitioned_clustered_write_keeps_the_key_order_inside_files(spark, workdir):
    import glob

    import pyarrow.parquet as pq
    start = TS(1996, 1, 1)
    # rows arrive newest first (built that way, so no sort exists for the optimizer to drop)
    rows = [(start + dt.timedelta(minutes=131 * i), start + dt.timedelta(minutes=131 * i + 9), i % 3)
            for i in reversed(range(900))]
    df = (spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
                                      "VendorID int")
          .withColumn("pickup_month", F.trunc(F.col("pickup_datetime").cast("date"), "month"))
          .coalesce(1))
    layout.write_clustered(df, f"{workdir}/t", partition_by=("pickup_month",))
    files = glob.glob(f"{workdir}/t/pickup_month=*/*.parquet")
    assert files
    for f in files:
        col = pq.read_table(f, columns=["pickup_datetime"]).column(0).to_pylist()
        assert col == sorted(col), f


def test_month_bounds_stop_before_a_boundary_end():
    d = dt.date
    assert gold.month_bounds(TS(1996, 5, 1), TS(1996, 6, 1)) == (d(1996, 5, 1), d(1996, 5, 1))
    assert gold.month_bounds(TS(1996, 5, 3), TS(1996, 6, 15)) == (d(1996, 5, 1), d(1996, 6, 1))
    assert gold.month_bounds(TS(1996, 1, 1), TS(1996, 6, 1, 0, 0, 1)) == (d(1996, 1, 1), d(1996, 6, 1))
    assert gold.month_bounds(TS(1996, 12, 31), None) == (d(1996, 12, 1), None)
    assert gold.month_bounds(None, TS(1997, 1, 1)) == (None, d(1996, 12, 1))


def test_landing_persists_nothing(spark, workdir, monkeypatch):
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.persist", lambda *a, **k: pytest.fail("persisted"))
    spark.createDataFrame([(TS(1996, 1, 2), i, float(i)) for i in range(10)], "ts timestamp_ntz, event_id bigint, value double") \
        .write.parquet(f"{workdir}/t/events.parquet")
    raw.land_raw(spark, f"{workdir}/t", f"{workdir}/raw", LakeConfig(), sources=("fhvhv",))
    assert [raw.read_raw(spark, f"{workdir}/raw", "fhvhv", 1996, m).count() for m in range(1, 6)] == [2] * 5


def test_expand_copies_keeps_its_tasks_under_adaptive_execution(spark):
    # few small rows that stand for many: merged by their size, they would be expanded in one task
    df = spark.createDataFrame([(f"v{i}", 500) for i in range(64)], "v string, n bigint")
    out = silver.expand_copies(df, "n", ["v"])
    per_task = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) > 1 and sum(r["count"] for r in per_task) == 32000


def test_file_name_is_the_last_path_segment(spark):
    paths = ["file:///a/b/yellow_tripdata_1996-01.parquet", "plain.parquet", "a/", "", None]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").select("i", raw.file_name(F.col("p")).alias("n"))
    assert [r["n"] for r in rows.orderBy("i").collect()] == ["yellow_tripdata_1996-01.parquet", "plain.parquet", "", "", None]


def test_dedup_sorts_by_the_pickup_first(spark):
    rows = [(1.0, 1.0, 5.0, TS(1996, 1, 2, 8), TS(1996, 1, 2, 9), "f")]
    df = silver.deduplicate_trips(silver.project_canonical(bronze_rows(spark, rows), YELLOW))
    sorts = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in line]
    assert sorts and all("Sort [pickup_datetime" in line for line in sorts)


def test_logical_source_file_of_files_and_part_files(spark):
    paths = ["file:///r/y/y_2020-01.parquet", "file:///r/y/y_2020-01.parquet/part-0-\u00e9.parquet", "file:///a.parquet/b.parquet/c.parquet", "x", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").select("i", raw.logical_source_file(F.col("p")).alias("n"))
    assert [r["n"] for r in df.orderBy("i").collect()] == ["file:///r/y/y_2020-01.parquet", "file:///r/y/y_2020-01.parquet", "file:///a.parquet", "x", None]
    # no search that counts characters on every row
    assert "instr(" not in df._jdf.queryExecution().optimizedPlan().toString()
