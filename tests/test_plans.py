"""Physical plans: pushdown, pruning, partial dedup and top-k are what we want."""

import pytest

from strata.config import YELLOW, LakeConfig
from strata.lake import open_lake
from strata.operators import silver
from strata.plans import analytics, profile

from conftest import SF0001


@pytest.fixture(scope="module")
def lake(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return open_lake(spark, SF0001, LakeConfig())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_query1_pushes_filters_and_prunes_columns(lake):
    p = plan(analytics.avg_total_amount_by_month(lake.gold(), lake.cfg))
    for pushed in ("GreaterThanOrEqual(pickup_datetime,1996-01-01T00:00)",
                   "LessThan(pickup_datetime,1996-06-01T00:00)", "EqualTo(taxi_type,yellow)",
                   "GreaterThan(total_amount,0.0)"):
        assert pushed in p
    assert "ReadSchema: struct<total_amount:double,pickup_datetime:timestamp_ntz,taxi_type:string>" in p


def test_month_query_prunes_gold_partitions(lake):
    p = plan(analytics.avg_passengers_by_hour(lake.gold(), lake.cfg))
    assert "PartitionFilters: [isnotnull(pickup_month" in p
    # May only: the period ends on June 1st, so June's folder is not listed
    assert "(pickup_month#" in p and ">= 1996-05-01" in p and "<= 1996-05-01" in p


def test_query_sql_form_has_the_same_pushdown(spark, lake):
    p = plan(analytics.query1_sql(spark, lake.gold(), lake.cfg))
    assert "GreaterThanOrEqual(pickup_datetime" in p and "GreaterThan(total_amount,0.0)" in p
    assert "PartitionFilters: [isnotnull(pickup_month" in p


def test_dedup_limits_before_the_shuffle(lake):
    df = silver.deduplicate_trips(silver.filter_valid_records(
        silver.project_canonical(lake.bronze("yellow"), YELLOW)))
    df._jdf.queryExecution().executedPlan()  # noqa: B018
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert p.count("WindowGroupLimit") >= 2  # partial before and final after the exchange


def test_top_outliers_is_a_distributed_top_k(lake):
    p = plan(profile.top_outliers(lake.bronze("yellow"), YELLOW, 1000.0))
    assert "TakeOrderedAndProject" in p


def test_quality_report_is_one_scan(lake):
    from strata.plans import quality
    p = plan(quality.quality_report(lake.gold(), "gold"))
    assert p.count("FileScan parquet") == 1


def test_cluster_conf_sizes_shuffles_by_input():
    from strata.session import cluster_conf
    small = cluster_conf(10 << 30, cores=64)
    assert small["spark.sql.shuffle.partitions"] == str(3 * 64)
    big = cluster_conf(100 * (1 << 40), cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    mid = cluster_conf(5 * (1 << 40), cores=800)
    assert mid["spark.sql.shuffle.partitions"] == str(5 * (1 << 40) // (256 << 20))
    assert "spark.checkpoint.dir" not in big


def test_dropped_duplicates_has_no_join_and_regroups_by_the_whole_row(lake):
    df = silver.dropped_duplicates(silver.filter_valid_records(
        silver.project_canonical(lake.bronze("yellow"), YELLOW)))
    p = plan(df)
    assert "Join" not in p
    # the regrouping exchange hashes every canonical column, not the trip key alone
    assert any("hashpartitioning(_vk" in line and "total_amount" in line and "_bronze_source_file" in line
               for line in p.splitlines())


def test_layout_check_scans_its_layer_once(lake):
    from strata.operators import layout
    p = plan(layout.overlap_violations(lake.gold()))
    assert p.count("FileScan parquet") == 0     # both levels read the checkpointed file ranges
    assert "Window" in p


def test_schema_reports_read_only_the_columns_they_count(spark, lake):
    for report, wanted, unwanted in (
            (profile.key_column_presence, {"passenger_count", "total_amount"}, {"VendorID", "pickup_datetime"}),
            (profile.schema_drift, {"VendorID", "passenger_count", "payment_type"}, {"total_amount", "pickup_datetime"})):
        text = report(spark, lake.raw_root, lake.cfg)._jdf.queryExecution().executedPlan().toString()
        read = " ".join(line.split("ReadSchema:")[1] for line in text.splitlines() if "ReadSchema:" in line)
        assert all(f"{c}:" in read for c in wanted) and not any(f"{c}:" in read for c in unwanted)
