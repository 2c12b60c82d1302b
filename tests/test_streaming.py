"""Incremental bronze ingestion: a second stream run picks up only new month files."""

from pyspark.sql import functions as F

from strata.config import LakeConfig
from strata.operators import bronze
from strata.sources import fixtures, raw
from strata.streaming import incremental

from conftest import SF0001

CFG = LakeConfig(sources=("yellow",))


def test_stream_ingests_only_new_months_and_matches_batch(spark, workdir):
    rroot, broot, ckpt = f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/ckpt"
    trips = fixtures.raw_trips(spark, SF0001, "yellow")

    def land(months):
        for m in months:
            fixtures.delivered_month(trips, "yellow", m).write.mode("overwrite").parquet(
                raw.raw_path(rroot, "yellow", 1996, m))

    land((1, 2, 3))
    first = incremental.ingest_arrivals(spark, rroot, broot, "yellow", ckpt, CFG)
    assert [r.month for r in first] == [1, 2, 3]
    land((4, 5))
    second = incremental.ingest_arrivals(spark, rroot, broot, "yellow", ckpt, CFG)
    assert [r.month for r in second] == [4, 5]
    again = incremental.ingest_arrivals(spark, rroot, broot, "yellow", ckpt, CFG)
    assert again == []

    streamed = {r["month"]: r["n"] for r in bronze.read_bronze(spark, broot, "yellow")
                .groupBy("month").agg(F.count(F.lit(1)).alias("n")).collect()}
    batch_root = f"{workdir}/bronze_batch"
    assert bronze.ingest_source(spark, rroot, batch_root, "yellow", CFG) == {
        (1996, m): n for m, n in streamed.items()}


def test_month_split_over_micro_batches_ends_complete(spark, workdir):
    rroot, broot, ckpt = f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/ckpt"
    trips = fixtures.raw_trips(spark, SF0001, "yellow")
    for m in (1, 2):
        # three part files per month, one file per micro-batch
        fixtures.delivered_month(trips, "yellow", m).repartition(3).write.mode("overwrite").parquet(
            raw.raw_path(rroot, "yellow", 1996, m))
    runs = incremental.ingest_arrivals(spark, rroot, broot, "yellow", ckpt, CFG, max_files_per_trigger=1)
    assert len(runs) >= 3 and {r.month for r in runs} == {1, 2}
    streamed = {(1996, r["month"]): r["n"] for r in bronze.read_bronze(spark, broot, "yellow")
                .groupBy("month").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert streamed == bronze.ingest_source(spark, rroot, f"{workdir}/batch", "yellow",
                                            LakeConfig(sources=("yellow",), months=(1, 2)))
