"""Raw landing, bronze ingest, month replace and schema evolution on a scratch lake."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strata import registry
from strata.config import LakeConfig
from strata.operators import bronze, months
from strata.plans import profile
from strata.sources import raw

CFG = LakeConfig(months=(1, 2, 3), sources=("yellow",))
T = dt.datetime(1996, 1, 1, 12)


def write_month(spark, root, month, rows, int_counters=True, payment=False):
    vt = "bigint" if int_counters else "double"
    schema = (f"VendorID {vt}, passenger_count {vt}, total_amount double, "
              "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz")
    if payment:
        schema += ", payment_type bigint"
    df = spark.createDataFrame(rows, schema)
    df.write.mode("overwrite").parquet(raw.raw_path(root, "yellow", 1996, month))


def row(v, n, amt, payment=None):
    base = (v, n, amt, T, T)
    return base + ((payment,) if payment is not None else ())


def land(spark, root):
    write_month(spark, root, 1, [row(1, 1, 5.0), row(2, 2, 6.0)])
    write_month(spark, root, 2, [row(1.0, 1.0, 5.0), row(2.0, 0.0, 6.0), row(6.0, 3.0, 1.0)],
                int_counters=False)
    write_month(spark, root, 3, [row(1.0, 1.0, 5.0, 4), row(2.0, 2.0, 6.0, 1)], int_counters=False,
                payment=True)


def counts(spark, broot):
    return {r["month"]: r["rows"] for r in bronze.read_bronze(spark, broot, "yellow")
            .groupBy("month").agg(F.count(F.lit(1)).alias("rows")).collect()}


def test_first_load_normalises_drift_and_evolves_schema(spark, workdir):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    got = bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    assert got == {(1996, 1): 2, (1996, 2): 3, (1996, 3): 2}
    b = bronze.read_bronze(spark, broot, "yellow")
    types = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    assert types["VendorID"] == "double" and types["payment_type"] == "double"
    assert types["year"] == "int" and types["month"] == "int"
    per_month = {r["month"]: r["p"] for r in b.groupBy("month").agg(F.count("payment_type").alias("p")).collect()}
    assert per_month == {1: 0, 2: 0, 3: 2}
    files = {r["f"] for r in b.select(F.col("_source_file").alias("f")).distinct().collect()}
    assert all(f.endswith(".parquet") and "/part-" not in f for f in files)
    assert b.select("_source_system").distinct().first()[0] == "nyc_tlc"


def test_month_replace_is_idempotent_and_local(spark, workdir):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    write_month(spark, rroot, 2, [row(1.0, 1.0, 9.0)], int_counters=False)
    for _ in range(2):
        res = bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG)
        assert res.rows == 1
        assert counts(spark, broot) == {1: 2, 2: 1, 3: 2}
    # an empty month file empties its partition and leaves the others
    write_month(spark, rroot, 2, [], int_counters=False)
    bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG)
    assert counts(spark, broot) == {1: 2, 3: 2}


def test_failed_replace_leaves_the_old_month_whole(spark, workdir, monkeypatch):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    old = months.current_folders(spark, broot, "yellow")
    write_month(spark, rroot, 2, [row(float(i), 1.0, 9.0) for i in range(40)], int_counters=False)
    tagged = bronze.bronze_month
    # the lineage column needs the scan itself, so it is taken before the rows are spread
    monkeypatch.setattr(bronze, "bronze_month", lambda scan, y, m, system: tagged(scan, y, m, system).repartition(
        4, "VendorID").withColumn("total_amount", F.when(F.col("VendorID") == 37, F.raise_error(F.lit("disk gone")).cast("double"))
                                  .otherwise(F.col("total_amount"))))
    with pytest.raises(Exception, match="disk gone"):
        bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG)
    assert counts(spark, broot) == {1: 2, 2: 3, 3: 2}
    assert months.current_folders(spark, broot, "yellow") == old
    monkeypatch.undo()
    assert bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG).rows == 40
    assert counts(spark, broot) == {1: 2, 2: 40, 3: 2}


def test_a_reader_keeps_its_month_while_it_is_replaced(spark, workdir):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    plan = bronze.read_bronze(spark, broot, "yellow").where("month = 2").select("total_amount")
    plan._jdf.queryExecution().executedPlan()  # planned: it has its files
    write_month(spark, rroot, 2, [row(1.0, 1.0, 9.0)], int_counters=False)
    bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG)
    assert plan.count() in (1, 3) and counts(spark, broot)[2] == 1
    # of the versions before only the last one stays
    for _ in range(3):
        bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG)
    assert len(months._glob(spark, f"{broot}/yellow/1996-02/*")) == 2
    assert len(months._glob(spark, f"{broot}/yellow/1996-01/*")) == 1


def test_a_write_extends_the_recorded_columns_and_reads_open_no_footer(spark, workdir):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_months(spark, rroot, broot, "yellow", [(1996, 1), (1996, 2)], CFG)
    assert "payment_type" not in months.recorded_columns(spark, broot, "yellow").names
    bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 3, CFG)
    assert months.recorded_columns(spark, broot, "yellow")["payment_type"].dataType.simpleString() == "double"
    spark.sparkContext.setJobGroup("read-bronze", "no job may run")
    b = bronze.read_bronze(spark, broot, "yellow")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("read-bronze")
    spark.sparkContext.setJobGroup("tests", "")
    per_month = {r["month"]: r["p"] for r in b.groupBy("month").agg(F.count("payment_type").alias("p")).collect()}
    assert per_month == {1: 0, 2: 0, 3: 2}
    # an application that does not know the table finds months and columns where they lie
    name = months.table_name(broot, "yellow")
    spark.sql(f"DROP TABLE {name}")
    assert counts(spark, broot) == {1: 2, 2: 3, 3: 2}


def test_partition_count_prunes_partitions(spark, workdir):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    df = bronze.partition_count(bronze.read_bronze(spark, broot, "yellow"), "yellow", 1996, 2)
    assert df.first()["rows"] == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month#" in plan


def test_partition_count_of_an_empty_partition_is_zero(spark, workdir):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    b = bronze.read_bronze(spark, broot, "yellow")
    assert bronze.partition_count(b, "yellow", 1996, 4).first()["rows"] == 0


def test_ingest_of_some_months_keeps_the_others(spark, workdir):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    done = bronze.ingest_months(spark, rroot, broot, "yellow", [(1996, 3), (1996, 4)], CFG)
    assert [(r.month, r.rows) for r in done] == [(3, 2)]
    assert counts(spark, broot) == {1: 2, 2: 3, 3: 2}


def test_unreadable_landed_month_stops_the_ingest(spark, workdir, monkeypatch):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    read = raw.read_raw

    def failing(spark, root, source, year, month):
        if month == 2:
            raise OSError("throttled")
        return read(spark, root, source, year, month)

    monkeypatch.setattr(raw, "read_raw", failing)
    with pytest.raises(OSError):
        bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    assert counts(spark, broot) == {1: 2, 2: 3, 3: 2}


@pytest.mark.parametrize("kind, fits", [("float", True), ("decimal(10,2)", True), ("string", False)])
def test_replaced_month_has_the_recorded_types(spark, workdir, kind, fits):
    rroot, broot = f"{workdir}/raw", f"{workdir}/bronze"
    land(spark, rroot)
    bronze.ingest_source(spark, rroot, broot, "yellow", CFG)
    path = raw.raw_path(rroot, "yellow", 1996, 2)
    month = spark.createDataFrame([row(1.0, 1.0, 5.0)], spark.read.parquet(path).schema)
    month.withColumn("total_amount", F.col("total_amount").cast(kind)).write.mode("overwrite").parquet(path)
    if fits:
        bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG)
        assert dict(bronze.read_bronze(spark, broot, "yellow").dtypes)["total_amount"] == "double"
        assert counts(spark, broot) == {1: 2, 2: 1, 3: 2}
    else:
        with pytest.raises(bronze.SchemaDriftError):
            bronze.ingest_month(spark, rroot, broot, "yellow", 1996, 2, CFG)
        assert counts(spark, broot) == {1: 2, 2: 3, 3: 2}


def test_empty_readable_month_counts_zero(spark, workdir):
    rroot = f"{workdir}/raw"
    land(spark, rroot)
    write_month(spark, rroot, 2, [], int_counters=False)
    got = raw.volume_by_month(spark, rroot, CFG, [(1996, m) for m in (1, 2, 3)]).collect()
    assert {(r["month"], r["trips"]) for r in got} == {(1, 2), (2, 0), (3, 2)}


def test_volume_by_month_skips_missing_months(spark, workdir):
    rroot = f"{workdir}/raw"
    land(spark, rroot)
    got = raw.volume_by_month(spark, rroot, CFG, [(1996, m) for m in (1, 2, 3, 4)]).collect()
    assert {(r["month"], r["trips"]) for r in got} == {(1, 2), (2, 3), (3, 2)}


def test_landed_files_names_each_month_once(spark, workdir):
    rroot = f"{workdir}/raw"
    land(spark, rroot)
    assert raw.landed_files(spark, rroot) == {
        "yellow": {f"yellow_tripdata_1996-0{m}.parquet" for m in (1, 2, 3)}}
    assert raw.landed_files(spark, f"{workdir}/nothing-landed") == {}


def test_corrupt_month_file_is_skipped(spark, workdir):
    import os
    rroot = f"{workdir}/raw"
    land(spark, rroot)
    bad = raw.raw_path(rroot, "yellow", 1996, 4)
    os.makedirs(os.path.dirname(bad), exist_ok=True)
    with open(bad, "wb") as f:
        f.write(b"not parquet")
    found = raw.readable_months(spark, rroot, "yellow", [(1996, m) for m in (1, 2, 3, 4, 5)])
    assert [(y, m) for y, m, _ in found] == [(1996, 1), (1996, 2), (1996, 3)]


@pytest.mark.parametrize("report", ["column_profile", "schema_drift", "key_column_presence", "column_overlap"])
def test_raw_schema_reports_raise_on_an_unreadable_month(spark, workdir, report):
    rroot = f"{workdir}/raw"
    land(spark, rroot)
    with open(raw.raw_path(rroot, "yellow", 1996, 4), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception, match="CANNOT_READ_FILE_FOOTER|not a Parquet file"):
        getattr(profile, report)(spark, rroot, LakeConfig(months=(1, 2, 3, 4), sources=("yellow",))).collect()
    got = raw.volume_by_month(spark, rroot, CFG, [(1996, m) for m in (1, 2, 3, 4)]).collect()
    assert {(r["month"], r["trips"]) for r in got} == {(1, 2), (2, 3), (3, 2)}


def test_raw_scan_raises_on_an_unreadable_month(spark, workdir, monkeypatch):
    rroot = f"{workdir}/raw"
    land(spark, rroot)
    monkeypatch.setattr(registry, "_lake", lambda spark, d: SimpleNamespace(raw_root=d, cfg=LakeConfig(sources=("yellow",))))
    assert registry.raw_scan(spark, rroot).count() == 7
    with open(raw.raw_path(rroot, "yellow", 1996, 4), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception, match="CANNOT_READ_FILE_FOOTER|not a Parquet file"):
        registry.raw_scan(spark, rroot).collect()


def test_schema_reports_keep_the_year(spark, workdir):
    rroot = f"{workdir}/raw"
    land(spark, rroot)
    spark.read.parquet(raw.raw_path(rroot, "yellow", 1996, 3)).write.parquet(raw.raw_path(rroot, "yellow", 1997, 1))
    two = LakeConfig(years=(1996, 1997), months=(1, 2, 3), sources=("yellow",))
    got = {r["data_type"]: r["months"] for r in profile.column_profile(spark, rroot, two)
           .where("column_name = 'payment_type'").collect()}
    assert got == {"absent": "1996-01,1996-02", "bigint": "1996-03,1997-01"}
    one = {r["data_type"]: r["months"] for r in profile.column_profile(spark, rroot, CFG)
           .where("column_name = 'payment_type'").collect()}
    assert one == {"absent": "1,2", "bigint": "3"}


def test_column_profile_gives_bounds_of_numbers_and_times(spark, workdir):
    rroot = f"{workdir}/raw"
    cfg = LakeConfig(months=(1, 2), sources=("yellow",))
    for month, kind, values in ((1, "bigint", (3, 7, None)), (2, "double", (0.5, float("nan"), None))):
        cells = [(None if v is None else str(v), v, f"1996-01-0{i + 1} 00:00:00") for i, v in enumerate(values)]
        spark.createDataFrame([(t, None if v is None else (int(v) if kind == "bigint" else v), at) for t, v, at in cells],
                              f"note string, n {kind}, at string").selectExpr(
            "note", "n", "cast(at as timestamp_ntz) AS at", "cast(null as decimal(9, 2)) AS fee").write.parquet(
            raw.raw_path(rroot, "yellow", 1996, month))
    got = {(r["column_name"], r["data_type"]): r for r in profile.column_profile(spark, rroot, cfg).collect()}
    bounds = lambda r: tuple(r[c] for c in profile.BOUND_COLUMNS)
    assert bounds(got["n", "bigint"]) == (3.0, 7.0, None, None)
    low, high, *times = bounds(got["n", "double"])
    assert low == 0.5 and high != high and times == [None, None]  # NaN is the largest
    assert bounds(got["note", "string"]) == (None,) * 4 == bounds(got["fee", "decimal(9,2)"])
    first, last = bounds(got["at", "timestamp_ntz"])[2:]
    assert (first.day, last.day) == (1, 3) and got["at", "timestamp_ntz"]["months"] == "1,2"


def test_lake_follows_its_inputs_and_a_failed_build_is_not_built(spark, workdir, monkeypatch):
    import shutil
    import tempfile

    from strata.lake import Lake, open_lake
    tables = tempfile.mkdtemp(prefix="strata-inputs-")
    for t in ("lineitem", "orders", "events"):
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", f"{tables}/{t}.parquet")
    root = f"{workdir}/lake"
    builds = []
    monkeypatch.setattr(Lake, "build", lambda self: builds.append(1))
    open_lake(spark, tables, root=root)
    open_lake(spark, tables, root=root)
    assert len(builds) == 1
    shutil.copyfile("/root/testdata/sf0.01/orders.parquet", f"{tables}/orders.parquet")
    open_lake(spark, tables, root=root)
    assert len(builds) == 2

    def failing(self):
        raise RuntimeError("lost")

    monkeypatch.setattr(Lake, "build", failing)
    with pytest.raises(RuntimeError):
        open_lake(spark, tables, root=root, rebuild=True)
    monkeypatch.setattr(Lake, "build", lambda self: builds.append(1))
    open_lake(spark, tables, root=root)
    assert len(builds) == 3


def test_no_shared_folder_on_a_cluster_is_an_error():
    from strata.session import shared_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_root(Session())


def test_a_build_leaves_tables_by_name(spark, workdir):
    from strata.lake import Lake
    from strata.operators import tables
    lake = Lake(spark, None, f"{workdir}/lake", CFG, landed_at=f"{workdir}/raw")
    land(spark, lake.raw_root)
    built = lake.build()  # from landed files alone
    assert built["gold"]["yellow"] == lake.by_name("gold").count() == lake.gold().count() == 3
    names = lake.table_names()
    assert spark.table(names["silver_yellow"]).count() == lake.silver("yellow").count()
    assert tables.table_comment(spark, names["gold"]) == tables.GOLD_TABLE_COMMENT
    docs = {r["column_name"]: r["comment"] for r in tables.column_docs(spark, [names["gold"]]).collect()}
    assert docs["total_amount"] == tables.COLUMN_COMMENTS["total_amount"]
    plan = lake.by_name("gold").where("pickup_month = date'1996-02-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan
    # a rewritten layer is registered anew
    write_month(spark, lake.raw_root, 2, [row(8.0, 1.0, 9.0), row(9.0, 1.0, 9.0)], int_counters=False)
    lake.bronze_and_silver()
    lake.build_gold()
    assert lake.by_name("gold").count() == lake.gold().count() == 4
