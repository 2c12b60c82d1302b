"""Every registered query against its DuckDB twin on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from strata.oracle import ORACLE_SQL
from strata.registry import QUERIES
from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def canon(cols, rows):
    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6))
        return repr(v)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF0001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(QUERIES) - set(ORACLE_SQL)
    assert missing == {"amount_stats_approx", "duration_stats_approx"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "avg_total_amount", "trip_count"]
    assert df.count() == 5


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, cur.fetchall())


def test_tables_are_documented_and_others_stay(spark, workdir):
    from strata.operators import tables
    path = f"{workdir}/trips"
    spark.sql("SELECT 1.5D AS total_amount").write.parquet(path)
    spark.sql("CREATE SCHEMA IF NOT EXISTS docs_test")
    for _ in range(2):
        tables.register_table(spark, "docs_test.trips", path, "what it is")
    docs = {r["column_name"]: r["comment"] for r in tables.column_docs(spark, ["docs_test.trips"]).collect()}
    assert docs["total_amount"].startswith("Total charged")
    with pytest.raises(ValueError):
        tables.register_table(spark, "docs_test.trips", f"{workdir}/elsewhere", "other")
    assert spark.table("docs_test.trips").count() == 1
    spark.sql("DROP TABLE docs_test.trips")
