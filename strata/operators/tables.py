"""K6-K8: catalog schemas, tables over the layer paths, and their documentation.

Layers are path-based parquet datasets; registering them makes them
queryable by name. Comments are re-applied after every rebuild because an
overwrite of the table drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expressions import sql_string_literal

# Table and column documentation (our own wording).
SILVER_TABLE_COMMENT = ("Silver trips of one taxi type: canonical schema, rows without pickup, "
                        "dropoff or amount removed, keep-first dedup on (vendor, pickup, dropoff); "
                        "clustered by pickup_datetime.")
GOLD_TABLE_COMMENT = ("Gold trips of all taxi types with fare and passenger data, pickups on or "
                      "after the pipeline start date; clustered by pickup_datetime.")
COLUMN_COMMENTS = {
    "VendorID": "Provider code of the trip record; null when the record has none",
    "passenger_count": "Passengers as keyed in by the driver; may be 0 or null",
    "total_amount": "Total charged to the passenger; negative for reversals and disputes",
    "pickup_datetime": "Trip start (renamed from the source's pickup column)",
    "dropoff_datetime": "Trip end (renamed from the source's dropoff column)",
    "taxi_type": "Source of the trip: 'yellow' or 'green'",
    "_bronze_source_file": "Raw file the row was ingested from (lineage back to the publisher)",
    "_silver_processed_at": "When the silver batch holding this row was written",
    "_computed_at": "When the gold table was last computed",
    "pickup_month": "First day of the pickup month; the gold table's partition column",
}


def create_schemas(spark: SparkSession, location: str, *schemas: str) -> None:
    """K6: create the schemas if absent, with their folders below ``location``."""
    for schema in schemas:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}` "
                  f"LOCATION {sql_string_literal(f'{location}/{schema}.db')}")


def _bare(path: str) -> str:
    """A location without the forms that name the same local place."""
    return path.removeprefix("file:").replace("//", "/").rstrip("/")


def register_table(spark: SparkSession, name: str, path: str, comment: str,
                   column_comments: dict[str, str] = COLUMN_COMMENTS) -> None:
    """K7/K8: (re)create an external table over ``path`` and document it.

    A table of that name at another location is somebody else's: it stays, and
    the call fails.
    """
    if spark.catalog.tableExists(name):
        facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        here = _bare(facts.get("Location", ""))
        if facts.get("Type") != "EXTERNAL" or here != _bare(path):
            raise ValueError(f"{name} exists at {here or 'an unknown place'}, not at {path}; it is not replaced")
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    columns = {c.name: c for c in spark.catalog.listColumns(name)}
    if any(c.isPartition for c in columns.values()):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"COMMENT ON TABLE {name} IS {sql_string_literal(comment)}")
    for col, text in column_comments.items():
        # partition columns carry no column comment (Spark refuses to alter them)
        if col in columns and not columns[col].isPartition:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{col}` COMMENT {sql_string_literal(text)}")


def column_docs(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Column comments of the registered tables, as rows."""
    rows = []
    for t in tables:
        for c in spark.catalog.listColumns(t):
            rows.append((t, c.name, c.dataType, c.description))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, comment string")


def table_comment(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Comment").collect()
    return rows[0]["data_type"] if rows else None
