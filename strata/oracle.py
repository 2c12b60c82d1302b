"""DuckDB twins of the registered queries, over the driver tables.

Each text rebuilds the raw sources, bronze, silver and gold from the driver
tables with plain SQL (the mapping of FIXTURES.md) and then states the
report, so the Spark result can be checked by an independent engine.

Portability rules (the two engines differ here):
* double -> int truncates in Spark and rounds in DuckDB: ``CAST(trunc(x) AS INTEGER)``;
* ``round`` is HALF_UP on the decimal text in Spark: round a DECIMAL in DuckDB;
* year/month/hour are int in Spark, bigint in DuckDB: cast to INTEGER;
* nulls sort first ascending in Spark: spell ``NULLS FIRST``.
"""

from __future__ import annotations

from strata.config import SOURCES, LakeConfig

CFG = LakeConfig()
START = CFG.start.strftime("%Y-%m-%d %H:%M:%S")
PERIOD_END = CFG.period_end.strftime("%Y-%m-%d %H:%M:%S")
MONTH_START = CFG.focus_month.strftime("%Y-%m-%d %H:%M:%S")
MONTH_END = CFG.focus_month_end.strftime("%Y-%m-%d %H:%M:%S")
YEAR = CFG.years[0]


def r(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"coalesce({r(f'CAST({part} AS DOUBLE) * 100.0 / nullif({whole}, 0)', 2)}, 0.0)"


def _plus_min(ts: str, minutes: str) -> str:
    return f"{ts} + to_minutes(CAST({minutes} AS BIGINT))"


def _vendor(key: str) -> str:
    return (f"CAST(CASE WHEN {key} % 10 = 0 THEN NULL WHEN {key} % 10 < 6 THEN 1 "
            f"WHEN {key} % 10 < 9 THEN 2 ELSE 6 END AS BIGINT)")


def _file(source: str, month: str = "file_month") -> str:
    return f"'{source}_tripdata_{YEAR}-' || lpad(CAST({month} AS VARCHAR), 2, '0') || '.parquet'"


_Y_OFF = "(l_orderkey % 24) * 60 + l_partkey % 60"
_G_OFF = "(o_custkey % 24) * 60 + o_orderkey % 60"

CTES = f"""
yellow_base AS (
  SELECT {_vendor('l_partkey')} AS VendorID,
         CAST(NULLIF(l_linenumber, 7) - 1 AS BIGINT) AS passenger_count,
         CASE WHEN l_partkey % 40 = 3 THEN NULL WHEN l_partkey % 40 = 5 THEN -l_quantity
              WHEN l_partkey % 40 = 7 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS total_amount,
         CASE WHEN l_partkey % 50 = 11 THEN NULL ELSE {_plus_min('l_shipdate', _Y_OFF)} END
           AS tpep_pickup_datetime,
         CASE WHEN l_partkey % 50 = 13 THEN NULL ELSE {_plus_min('l_shipdate', _Y_OFF +
           ' + CAST(l_quantity AS BIGINT) * CASE WHEN l_partkey % 50 = 17 THEN -1 ELSE 1 END')} END
           AS tpep_dropoff_datetime,
         CAST(CASE WHEN l_partkey % 40 = 5 THEN 4 WHEN l_partkey % 40 = 7 THEN 3 ELSE 1 END AS BIGINT)
           AS payment_type,
         l_orderkey AS k, 1 + l_orderkey % 5 AS file_month
  FROM lineitem),
yellow_raw AS (
  SELECT * FROM yellow_base
  UNION ALL
  SELECT VendorID, passenger_count, total_amount + 1, tpep_pickup_datetime, tpep_dropoff_datetime,
         payment_type, k, 1 + file_month % 5 FROM yellow_base WHERE k % 20 = 0
  UNION ALL
  SELECT VendorID, passenger_count, -total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
         CAST(4 AS BIGINT), k, file_month FROM yellow_base WHERE k % 50 = 1),
green_raw AS (
  SELECT {_vendor('o_custkey')} AS VendorID,
         CAST(NULLIF(o_orderkey % 7, 6) AS BIGINT) AS passenger_count,
         CASE WHEN o_custkey % 40 = 3 THEN NULL WHEN o_custkey % 40 = 5 THEN -o_totalprice
              ELSE o_totalprice END AS total_amount,
         CASE WHEN o_custkey % 50 = 11 THEN NULL ELSE {_plus_min('o_orderdate', _G_OFF)} END
           AS lpep_pickup_datetime,
         CASE WHEN o_custkey % 50 = 13 THEN NULL
              ELSE {_plus_min('o_orderdate', _G_OFF + ' + 5 + o_orderkey % 45')} END AS lpep_dropoff_datetime,
         1 + o_orderkey % 5 AS file_month
  FROM orders),
fhvhv_raw AS (
  SELECT {_plus_min('ts', '0')} AS pickup_datetime, {_plus_min('ts', '5 + event_id % 40')} AS dropoff_datetime,
         value AS base_passenger_fare, 1 + event_id % 5 AS file_month
  FROM events),
bronze_yellow AS (
  SELECT CAST(VendorID AS DOUBLE) AS VendorID, CAST(passenger_count AS DOUBLE) AS passenger_count,
         total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
         CASE WHEN file_month >= 3 THEN CAST(payment_type AS DOUBLE) END AS payment_type,
         {_file('yellow')} AS _source_file, CAST({YEAR} AS INTEGER) AS year,
         CAST(file_month AS INTEGER) AS month
  FROM yellow_raw),
bronze_green AS (
  SELECT CAST(VendorID AS DOUBLE) AS VendorID, CAST(passenger_count AS DOUBLE) AS passenger_count,
         total_amount, lpep_pickup_datetime, lpep_dropoff_datetime,
         {_file('green')} AS _source_file, CAST({YEAR} AS INTEGER) AS year,
         CAST(file_month AS INTEGER) AS month
  FROM green_raw),
bronze_fhvhv AS (
  SELECT pickup_datetime, dropoff_datetime, base_passenger_fare, {_file('fhvhv')} AS _source_file,
         CAST({YEAR} AS INTEGER) AS year, CAST(file_month AS INTEGER) AS month FROM fhvhv_raw),
bronze_fhv AS (
  SELECT pickup_datetime, dropoff_datetime, {_file('fhv')} AS _source_file,
         CAST({YEAR} AS INTEGER) AS year, CAST(file_month AS INTEGER) AS month FROM fhvhv_raw),
projected_yellow AS (
  SELECT CAST(trunc(VendorID) AS INTEGER) AS VendorID, CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
         CAST(total_amount AS DOUBLE) + 0.0 AS total_amount, tpep_pickup_datetime AS pickup_datetime,
         tpep_dropoff_datetime AS dropoff_datetime, 'yellow' AS taxi_type, _source_file AS _bronze_source_file
  FROM bronze_yellow),
projected_green AS (
  SELECT CAST(trunc(VendorID) AS INTEGER) AS VendorID, CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
         CAST(total_amount AS DOUBLE) + 0.0 AS total_amount, lpep_pickup_datetime AS pickup_datetime,
         lpep_dropoff_datetime AS dropoff_datetime, 'green' AS taxi_type, _source_file AS _bronze_source_file
  FROM bronze_green),
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY taxi_type, coalesce(VendorID, -1), pickup_datetime, dropoff_datetime
           ORDER BY _bronze_source_file, total_amount NULLS FIRST, passenger_count NULLS FIRST,
                    VendorID NULLS FIRST) AS rn
  FROM (SELECT * FROM projected_yellow UNION ALL SELECT * FROM projected_green)
  WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND total_amount IS NOT NULL),
silver_yellow AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 AND taxi_type = 'yellow'),
silver_green AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 AND taxi_type = 'green'),
gold AS (
  SELECT * FROM (SELECT * FROM silver_yellow UNION ALL SELECT * FROM silver_green)
  WHERE pickup_datetime >= TIMESTAMP '{START}'),
period AS (
  SELECT * FROM gold WHERE pickup_datetime >= TIMESTAMP '{START}' AND pickup_datetime < TIMESTAMP '{PERIOD_END}'),
by_type_month AS (
  SELECT taxi_type, CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS trips,
         avg(total_amount) AS _avg, sum(total_amount) AS _sum, count(total_amount) AS _n
  FROM period GROUP BY 1, 2),
hourly AS (
  SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour, count(*) AS trips,
         {r('avg(total_amount)', 2)} AS avg_fare, {r('sum(total_amount) / 1e6', 2)} AS revenue_M
  FROM period GROUP BY 1),
yellow_dur AS (
  SELECT CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) / 60.0 AS d
  FROM bronze_yellow)
"""

VIEW_COLUMNS = ("VendorID, passenger_count, total_amount, pickup_datetime, dropoff_datetime, "
                "taxi_type, _bronze_source_file AS source_file")


def q(body: str) -> str:
    return f"WITH {CTES}\n{body}"


def _quality(layer: str, table: str) -> str:
    checks = [
        ("null_pickup_datetime", "pickup_datetime IS NULL"),
        ("null_dropoff_datetime", "dropoff_datetime IS NULL"),
        ("null_total_amount", "total_amount IS NULL"),
        ("negative_total_amount", "total_amount < 0"),
        ("null_passenger_count", "passenger_count IS NULL"),
        ("zero_passenger_count", "passenger_count = 0"),
        ("nan_total_amount", "isnan(total_amount)"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, (SELECT count(*) FROM {table} WHERE {cond}) AS failed, "
        f"(SELECT count(*) FROM {table}) AS total" for name, cond in checks)
    return (f"SELECT '{layer}' AS layer, check_name, failed, total, {pct('failed', 'total')} AS pct, "
            f"CASE WHEN failed = 0 THEN 'PASS' WHEN {pct('failed', 'total')} < {CFG.warn_pct} THEN 'WARN' "
            f"ELSE 'FAIL' END AS status FROM ({rows})")


def _cast_report() -> str:
    counts = " UNION ALL ".join(
        f"SELECT 'bronze_{s}' AS layer, 'uncastable_{name}' AS check_name, count(*) AS total, "
        f"count(*) FILTER (WHERE {col} IS NOT NULL AND TRY_CAST(trunc({col}) AS INTEGER) IS NULL) AS failed FROM bronze_{s}"
        for s in ("yellow", "green") for name, col in (("vendor", "VendorID"), ("passengers", "passenger_count")))
    return (f"SELECT layer, check_name, failed, total, {pct('failed', 'total')} AS pct, CASE WHEN failed = 0 THEN 'PASS' "
            f"WHEN {pct('failed', 'total')} < {CFG.warn_pct} THEN 'WARN' ELSE 'FAIL' END AS status FROM ({counts})")


# Columns of every raw source and the type each month file delivers them in.
_BIG_THEN_DOUBLE = (("bigint", "1,2"), ("double", "3,4,5"))
RAW_COLUMNS = {
    "yellow": ("yellow_raw", [
        ("VendorID", _BIG_THEN_DOUBLE), ("passenger_count", _BIG_THEN_DOUBLE),
        ("total_amount", (("double", "1,2,3,4,5"),)),
        ("tpep_pickup_datetime", (("timestamp_ntz", "1,2,3,4,5"),)),
        ("tpep_dropoff_datetime", (("timestamp_ntz", "1,2,3,4,5"),)),
        ("payment_type", (("absent", "1,2"), ("bigint", "3,4,5")))]),
    "green": ("green_raw", [
        ("VendorID", _BIG_THEN_DOUBLE), ("passenger_count", _BIG_THEN_DOUBLE),
        ("total_amount", (("double", "1,2,3,4,5"),)),
        ("lpep_pickup_datetime", (("timestamp_ntz", "1,2,3,4,5"),)),
        ("lpep_dropoff_datetime", (("timestamp_ntz", "1,2,3,4,5"),))]),
    "fhv": ("fhvhv_raw", [
        ("pickup_datetime", (("timestamp_ntz", "1,2,3,4,5"),)),
        ("dropoff_datetime", (("timestamp_ntz", "1,2,3,4,5"),))]),
    "fhvhv": ("fhvhv_raw", [
        ("pickup_datetime", (("timestamp_ntz", "1,2,3,4,5"),)),
        ("dropoff_datetime", (("timestamp_ntz", "1,2,3,4,5"),)),
        ("base_passenger_fare", (("double", "1,2,3,4,5"),))]),
}
BRONZE = {"yellow": "bronze_yellow", "green": "bronze_green", "fhv": "bronze_fhv", "fhvhv": "bronze_fhvhv"}


def _raw_profile(bounds: bool = False) -> str:
    parts = []
    for source, (table, columns) in RAW_COLUMNS.items():
        for col, variants in columns:
            for dtype, months in variants:
                nn = "CAST(0 AS BIGINT)" if dtype == "absent" else f"count({col})"
                parts.append(
                    f"SELECT '{source}' AS taxi_type, '{col}' AS column_name, '{dtype}' AS data_type, "
                    f"'{months}' AS months, count(*) AS rows, {nn} AS non_nulls{_column_bounds(col, dtype) if bounds else ''} FROM {table} "
                    f"WHERE file_month IN ({months})")
    return " UNION ALL ".join(parts)


def _column_bounds(col: str, dtype: str) -> str:
    number, time = dtype in ("bigint", "double"), dtype == "timestamp_ntz"
    return "".join(f", CAST({f'{side}({col})' if fits else 'NULL'} AS {kind}) AS {side}_{name}"
                   for fits, kind, name in ((number, "DOUBLE", "number"), (time, "TIMESTAMP", "time"))
                   for side in ("min", "max"))


def _bronze_columns(source: str) -> list[str]:
    cols = [c for c, _ in RAW_COLUMNS[source][1]]
    return cols


def _null_report() -> str:
    parts = []
    for source, table in BRONZE.items():
        for col in _bronze_columns(source):
            parts.append(f"SELECT '{source}' AS taxi_type, '{col}' AS column_name, "
                         f"count(*) FILTER (WHERE {col} IS NULL) AS nulls, count(*) AS total FROM {table}")
    return (f"SELECT taxi_type, column_name, nulls, total, {pct('nulls', 'total')} AS pct "
            f"FROM ({' UNION ALL '.join(parts)}) WHERE nulls > 0")


def _normalize_types() -> str:
    parts = []
    for source, table in BRONZE.items():
        for col, variants in RAW_COLUMNS[source][1]:
            dtype = "timestamp_ntz" if variants[-1][0] == "timestamp_ntz" else "double"
            parts.append(f"SELECT '{source}' AS taxi_type, '{col}' AS column_name, '{dtype}' AS data_type, "
                         f"count({col}) AS non_nulls FROM {table}")
    return " UNION ALL ".join(parts)


def _monetary() -> str:
    parts = []
    for source, col in (("yellow", "total_amount"), ("green", "total_amount"),
                        ("fhvhv", "base_passenger_fare")):
        parts.append(
            f"SELECT '{source}' AS taxi_type, '{col}' AS column_name, count({col}) AS non_nulls, "
            f"{r(f'sum({col})', 2)} AS total, {r(f'avg({col})', 4)} AS mean, min({col}) AS min, "
            f"max({col}) AS max FROM {BRONZE[source]}")
    return " UNION ALL ".join(parts)


def _layer_counts(layers: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS layer, count(*) AS rows FROM {t}" for name, t in layers)


LAYERS = [("bronze_fhv", "bronze_fhv"), ("bronze_fhvhv", "bronze_fhvhv"), ("bronze_green", "bronze_green"),
          ("bronze_yellow", "bronze_yellow"), ("gold", "gold"), ("silver_green", "silver_green"),
          ("silver_yellow", "silver_yellow")]

ORACLE_SQL: dict[str, str] = {
    "q1": q(f"""SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
       {r('avg(total_amount)', 2)} AS avg_total_amount, count(*) AS trip_count
FROM period WHERE taxi_type = 'yellow' AND total_amount > 0 GROUP BY 1, 2 ORDER BY 1, 2"""),
    "q1_sql": q(f"""SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
       {r('avg(total_amount)', 2)} AS avg_total_amount
FROM period WHERE taxi_type = 'yellow' AND total_amount > 0 GROUP BY 1, 2 ORDER BY 1, 2"""),
    "q2": q(f"""SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
       {r('avg(passenger_count)', 2)} AS avg_passenger_count, count(*) AS trip_count
FROM gold WHERE pickup_datetime >= TIMESTAMP '{MONTH_START}' AND pickup_datetime < TIMESTAMP '{MONTH_END}'
  AND passenger_count IS NOT NULL AND passenger_count > 0
GROUP BY 1 ORDER BY 1"""),
    "q2_sql": q(f"""SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
       {r('avg(passenger_count)', 2)} AS avg_passenger_count
FROM gold WHERE pickup_datetime >= TIMESTAMP '{MONTH_START}' AND pickup_datetime < TIMESTAMP '{MONTH_END}'
  AND passenger_count IS NOT NULL AND passenger_count > 0
GROUP BY 1 ORDER BY 1"""),
    "q1_labelled": q(f"""SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
       CASE month(pickup_datetime) {' '.join(f"WHEN {k} THEN '{v}'" for k, v in CFG.month_labels.items())} END AS label,
       {r('avg(total_amount)', 2)} AS avg_total_amount, count(*) AS trip_count
FROM period WHERE taxi_type = 'yellow' AND total_amount > 0 GROUP BY 1, 2, 3 ORDER BY 1, 2"""),
    "compare_by_type_month": q(f"""SELECT taxi_type, month, trips, {r('_avg', 2)} AS avg_fare,
       {r('_sum', 0)} AS total_revenue FROM by_type_month ORDER BY 1, 2"""),
    "type_summary": q(f"""SELECT taxi_type, CAST(sum(trips) AS BIGINT) AS trips, {r('avg(avg_fare)', 2)} AS avg_fare,
       {r('sum(total_revenue)', 2)} AS total_revenue, {r('sum(_sum) / sum(_n)', 2)} AS avg_fare_weighted
FROM (SELECT taxi_type, trips, {r('_avg', 2)} AS avg_fare, {r('_sum', 0)} AS total_revenue, _sum, _n
      FROM by_type_month) GROUP BY 1 ORDER BY 1"""),
    "hourly_revenue": q("SELECT hour, trips, avg_fare, revenue_M FROM hourly ORDER BY hour"),
    "peak_hours": q("""SELECT (SELECT hour FROM hourly ORDER BY trips DESC, hour LIMIT 1) AS peak_demand_hour,
       (SELECT max(trips) FROM hourly) AS peak_demand_trips,
       (SELECT hour FROM hourly ORDER BY avg_fare DESC, hour LIMIT 1) AS peak_fare_hour,
       (SELECT max(avg_fare) FROM hourly) AS peak_avg_fare"""),
    "gold_counts_by_type": q("SELECT taxi_type, count(*) AS n FROM gold GROUP BY 1 ORDER BY 1"),
    "quality_report": q(_quality("gold", "gold")),
    "silver_quality_report": q(_quality("silver_yellow", "silver_yellow") + " UNION ALL "
                               + _quality("silver_green", "silver_green")),
    "bronze_cast_report": q(_cast_report()),
    "audit_trail": q(f"""SELECT taxi_type, bronze_rows, silver_rows, gold_rows, dropped_missing,
       bronze_rows - dropped_missing - silver_rows AS dropped_duplicate,
       silver_rows - gold_rows AS dropped_before_start,
       {pct('bronze_rows - silver_rows', 'bronze_rows')} AS silver_drop_pct,
       {pct('silver_rows - gold_rows', 'silver_rows')} AS gold_drop_pct
FROM (
  SELECT 'yellow' AS taxi_type, (SELECT count(*) FROM bronze_yellow) AS bronze_rows,
         (SELECT count(*) FROM bronze_yellow WHERE tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL
            OR total_amount IS NULL) AS dropped_missing,
         (SELECT count(*) FROM silver_yellow) AS silver_rows,
         (SELECT count(*) FROM gold WHERE taxi_type = 'yellow') AS gold_rows
  UNION ALL
  SELECT 'green', (SELECT count(*) FROM bronze_green),
         (SELECT count(*) FROM bronze_green WHERE lpep_pickup_datetime IS NULL OR lpep_dropoff_datetime IS NULL
            OR total_amount IS NULL),
         (SELECT count(*) FROM silver_green), (SELECT count(*) FROM gold WHERE taxi_type = 'green')
  UNION ALL
  SELECT 'all', (SELECT count(*) FROM bronze_yellow) + (SELECT count(*) FROM bronze_green),
         (SELECT count(*) FROM bronze_yellow WHERE tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL
            OR total_amount IS NULL)
         + (SELECT count(*) FROM bronze_green WHERE lpep_pickup_datetime IS NULL OR lpep_dropoff_datetime IS NULL
            OR total_amount IS NULL),
         (SELECT count(*) FROM silver_yellow) + (SELECT count(*) FROM silver_green),
         (SELECT count(*) FROM gold))
ORDER BY taxi_type"""),
    "layer_counts": q(_layer_counts(LAYERS) + " ORDER BY layer"),
    "silver_yellow": q(f"SELECT {VIEW_COLUMNS} FROM silver_yellow"),
    "silver_green": q(f"SELECT {VIEW_COLUMNS} FROM silver_green"),
    "gold_trips": q(f"SELECT {VIEW_COLUMNS} FROM gold"),
    "silver_project": q(f"SELECT {VIEW_COLUMNS} FROM projected_yellow UNION ALL "
                        f"SELECT {VIEW_COLUMNS} FROM projected_green"),
    "filter_valid_records": q("""SELECT taxi_type, count(*) AS rows_in,
       count(*) FILTER (WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
                        AND total_amount IS NOT NULL) AS rows_valid
FROM (SELECT * FROM projected_yellow UNION ALL SELECT * FROM projected_green) GROUP BY 1 ORDER BY 1"""),
    "deduplicate": q(f"SELECT {VIEW_COLUMNS} FROM ranked WHERE rn = 1"),
    "dropped_duplicates": q(f"SELECT {VIEW_COLUMNS} FROM ranked WHERE rn > 1"),
    "raw_scan": q(f"""SELECT CAST(VendorID AS DOUBLE) AS VendorID, CAST(passenger_count AS DOUBLE) AS passenger_count,
       total_amount, tpep_pickup_datetime, tpep_dropoff_datetime, CASE WHEN file_month >= 3 THEN payment_type END AS payment_type,
       NULL::TIMESTAMP AS lpep_pickup_datetime, NULL::TIMESTAMP AS lpep_dropoff_datetime, NULL::TIMESTAMP AS pickup_datetime,
       NULL::TIMESTAMP AS dropoff_datetime, NULL::DOUBLE AS base_passenger_fare, 'yellow' AS taxi_type,
       CAST({YEAR} AS INTEGER) AS year, CAST(file_month AS INTEGER) AS month FROM yellow_raw
UNION ALL SELECT CAST(VendorID AS DOUBLE), CAST(passenger_count AS DOUBLE), total_amount, NULL, NULL, NULL, lpep_pickup_datetime,
       lpep_dropoff_datetime, NULL, NULL, NULL, 'green', CAST({YEAR} AS INTEGER), CAST(file_month AS INTEGER) FROM green_raw
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, pickup_datetime, dropoff_datetime, NULL, 'fhv',
       CAST({YEAR} AS INTEGER), CAST(file_month AS INTEGER) FROM fhvhv_raw
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, pickup_datetime, dropoff_datetime, base_passenger_fare, 'fhvhv',
       CAST({YEAR} AS INTEGER), CAST(file_month AS INTEGER) FROM fhvhv_raw"""),
    "volume_by_month": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, CAST({YEAR} AS INTEGER) AS year, CAST(file_month AS INTEGER) AS month, "
        f"count(*) AS trips FROM {t} GROUP BY file_month"
        for s, t in (("yellow", "yellow_raw"), ("green", "green_raw"), ("fhv", "fhvhv_raw"),
                     ("fhvhv", "fhvhv_raw"))) + " ORDER BY 1, 2, 3"),
    "bronze_lineage": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, {_file(s, 'month')} AS source_file, 'nyc_tlc' AS _source_system, year, month, "
        f"count(*) AS rows FROM {t} GROUP BY year, month" for s, t in BRONZE.items()) + " ORDER BY 1, 4, 5"),
    "bronze_counts": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, year, month, count(*) AS rows FROM {t} GROUP BY 2, 3"
        for s, t in BRONZE.items()) + " ORDER BY 1, 2, 3"),
    "bronze_partition_count": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, year, month, count(*) AS rows FROM {t} GROUP BY 2, 3"
        for s, t in BRONZE.items()) + " ORDER BY 1, 2, 3"),
    "bronze_reingest_months": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, year, month, count(*) AS rows FROM {t} GROUP BY 2, 3"
        for s, t in BRONZE.items()) + " ORDER BY 1, 2, 3"),
    "normalize_types": q(_normalize_types() + " ORDER BY 1, 2"),
    "bronze_schema_evolution": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, year, month, count(*) AS rows, "
        f"{'count(payment_type)' if s == 'yellow' else 'CAST(0 AS BIGINT)'} AS payment_type_values FROM {t} GROUP BY 2, 3"
        for s, t in BRONZE.items()) + " ORDER BY 1, 2, 3"),
    "bronze_replace_month": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, year, month, count(*) AS rows FROM {t} WHERE month <> 3 OR {SOURCES[s].pickup} IS NOT NULL "
        f"GROUP BY 2, 3" for s, t in BRONZE.items()) + " ORDER BY 1, 2, 3"),
    "bronze_incremental": q(" UNION ALL ".join(
        f"SELECT '{s}' AS taxi_type, year, month, count(*) AS rows FROM {t} GROUP BY 2, 3"
        for s, t in BRONZE.items()) + " ORDER BY 1, 2, 3"),
    "clustered_layout": q("""SELECT 'gold' AS layer, count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM gold
UNION ALL SELECT 'silver_green', count(*), 0 FROM silver_green
UNION ALL SELECT 'silver_yellow', count(*), 0 FROM silver_yellow ORDER BY 1"""),
    "idempotency": q(f"""SELECT layer, rows AS rows_first, rows AS rows_second, CAST(0 AS INTEGER) AS violations
FROM ({_layer_counts(LAYERS)}) ORDER BY layer"""),
    "pickup_year_distribution": q("""SELECT taxi_type, pickup_year, count(*) AS trips FROM (
  SELECT 'yellow' AS taxi_type, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year FROM bronze_yellow
  UNION ALL SELECT 'green', CAST(year(lpep_pickup_datetime) AS INTEGER) FROM bronze_green)
GROUP BY 1, 2 ORDER BY 1, 2 NULLS FIRST"""),
    "passenger_distribution": q("""SELECT passenger_count, count(*) AS trips FROM bronze_yellow
GROUP BY 1 ORDER BY 1 NULLS FIRST"""),
    "vendor_distribution": q("""SELECT taxi_type, VendorID, count(*) AS trips FROM (
  SELECT 'yellow' AS taxi_type, VendorID FROM bronze_yellow UNION ALL SELECT 'green', VendorID FROM bronze_green)
GROUP BY 1, 2 ORDER BY 1, 2 NULLS FIRST"""),
    "amount_stats": q(f"""SELECT min(total_amount) AS min, quantile_disc(total_amount, 0.01) AS p1,
       quantile_disc(total_amount, 0.25) AS p25, quantile_disc(total_amount, 0.5) AS median,
       quantile_disc(total_amount, 0.75) AS p75, quantile_disc(total_amount, 0.99) AS p99,
       max(total_amount) AS max, {r('avg(total_amount)', 4)} AS mean FROM bronze_yellow"""),
    "duration_stats": q("""SELECT min(d) AS min, quantile_disc(d, 0.01) AS p1, quantile_disc(d, 0.5) AS median,
       quantile_disc(d, 0.99) AS p99, max(d) AS max FROM yellow_dur"""),
    "negative_duration": q("""SELECT count(*) FILTER (WHERE d < 0) AS negative_duration_trips, count(*) AS trips
FROM yellow_dur"""),
    "passenger_avg_compare": q(f"""SELECT {r('avg(passenger_count)', 4)} AS avg_with_zeros,
       {r('avg(CASE WHEN passenger_count > 0 THEN passenger_count END)', 4)} AS avg_without_zeros
FROM bronze_yellow"""),
    "passenger_problem_rate": q(f"""SELECT problematic, total, {pct('problematic', 'total')} AS pct FROM (
  SELECT count(*) FILTER (WHERE passenger_count IS NULL OR passenger_count = 0) AS problematic,
         count(*) AS total FROM bronze_yellow)"""),
    "amount_anomalies": q(f"""SELECT count(*) FILTER (WHERE total_amount < 0) AS negative,
       count(*) FILTER (WHERE total_amount = 0) AS zero,
       count(*) FILTER (WHERE total_amount > {CFG.outlier_threshold}) AS above_threshold,
       count(*) AS total FROM bronze_yellow"""),
    "top_outliers": q(f"""SELECT total_amount, tpep_pickup_datetime AS pickup_datetime,
       tpep_dropoff_datetime AS dropoff_datetime, passenger_count
FROM bronze_yellow WHERE total_amount > {CFG.outlier_threshold}
ORDER BY total_amount DESC, pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST,
         passenger_count NULLS FIRST LIMIT 10"""),
    "negative_amount_sample": q("""SELECT total_amount, tpep_pickup_datetime AS pickup_datetime, payment_type
FROM bronze_yellow WHERE total_amount < 0
ORDER BY total_amount NULLS FIRST, pickup_datetime NULLS FIRST, payment_type NULLS FIRST LIMIT 10"""),
    "null_report": q(_null_report() + " ORDER BY taxi_type, nulls DESC, column_name"),
    "column_profile": f"WITH {CTES}, raw_profile AS ({_raw_profile(bounds=True)})\n"
                      "SELECT * FROM raw_profile ORDER BY taxi_type, column_name, data_type",
    "schema_drift": f"WITH {CTES}, raw_profile AS ({_raw_profile()})\n"
                    """SELECT * FROM raw_profile p WHERE (SELECT count(*) FROM raw_profile x
  WHERE x.taxi_type = p.taxi_type AND x.column_name = p.column_name) > 1
ORDER BY taxi_type, column_name, months""",
    "key_column_presence": f"WITH {CTES}, raw_profile AS ({_raw_profile()})\n"
                           """SELECT s.taxi_type, k.column_name, sum(p.non_nulls) IS NOT NULL AS present,
       CAST(coalesce(sum(p.non_nulls), 0) AS BIGINT) AS non_nulls
FROM (SELECT DISTINCT taxi_type FROM raw_profile) s
CROSS JOIN (VALUES ('passenger_count'), ('total_amount')) k(column_name)
LEFT JOIN raw_profile p ON p.taxi_type = s.taxi_type AND p.column_name = k.column_name AND p.data_type <> 'absent'
GROUP BY 1, 2 ORDER BY 1, 2""",
    "column_overlap": f"WITH {CTES}, raw_profile AS ({_raw_profile()})\n"
                      """SELECT column_name, string_agg(DISTINCT taxi_type, ',' ORDER BY taxi_type) AS sources,
       count(DISTINCT taxi_type) AS n_sources, CAST(sum(non_nulls) AS BIGINT) AS non_nulls,
       count(DISTINCT taxi_type) = 1 AS exclusive
FROM raw_profile WHERE data_type <> 'absent' GROUP BY 1 ORDER BY 1""",
    "monetary_columns": q(_monetary() + " ORDER BY 1, 2"),
}
