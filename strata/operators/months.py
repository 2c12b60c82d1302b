"""Versioned month folders of a bronze source, and the catalog table over them.

Every write of a month goes to a folder of its own,
``{bronze_root}/{source}/{YYYY-MM}/{version}``. It counts once it is marked complete,
and readers move to it by one catalog change (``ALTER TABLE ... PARTITION ... SET
LOCATION``), so a month is never seen half-written and a failed write leaves the old
month whole. The version before the current one stays for readers that still hold it;
older ones are dropped by the next replace.

The columns of a source are recorded beside its months and extended by the write that
brings a new one (``ALTER TABLE ... ADD COLUMNS``). Neither a write nor a read opens
the footers of the other months to learn types; a column is null in older months.

Folders and record are what lasts: a session whose catalog does not know the source
(an in-memory one) registers it from them when it first reads or writes. A shared
metastore already has it.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from strata.functions.expressions import sql_string_literal

_COMPLETE = "_COMPLETE"
_SCHEMA = "_columns"
_LOCK = threading.RLock()
# Where this application's catalog has the months of a table: (application, table) -> {(year, month): folder}.
_KNOWN: dict[tuple[str, str], dict[tuple[int, int], str]] = {}


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    place, system = _path(spark, pattern)
    return [str(s.getPath()) for s in system.globStatus(place) or ()]


def new_version() -> str:
    """Versions sort by the time they were begun."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def month_folder(bronze_root: str, source: str, year: int, month: int, version: str) -> str:
    return f"{bronze_root}/{source}/{year:04d}-{month:02d}/{version}"


def mark_complete(spark: SparkSession, folder: str) -> None:
    place, system = _path(spark, f"{folder}/{_COMPLETE}")
    system.create(place, True).close()


def _versions(spark: SparkSession, bronze_root: str, source: str, month: str = "[0-9]*") -> dict[tuple[int, int], list[str]]:
    """Folders of complete versions, oldest first, by month."""
    found: dict[tuple[int, int], list[str]] = {}
    for marker in sorted(_glob(spark, f"{bronze_root}/{source}/{month}/*/{_COMPLETE}")):
        folder = marker.rsplit("/", 1)[0]
        year, number = folder.rsplit("/", 2)[1].split("-")
        found.setdefault((int(year), int(number)), []).append(folder)
    return found


def current_folders(spark: SparkSession, bronze_root: str, source: str) -> dict[tuple[int, int], str]:
    """The folder that holds each month: its newest complete version."""
    return {ym: folders[-1] for ym, folders in _versions(spark, bronze_root, source).items()}


def drop_superseded(spark: SparkSession, bronze_root: str, source: str, year: int, month: int) -> None:
    """Delete what is older than the version before the current one, left-overs of failed writes included."""
    name = f"{year:04d}-{month:02d}"
    complete = _versions(spark, bronze_root, source, name).get((year, month), [])
    if len(complete) < 2:
        return
    oldest_kept = complete[-2].rsplit("/", 1)[1]
    for folder in _glob(spark, f"{bronze_root}/{source}/{name}/*"):
        if folder.rsplit("/", 1)[1] < oldest_kept:
            place, system = _path(spark, folder)
            system.delete(place, True)


def recorded_columns(spark: SparkSession, bronze_root: str, source: str) -> T.StructType | None:
    """The recorded columns of a source, partition columns aside; None before the first write."""
    names = sorted(p for p in _glob(spark, f"{bronze_root}/{source}/{_SCHEMA}/*") if p.endswith(".json"))
    if not names:
        return None
    place, system = _path(spark, names[-1])
    stream = system.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def record_columns(spark: SparkSession, bronze_root: str, source: str, columns: T.StructType) -> None:
    """Record the columns under a new name; it appears whole, by a rename."""
    version = new_version()
    draft, system = _path(spark, f"{bronze_root}/{source}/{_SCHEMA}/{version}.draft")
    stream = system.create(draft, True)
    stream.write(bytearray(columns.json(), "utf-8"))
    stream.close()
    final, _ = _path(spark, f"{bronze_root}/{source}/{_SCHEMA}/{version}.json")
    if not system.rename(draft, final):
        raise OSError(f"could not record the columns of {source} in {bronze_root}")


def _schema_name(bronze_root: str) -> str:
    bare = bronze_root.removeprefix("file:").replace("//", "/").rstrip("/")
    return f"bronze_{hashlib.sha1(bare.encode()).hexdigest()[:10]}"


def table_name(bronze_root: str, source: str) -> str:
    """The table of a source: bronze roots have a schema each."""
    return f"{_schema_name(bronze_root)}.{source}"


def _ddl(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def synchronise(spark: SparkSession, bronze_root: str, source: str) -> str | None:
    """The catalog table of a source, made or brought to the recorded columns and current folders; None if nothing was written.

    Months that moved are moved by one change each.
    """
    with _LOCK:
        columns = recorded_columns(spark, bronze_root, source)
        if columns is None:
            return None
        name = table_name(bronze_root, source)
        key = (spark.sparkContext.applicationId, name)
        if not spark.catalog.tableExists(name):
            _KNOWN.pop(key, None)
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{_schema_name(bronze_root)}` LOCATION {sql_string_literal(bronze_root)}")
            spark.sql(f"CREATE TABLE {name} ({_ddl(columns.fields)}, year int, month int) USING parquet "
                      f"PARTITIONED BY (year, month) LOCATION {sql_string_literal(f'{bronze_root}/{source}')}")
        else:
            have = set(spark.table(name).columns)
            if new := [f for f in columns.fields if f.name not in have]:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
        known = _KNOWN.setdefault(key, {})
        for (year, month), folder in sorted(current_folders(spark, bronze_root, source).items()):
            if known.get((year, month)) != folder:
                part = f"PARTITION (year = {year}, month = {month})"
                if (year, month) not in known:
                    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION {sql_string_literal(folder)}")
                spark.sql(f"ALTER TABLE {name} {part} SET LOCATION {sql_string_literal(folder)}")
                known[(year, month)] = folder
        spark.catalog.refreshTable(name)
        return name
