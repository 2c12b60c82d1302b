"""The lake: raw -> bronze -> silver -> gold, materialised below the shared root.

Layers hand over through storage, as in a medallion build, so every layer
boundary cuts the lineage and queries read the clustered gold table instead
of re-running ingestion and dedup.

``open_lake`` builds a lake for a table directory once and reuses it: a
manifest stamped with the code fingerprint marks a finished build, so a
changed library rebuilds and an unchanged one does not.
"""

from __future__ import annotations

import hashlib
import os
import re
import threading
import time
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from strata.config import LakeConfig
from strata.operators import bronze, gold, silver, tables
from strata.session import concurrently, shared_root
from strata.sources import raw

_LOCK = threading.Lock()
_LOCK_NAMES = threading.Lock()
_BUILT: dict[tuple[str, str], str] = {}
# Layer schemas by path: inference runs once per layer, not on every read. Layer DataFrames by (application, path):
# a DataFrame keeps its file index, so a partitioned layer's folders are listed
# once, not by every report. Both are cleared whenever a layer is rewritten.
_SCHEMAS: dict[str, object] = {}
_FRAMES: dict[tuple[str, str], DataFrame] = {}


def code_fingerprint() -> str:
    h = hashlib.sha1()
    pkg = Path(__file__).resolve().parent
    for p in sorted(pkg.rglob("*.py")):
        h.update(p.relative_to(pkg).as_posix().encode())
        h.update(p.read_bytes())
    return h.hexdigest()[:16]


@dataclass
class Lake:
    spark: SparkSession
    tables_dir: str | None
    root: str
    cfg: LakeConfig = field(default_factory=LakeConfig)
    # where the publisher's files were landed; by default the lake's own raw folder
    landed_at: str | None = None

    @property
    def raw_root(self) -> str:
        return self.landed_at or f"{self.root}/raw"

    @property
    def bronze_root(self) -> str:
        return f"{self.root}/bronze"

    def silver_path(self, source: str) -> str:
        return f"{self.root}/silver/{source}_trips"

    @property
    def gold_path(self) -> str:
        return f"{self.root}/gold/trips"

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/_manifest"

    # ---- readers -------------------------------------------------------
    def _read(self, path: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, path)
        df = _FRAMES.get(key)
        if df is not None:
            return df
        schema = _SCHEMAS.get(path)
        if schema is None:
            df = self.spark.read.parquet(path)
            _SCHEMAS[path] = df.schema
        else:
            df = self.spark.read.schema(schema).parquet(path)
        _FRAMES[key] = df
        return df

    def bronze(self, source: str) -> DataFrame:
        """All months of a source, typed by its recorded columns."""
        key = (self.spark.sparkContext.applicationId, f"{self.bronze_root}/{source}")
        if key not in _FRAMES:
            _FRAMES[key] = bronze.read_bronze(self.spark, self.bronze_root, source)
        return _FRAMES[key]

    def silver(self, source: str) -> DataFrame:
        return self._read(self.silver_path(source))

    def gold(self) -> DataFrame:
        return self._read(self.gold_path)

    # ---- tables by name (S6, K4, K6-K8) --------------------------------
    def table_names(self, suffix: str | None = None) -> dict[str, str]:
        """The catalog name of silver and gold; by default the schemas carry a mark of this lake's place."""
        if suffix is None:
            suffix = "_" + hashlib.sha1(self.root.encode()).hexdigest()[:10]
        names = {f"silver_{s.name}": f"{self.cfg.silver_schema}{suffix}.{s.name}_trips" for s in self.cfg.trip_sources}
        return {**names, "gold": f"{self.cfg.gold_schema}{suffix}.trips"}

    def register_tables(self, suffix: str | None = None) -> dict[str, str]:
        """Silver and gold as external tables, partitions recovered, with their comments.

        ``suffix=""`` gives the plain names (``gold.trips``); a table of that name elsewhere is not replaced.
        """
        names = self.table_names(suffix)
        for layer, name in names.items():
            path = self.gold_path if layer == "gold" else self.silver_path(layer.removeprefix("silver_"))
            schema = name.split(".")[0]
            tables.create_schemas(self.spark, f"{self.root}/_schemas", schema)
            tables.register_table(self.spark, name, path,
                                  tables.GOLD_TABLE_COMMENT if layer == "gold" else tables.SILVER_TABLE_COMMENT)
        return names

    def by_name(self, layer: str) -> DataFrame:
        """A layer through the catalog; registered anew when the layer was rewritten."""
        key = (self.spark.sparkContext.applicationId, self.root + "/_tables")
        with _LOCK_NAMES:
            if key not in _FRAMES:
                _FRAMES[key] = self.register_tables()
            return self.spark.table(_FRAMES[key][layer])

    def forget_schemas(self) -> None:
        """Drop the cached schemas and DataFrames of this lake's layers (call after a rewrite)."""
        for path in [p for p in _SCHEMAS if p.startswith(self.root + "/")]:
            _SCHEMAS.pop(path, None)
        for key in [k for k in _FRAMES if k[1].startswith(self.root + "/")]:
            _FRAMES.pop(key, None)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.tables_dir.rstrip('/')}/{name}.parquet")

    # ---- build steps ---------------------------------------------------
    def land(self) -> None:
        """Land the fixture as monthly raw files; without a table directory the files are there already."""
        if self.tables_dir is None:
            return
        raw.land_raw(self.spark, self.tables_dir, self.raw_root, self.cfg)

    def ingest_bronze(self) -> dict[str, dict[tuple[int, int], int]]:
        """One partitioned write per source; the sources' jobs run concurrently."""
        self.forget_schemas()
        landed = raw.landed_files(self.spark, self.raw_root)
        return concurrently({s: (lambda s=s: bronze.ingest_source(
            self.spark, self.raw_root, self.bronze_root, s, self.cfg, landed)) for s in self.cfg.sources})

    def build_silver(self) -> dict[str, int]:
        self.forget_schemas()
        return concurrently({spec.name: (lambda spec=spec: silver.build_silver(
            self.spark, self.bronze(spec.name), spec, self.silver_path(spec.name)))
            for spec in self.cfg.trip_sources})

    def build_gold(self) -> dict[str, int]:
        self.forget_schemas()
        specs = self.cfg.trip_sources
        return gold.build_gold([self.silver(s.name) for s in specs], self.gold_path,
                               self.cfg.start, self.cfg.end, tuple(s.name for s in specs))

    def _source_chain(self, source: str, landed: dict[str, set[str]]) -> tuple:
        """Bronze of one source, then its silver table if it reaches silver."""
        months = bronze.ingest_source(self.spark, self.raw_root, self.bronze_root, source,
                                      self.cfg, landed)
        spec = self.cfg.spec(source)
        if spec not in self.cfg.trip_sources:
            return months, None
        return months, silver.build_silver(self.spark, self.bronze(source), spec,
                                           self.silver_path(source))

    def bronze_and_silver(self) -> dict[str, dict]:
        """Each source runs bronze -> silver as its own chain, the chains side by side.

        A silver table needs only its own source's bronze, so a small source
        does not wait for the largest one's ingest before it deduplicates.
        """
        self.forget_schemas()
        landed = raw.landed_files(self.spark, self.raw_root)
        chains = concurrently({s: (lambda s=s: self._source_chain(s, landed)) for s in self.cfg.sources})
        return {"bronze": {s: b for s, (b, _) in chains.items()},
                "silver": {s: n for s, (_, n) in chains.items() if n is not None}}

    def build(self, timings: dict[str, float] | None = None) -> dict:
        """Land, then bronze -> silver per source (side by side), then gold.

        Each step is an idempotent overwrite of its own output.
        """
        self.forget_schemas()
        out = {}
        for name, step in (("land_raw", self.land), ("bronze_silver", self.bronze_and_silver),
                           ("gold", self.build_gold)):
            t0 = time.perf_counter()
            out[name] = step()
            if timings is not None:
                timings[name] = time.perf_counter() - t0
        return out

    # ---- manifest ------------------------------------------------------
    def is_built(self, version: str) -> bool:
        """Whether a finished build of this code version is in place.

        An empty manifest is written first unless one exists (``ignore`` mode
        writes nothing over an existing one), so the read below never fails.
        """
        schema = "version string"
        self.spark.createDataFrame([], schema).write.mode("ignore").json(self.manifest_path)
        rows = self.spark.read.schema(schema).json(self.manifest_path).collect()
        return any(r["version"] == version for r in rows)

    def retract(self) -> None:
        """No finished build is in place: written before a build starts, so one that fails is not taken for done."""
        self.mark_built("building")

    def mark_built(self, version: str) -> None:
        (self.spark.createDataFrame([(version,)], "version string")
         .coalesce(1).write.mode("overwrite").json(self.manifest_path))


# The driver tables a lake is made of.
INPUT_TABLES = ("lineitem", "orders", "events")


def inputs_signature(spark: SparkSession, tables_dir: str) -> str:
    """Changes with the files of the input tables: a listing of their names, sizes and times, no read."""
    context = spark.sparkContext
    files = []
    for table in INPUT_TABLES:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{tables_dir.rstrip('/')}/{table}.parquet")
        for status in path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path):
            files.append(f"{status.getPath()}|{status.getLen()}|{status.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(files)).encode()).hexdigest()[:12]


def lake_root_for(spark: SparkSession, tables_dir: str, version: str,
                  cfg: LakeConfig | None = None) -> str:
    absolute = os.path.abspath(tables_dir) if "://" not in tables_dir else tables_dir
    label = re.sub(r"[^A-Za-z0-9_.-]", "_", absolute.rstrip("/").rsplit("/", 1)[-1]) or "tables"
    digest = hashlib.sha1(f"{absolute}|{version}|{cfg!r}".encode()).hexdigest()[:12]
    return f"{shared_root(spark)}/strata-lake/{label}-{digest}"


def open_lake(spark: SparkSession, tables_dir: str, cfg: LakeConfig | None = None,
              root: str | None = None, rebuild: bool = False) -> Lake:
    """The built lake of ``tables_dir``, built on first use and again when its code or input files change."""
    cfg = cfg or LakeConfig()
    code = code_fingerprint()
    version = f"{code}-{inputs_signature(spark, tables_dir)}"
    lake = Lake(spark, tables_dir, root or lake_root_for(spark, tables_dir, code, cfg), cfg)
    key = (spark.sparkContext.applicationId, lake.root)
    with _LOCK:
        if not rebuild and _BUILT.get(key) == version:
            return lake
        if rebuild or not lake.is_built(version):
            _BUILT.pop(key, None)
            lake.retract()
            lake.build()
            lake.mark_built(version)
        _BUILT[key] = version
    return lake
