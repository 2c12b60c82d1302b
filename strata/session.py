"""Session helpers: the shared work folder and a local session for tests."""

from __future__ import annotations

import math
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


# Open output files per write task before Spark falls back to sorting by the
# partition columns. A bronze task writes one month and a gold task one or two,
# so no partitioned write of the lake needs the sort (which buffers a whole task).
CONCURRENT_WRITERS = 4


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Lakes and scratch tables live below it, never in a machine-local temp
    folder. Only a local session that names none (as in tests) gets a private
    folder, set as its checkpoint dir; on a cluster that is an error, for
    every executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def concurrently(steps: dict) -> dict:
    """Submit independent Spark jobs from threads so small ones share the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        futures = {name: pool.submit(fn) for name, fn in steps.items()}
        return {name: f.result() for name, f in futures.items()}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused directory below the shared root."""
    return f"{shared_root(spark)}/strata-scratch/{label}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "strata") -> SparkSession:
    """Session for tests and the bench: UTC, AQE on, UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # independent jobs are submitted from threads; FAIR lets them share the cores
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.maxConcurrentOutputFileWriters", str(CONCURRENT_WRITERS))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, cores: int, shuffle_partition_bytes: int = 256 << 20,
                 max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Session settings for building and querying a lake of ``input_bytes`` raw bytes.

    The widest shuffle is the silver dedup: every trip row of the largest
    source, keyed by (vendor, pickup, dropoff). Its partition count is chosen
    so a reduce partition holds about ``shuffle_partition_bytes`` of input
    (it spills beyond executor memory, never fails); at least 3 waves of
    the cluster's cores, at most ``max_shuffle_partitions`` (more map x reduce
    blocks than that cost more in fetch overhead than they save). AQE then
    coalesces the small shuffles of the reports to the advisory size and
    splits skewed partitions of any join.

    ``spark.checkpoint.dir`` is not set here: it names the cluster's shared
    folder and must come from the cluster. The scheduler mode is read at
    start-up, so pass these to the session builder.
    """
    partitions = min(max_shuffle_partitions,
                     max(3 * cores, math.ceil(input_bytes / shuffle_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # scan splits of 256 MB: one raw month file is a few splits, each task one month
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
        # the build submits independent jobs (sources, layers) from threads
        "spark.scheduler.mode": "FAIR",
        "spark.sql.maxConcurrentOutputFileWriters": str(CONCURRENT_WRITERS),
    }
