"""Helpers shared by the text operators: tables, keys, bounded broadcasts, stable cuts of lineage."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_root

# Rows and bytes a side may have to be broadcast; both are counted before the hint is given.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
# Rows of one group of copies that a task puts out from one row.
COPIES = 1 << 16

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The ASCII white space of the contracts, and what separates words there.
SPACE = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def release() -> None:
    """Give memory that a task no longer uses back to the system; a reused Python worker would keep it."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux") and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def released(function):
    """``function`` over the batches of a task, with its memory released when the task ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release()
    return run


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the executors once per application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="strata-code-")) / "strata_code.zip"  # Spark serves it from the driver
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return df.mapInArrow(released(function), schema)


def slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of a batch with about ``max_bytes`` of text in a column; a longer text is a slice of its own.

    A batch holds up to 10,000 whole texts; only a slice of it is turned into Python objects at a time.
    """
    text = batch.column(column)
    if not len(batch):
        return
    sizes = np.diff(np.frombuffer(text.buffers()[1], np.int32, len(batch) + 1, text.offset * 4)) if pa.types.is_string(
        text.type) else np.array([len(x or "") for x in text.to_pylist()])
    start = size = 0
    for i, more in enumerate(sizes.tolist()):
        if size and size + more > max_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += more
    yield batch.slice(start)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read by Spark from whatever store the path names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does that by itself, and faster, on pure ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, separators: str) -> Column:
    """The non-empty pieces of ``text`` between runs of ``separators``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def text_key(text: Column) -> Column:
    """A 64-bit key of the whole text; null has its own value."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    Later steps then agree on its rows even if executors are lost, and do not
    recompute what led to it.
    """
    shared_root(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files and broadcasts that no later step can use.

    It removes those whose handles the driver has collected; a driver with a roomy heap
    collects late, and until then the files of every settled step stay on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already settled) with a broadcast hint if its counted rows, and the bytes in them, allow it.

    A larger side is left to a shuffle join, which AQE splits where keys are hot.
    """
    if df.count() > max_rows:
        return df
    wide = [f.name for f in df.schema if f.dataType.typeName() in ("string", "binary", "array", "map", "struct")]
    if wide:
        spelt = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in wide])))
        if (df.agg(F.sum(spelt)).first()[0] or 0) > max_bytes:
            return df
    return F.broadcast(df)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these for helper columns that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def repeated(df: DataFrame, copies: str, chunk: int = COPIES) -> DataFrame:
    """Each row as often as its column ``copies`` says, without that column.

    A row of many copies becomes rows of at most ``chunk`` each, spread over tasks before they are
    multiplied, so no array or task holds all copies of a hot row.
    """
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / chunk).cast("long")))
    parts = df.withColumn("_part", part).withColumn("_row", F.monotonically_increasing_id()).repartition("_row")
    left = F.least(F.lit(chunk).cast("long"), F.col(copies) - F.col("_part") * chunk).cast("int")
    return parts.withColumn("_each", F.explode(F.array_repeat(F.lit(True), left))).drop("_part", "_row", "_each", copies)


def is_held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text is a multiple of 5; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
