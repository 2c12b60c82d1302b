"""Sharding by proportional stratified interleaving.

Rows of each source are ranked in the order of a seeded hash of their id, and
rank r of n rows gets the fraction (r + 1/2) / n. Sorted by fraction, the sources
interleave in proportion, so every stretch of that order, and thus every shard
cut from it, has the corpus mixture. The law is ``rows``: shard sizes differ by
at most one.

No window runs over a whole source or the whole order: rows are range-partitioned
by (source, hash) and later by fraction, numbered inside their partitions, and
shifted by the counts of the partitions before, one row each and source. A source
that holds a third of all rows spreads over partitions like any other. Both range
orders are settled in the shared folder before they are counted, so numbers and
counts agree even if an executor is lost.

Defined results: null text has no bytes (size 1, the crc of nothing). A null
source is a source of its own. Rows repeated with the same id and text are ranked
apart, in any order, and null ids are ranked like an id of their own. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, settled

SHARDS = 16
SEED = "strata"


def _numbered(df: DataFrame, order: list[str], group: list[str]) -> DataFrame:
    """``df`` with ``place``, its rank from 0 inside ``group`` when ordered by ``order`` (which begins with the group)."""
    ranged = settled(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()))
    counts = ranged.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    # a row for each partition and group in it
    before = F.coalesce(F.sum("_n").over(
        Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = settled(counts.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in group],
                                  (before - F.col("_first")).alias("_shift"), F.col("_n").alias("_m")))
    on = F.col("_part") == F.col("_p")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (ranged.join(broadcast_if_small(shift), on)
            .withColumn("place", F.col("_id") + F.col("_shift"))
            .drop("_part", "_id", "_p", "_shift", "_m", *[f"_g_{c}" for c in group]))


def shard(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                       F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")).alias("_shuffle"))
    ranked = _numbered(rows, ["source", "_shuffle", "text_crc32", "size"], ["source"]).drop("_shuffle")
    totals = broadcast_if_small(settled(rows.groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("_all"))))
    placed = ranked.join(totals, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "fraction", (F.col("place") + 0.5) / F.col("_all")).drop("_s", "_all", "place")
    mixed = _numbered(placed, ["fraction", "source", "doc_id", "text_crc32", "size"], [])
    total = docs.count()
    cut = _shard_of(F.col("place"), total, shards)
    return mixed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), cut.cast("int").alias("shard"),
                        (F.col("place") - _first_place(cut, total, shards)).cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))


def _shard_of(place: Column, total: int, shards: int) -> Column:
    """The first ``total % shards`` shards hold one row more than the others."""
    size, more = divmod(total, shards)
    far = F.lit(more * (size + 1))
    inside = F.floor(place / F.lit(size + 1))
    return F.when(place < far, inside).otherwise(more + F.floor((place - far) / F.lit(max(size, 1))))


def _first_place(cut: Column, total: int, shards: int) -> Column:
    size, more = divmod(total, shards)
    return cut * size + F.least(cut, F.lit(more))
