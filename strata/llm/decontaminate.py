"""Benchmark decontamination: test n-grams in a broadcast hash set, training windows probed against it.

Benchmark texts are normalised to words and cut into windows of ``WINDOW``
words (a shorter item is one window). The windows, keyed by a 64-bit hash of
all their words, are the broadcast side of a hash join. Each document's places
are hashed the same way inside its row, exploded and probed in the same stage,
and a hash match is verified on the words of the window, so test windows that
begin alike cost no more than others. Only verified hits, and one slim row a
document, are shuffled. If there are more test windows than ``BLOCK_WINDOWS``, or
they have more than ``BLOCK_BYTES``, they are probed in blocks of about that
size, dealt by window and item, so the broadcast stays bounded whatever the
benchmark.

DataFrame functions only; no Python runs on the executors.

Defined results: a null or word-less text has no words, no hits and is not
contaminated. A benchmark row with null or word-less text has no window; one
with a null ``item_id`` still marks hits but is not counted or named. Repeated
documents give one row each; repeated benchmark rows change nothing. Extra
columns of either table are ignored, or kept untouched by the filters.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, fresh, lower_ascii, repeated, settled, split_words, text_key

WINDOW = 13
# Distinct test windows broadcast at a time, and bytes in them.
BLOCK_WINDOWS = 250_000
BLOCK_BYTES = 32 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Key of the row that marks a document's end.
END = 0
# A document is contaminated when at least 1 word in this many is hit.
HIT_SHARE = 20


def words_of(text: Column) -> Column:
    """Words in order, A-Z lower-cased; text beyond ASCII is lower-cased word by word."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, split_words(F.lower(text), SEPARATORS)).otherwise(
        F.transform(split_words(text, SEPARATORS), lower_ascii))


def _hashes(words: Column, length: int) -> Column:
    """For each place in ``words`` a hash of the ``length`` words there.

    ``words`` must be a stored column that the same projection also names
    elsewhere: Spark merges a column named once into the lambda, and would
    cut the text again for each word.
    """
    return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, length)]))


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item, len, hash, gram) over all benchmark texts; ``gram`` is the window's words."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("ws"))
             .select("item", "ws", F.size("ws").alias("n"))
             .where("n > 0")
             .withColumn("len", F.least(F.col("n"), F.lit(window))))
    starts = F.explode(F.sequence(F.lit(1), F.col("n") - F.col("len") + 1))
    cut = (items.select("item", "ws", "len", starts.alias("i"))
           .select("item", "len", F.slice("ws", F.col("i"), F.col("len")).alias("w")))
    whole = F.xxhash64(*[F.get("w", F.lit(k)) for k in range(window)])  # words that a short window lacks add nothing
    return cut.select("item", "len", whole.alias("hash"), F.array_join("w", " ").alias("gram")).distinct()


def _probe(docs: DataFrame, grams: DataFrame, length: int, mark_docs: bool) -> DataFrame:
    """Verified hits (id, key, n_words, start, len, item) of the windows of one length.

    With ``mark_docs`` every document also gives one row that is no hit
    (start and len null), so documents without hits are seen in the same pass.
    """
    hashes = _hashes(F.col("ws"), length)
    end = F.array(F.lit(END).cast("long")) if mark_docs else F.array().cast("array<bigint>")
    # outer: else Spark infers a filter on the array and builds everything under it twice
    places = (docs.select("id", "key", "ws", F.size("ws").alias("n"), F.concat(hashes, end).alias("hashes"))
              .select("id", "key", "ws", "n", F.posexplode_outer("hashes").alias("start", "hash")))
    mine = grams.where(F.col("len") == length).select("hash", "gram", "item")
    if mark_docs:
        mine = mine.union(docs.sparkSession.range(1).select(F.lit(END).cast("long"), F.lit(None).cast("string"),
                                                            F.lit(None).cast("string")))
    is_end = F.col("start") == F.col("n")
    words_here = F.array_join(F.slice("ws", F.col("start") + 1, length), " ")
    # spelled so that Catalyst keeps it a condition of the hash matches and does not make it a join key
    same = F.when(is_end, F.col("gram").isNull()).otherwise(
        F.when(F.length("gram") == F.length(words_here), F.startswith(words_here, F.col("gram"))))
    return (places.join(F.broadcast(mine), "hash").where(same)
            .select("id", "key", F.col("n").alias("n_words"), F.when(~is_end, F.col("start")).alias("start"),
                    F.when(~is_end, F.lit(length)).alias("len"), "item"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per distinct (doc_id, text): id, key, copies, n_words, n_hit, spans, items.

    ``spans`` are the hit windows as (start, len), ordered; ``items`` the
    distinct item ids as strings, ordered; ``copies`` the number of equal rows.
    """
    grams = settled(test_windows(benchmark, window))
    size = F.sum(F.octet_length("gram") + F.coalesce(F.octet_length("item"), F.lit(0)))
    sizes = {r["len"]: max(r["n"] / block_windows, r["size"] / block_bytes)
             for r in grams.groupBy("len").agg(F.count("*").alias("n"), size.alias("size")).collect()}  # at most ``window`` rows
    base = docs.select(F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"),
                       words_of(F.col("text")).alias("ws"))
    parts = []
    for length in sorted(sizes) or [window]:
        blocks = max(1, ceil(sizes.get(length, 0)))
        for b in range(blocks):
            block = grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("hash", "item"), F.lit(blocks)) == b)
            parts.append(_probe(base, block, length, mark_docs=not parts))
    step = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "spans", step,
        lambda acc, s: F.struct(F.greatest(acc["end"], s["start"] + s["len"]).alias("end"),
                                (acc["n"] + F.greatest(F.lit(0), s["start"] + s["len"]
                                                       - F.greatest(acc["end"], s["start"]))).alias("n")),
        lambda acc: acc["n"].cast("long"))
    is_hit = F.col("start").isNotNull()
    return (reduce(DataFrame.unionByName, parts).groupBy("id", "key")
            .agg(F.count(F.when(~is_hit, 1)).alias("copies"), F.max("n_words").cast("long").alias("n_words"),
                 F.sort_array(F.collect_set(F.when(is_hit, F.struct("start", "len")))).alias("spans"),
                 F.sort_array(F.collect_set("item")).alias("items"))
            .select("id", "key", "copies", "n_words", covered.alias("n_hit"), "spans", "items"))


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words"))


def judge(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return repeated(hits(docs, benchmark, **params).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"), "copies"), "copies")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` without its contaminated documents; every other row stays as it is."""
    bad_id, bad_key = fresh(docs, "_bad_id", "_bad_key")
    bad = settled(hits(docs, benchmark, **params).where(_contaminated())
                  .select(F.col("id").alias(bad_id), F.col("key").alias(bad_key)))
    gone = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (text_key(F.col("text")) == F.col(bad_key))
    return docs.join(broadcast_if_small(bad), gone, "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` with hit words, and what follows each up to the next word, cut out of ``text``."""
    hit_id, hit_key, spans, cut_up, left_over = fresh(docs, "_hit_id", "_hit_key", "_spans", "_pieces", "_left")
    found = broadcast_if_small(settled(hits(docs, benchmark, **params).where("n_hit > 0")
                                       .select(F.col("id").alias(hit_id), F.col("key").alias(hit_key),
                                               F.col("spans").alias(spans))))
    on = F.col("doc_id").eqNullSafe(F.col(hit_id)) & (text_key(F.col("text")) == F.col(hit_key))
    # what precedes the first word, then one piece for each word with what follows it
    other = SEPARATORS[:-1]
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"[^{other[1:]}+{other}*"), F.lit(0))
    lead = F.regexp_extract(F.col("text"), f"^{other}*", 0)
    hit_words = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))
    cut = (docs.join(found, on, "left")
           .withColumn(cut_up, F.when(F.col(spans).isNotNull(), pieces))
           .withColumn(left_over, F.array_except(F.sequence(F.lit(0), F.size(cut_up) - 1), hit_words)))
    left = F.concat(lead, F.array_join(F.transform(left_over, lambda i: F.get(F.col(cut_up), i)), ""))
    return cut.select(*[F.when(F.col(spans).isNull(), F.col("text")).otherwise(left).alias(c)
                        if c == "text" else F.col(c) for c in docs.columns])


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(len(ws), 13) AS n, list_slice(ws, i, i + least(len(ws), 13) - 1) AS gram
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM items WHERE len(ws) > 0)),
windows AS (
  SELECT rid, n, i, list_slice(ws, i, i + n - 1) AS gram
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM grams) WHERE len(ws) >= n)),
found AS (SELECT w.rid, w.i, w.n, g.item FROM windows w JOIN grams g ON w.n = g.n AND w.gram = g.gram),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM found)) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.ws) AS contaminated
FROM docs d LEFT JOIN covered c USING (rid) LEFT JOIN named m USING (rid)
"""
