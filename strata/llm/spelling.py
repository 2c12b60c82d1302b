"""Spelling variants: words one insertion, deletion or replacement apart, by dense prefix-suffix tiles.

Two words are near if their common prefix and common suffix together reach the
longer length less one. The positions of a word of length L are cut into
``BLOCKS`` stretches; the stretch that holds the first difference lies between a
prefix and a suffix that both words share, so two near words meet in the group
of (L, stretch, prefix, suffix). A word takes part with its own length and, as
the shorter of a pair, with one more. A pair is told only in the group of its
own first difference, thus once.

The words of a group stand in padded code-point matrices, left- and
right-aligned, and block is compared with block: places of the first difference
from the left and from the right. A group of more than ``TILE`` words is split
by hash into blocks, and each pair of blocks is a tile of its own, so no group
meets in one task.

Words and counts come from one pass over the texts, counted in the task before
the shuffle; near pairs are reduced by word. Roots are found by pointer
doubling: a form has at least twice its word's count, so a path is no longer
than the logarithm of the largest count.

Defined results: null and empty texts have no words. A null doc_id counts as an
empty id. Repeated rows count each. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, map_batches, settled

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
# One in so many (document, word) pairs loses a letter, by the query's contract.
DROP_ONE_IN = 97
BLOCKS = 3
TILE = 2048
# Words counted in a task before they are handed on, and bytes of a comparison held at a time.
HELD_WORDS = 100_000
PAIR_BYTES = 1 << 23
# Fixed value: what a word is made of, once A-Z are lower-cased.
_RUNS = re.compile("[a-zÀ-ÿ]+")


def _counted(drop_one_in: int | None, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                               names=["word", "n"])
            total.clear()
            return batch

        get, crc32 = total.get, zlib.crc32
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                # bytes.lower changes A-Z alone
                found = Counter(_RUNS.findall(text.encode().lower().decode()))
                before = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    if len(word) < min_length:
                        continue
                    if drop_one_in and not (h := crc32(word.encode(), before)) % drop_one_in:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    total[word] = get(word, 0) + n
                if len(total) > HELD_WORDS:
                    yield out()
        if total:
            yield out()
    return run


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                drop_one_in: int | None = None) -> DataFrame:
    """(word, n) of all words with at least ``min_length`` code points and ``min_count`` occurrences."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = map_batches(rows, _counted(drop_one_in, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _cut(length: Column, k: int) -> Column:
    """Where stretch ``k`` of a word of this length begins."""
    return F.floor(length * k / BLOCKS).cast("int")


def _groups(words: DataFrame) -> DataFrame:
    """(key, longest, stretch, word, n): the groups of each word."""
    places = []
    for more in (0, 1):
        longest = F.char_length("word") + more
        for k in range(BLOCKS):
            first, rest = _cut(longest, k), longest - _cut(longest, k + 1)
            # a separator that no word has
            key = F.concat_ws(" ", longest.cast("string"), F.lit(str(k)), F.substr(F.col("word"), F.lit(1), first),
                              F.when(rest > 0, F.substr(F.col("word"), F.char_length("word") - rest + 1, rest)).otherwise(""))
            places.append(F.struct(key.alias("key"), longest.cast("int").alias("longest"), F.lit(k).alias("stretch")))
    return words.select(F.explode(F.array(*places)).alias("_p"), "word", "n").select("_p.*", "word", "n")


def _tiles(groups: DataFrame, tile: int) -> DataFrame:
    """A row for each tile: longest, stretch, its two block numbers and its words."""
    sizes = (groups.groupBy("key").agg(F.count("*").alias("_size")).where(F.col("_size") > tile)
             .select(F.col("key").alias("_key"), F.ceil(F.col("_size") / tile).cast("int").alias("_blocks")))
    blocks = F.coalesce(F.col("_blocks"), F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    split = (groups.join(broadcast_if_small(settled(sizes)), F.col("key") == F.col("_key"), "left")
             .select("key", "longest", "stretch", "word", "n", own.alias("own"),
                     F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")))
    return (split.groupBy("key", "longest", "stretch", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
            .agg(F.collect_list(F.struct("word", "n", "own")).alias("words")).where(F.size("words") > 1)
            .select("longest", "stretch", "low", "high", "words"))


def _aligned(words: list[bytes], width: int, right: bool) -> np.ndarray:
    pad = bytes.rjust if right else bytes.ljust
    return np.frombuffer(b"".join([pad(w, width, b"\0") for w in words]), np.uint8).reshape(len(words), width)


def _pairs(sizes: np.ndarray, rows: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row, other) of each given row with all words of its tile, about ``step`` at a time.

    ``sizes`` are the tiles' sizes; rows are numbers of words over all tiles.
    """
    starts = np.cumsum(np.append(0, sizes))
    tile = np.searchsorted(starts, rows, "right") - 1
    many = sizes[tile]
    cut = np.cumsum(many)
    at = 0
    while at < len(rows):
        to = max(int(np.searchsorted(cut, (cut[at - 1] if at else 0) + step, "right")), at + 1)
        n = many[at:to]
        first = np.repeat(rows[at:to], n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield first, np.repeat(starts[tile[at:to]], n) + inner
        at = to


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, near, near_n) in both directions, from tiles."""
    names = ["word", "n", "near", "near_n"]
    for batch in batches:
        longest, stretch, low, high = (batch.column(i).to_numpy() for i in range(4))
        lists = batch.column(4)
        sizes = np.diff(lists.offsets.to_numpy())
        inner = lists.flatten()
        word, n, own = inner.field(0), inner.field(1).to_numpy(), inner.field(2).to_numpy()
        codes = [w.encode("latin-1") for w in word.to_pylist()]  # words have no code point over U+00FF
        length = np.fromiter(map(len, codes), np.int64, len(codes))
        # tiles of one length are compared together
        tile_of = np.repeat(np.arange(len(sizes)), sizes)
        for width in np.unique(longest).tolist():
            chosen = np.flatnonzero(longest[tile_of] == width)
            of = tile_of[chosen]
            mine = [codes[i] for i in chosen.tolist()]
            left, right = _aligned(mine, width, False), _aligned(mine, width, True)
            size, long, block = length[chosen], length[chosen] == width, own[chosen]
            cuts = np.array([width * k // BLOCKS for k in range(1, BLOCKS)])
            firsts, seconds = [], []
            for a, b in _pairs(sizes[np.unique(of)], np.flatnonzero(long), max(PAIR_BYTES // width, 1)):
                t = of[a]
                # each pair of the same length once; in a tile of two blocks only pairs across
                ok = (~long[b] | (a < b)) & ((low[t] == high[t]) | (block[a] != block[b]))
                a, b, t = a[ok], b[ok], t[ok]
                prefix = (left[a] != left[b]).argmax(1)  # two words of a tile differ
                suffix = (right[a] != right[b])[:, ::-1].argmax(1)
                near = (prefix + suffix >= width - 1) & (np.searchsorted(cuts, prefix, "right") == stretch[t])
                firsts.append(a[near])
                seconds.append(b[near])
            first, second = (chosen[np.concatenate(x)] if x else chosen[:0] for x in (firsts, seconds))
            if len(first):
                a, b = np.concatenate((first, second)), np.concatenate((second, first))
                yield pa.RecordBatch.from_arrays([word.take(pa.array(a)), pa.array(n[a]), word.take(pa.array(b)), pa.array(n[b])],
                                                 names=names)


def near_pairs(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n, near, near_n) of all near words, in both directions; ``words`` (word, n) are distinct and settled."""
    return map_batches(_tiles(_groups(words), tile), _compared, "word string, n long, near string, near_n long")


def _roots(links: DataFrame, longest_path: int) -> DataFrame:
    """(word, root) of all words that have a form; each round doubles the forms followed."""
    followed, steps = links.select("word", F.col("form").alias("root")), 1
    while steps < longest_path:
        followed = settled(followed)
        onward = followed.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        followed = (followed.join(onward, F.col("root") == F.col("_at"), "left")
                    .select("word", F.coalesce("_to", "root").alias("root")))
        steps *= 2
    return followed


def group(docs: DataFrame, drop_one_in: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
          ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    The form is the near word of largest n (ties: the smallest in code-point order)
    if that is at least ``ratio`` (over 1) times the word's. ``drop_one_in`` makes variants by the query's contract.
    """
    words = settled(count_words(docs, min_length, min_count, drop_one_in))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near")))
    near = near_pairs(words, tile).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("_best"))
    has = -F.col("_best.minus") >= ratio * F.col("n")
    near = settled(near.select("word", "n_near", F.when(has, F.col("_best.near")).alias("form"),
                               F.when(has, -F.col("_best.minus")).alias("form_n")))
    largest = words.agg(F.max("n")).first()[0] or 1
    path = 1
    while min_count * ratio ** path <= largest:
        path += 1
    roots = _roots(near.where(F.col("form").isNotNull()).select("word", "form"), path)
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
