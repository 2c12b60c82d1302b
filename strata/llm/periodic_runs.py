"""Periodic runs of words, found by suffix-tree extension of Lyndon roots.

A run is a stretch of words of smallest period q that no neighbour extends. Of
every place, the longest Lyndon word that starts there, in the order of the
symbols and in the reversed order, is a candidate root (next smaller and next
larger suffix); every run has such a root inside. A root is extended right by
the longest common extension of its start and its end, and left by that of the
places before them. Both come from suffix trees (Ukkonen) of the words and of
the reversed words: an Euler tour holds the string depths, and the lowest in the
tour between two leaves, from tables over powers of two, is their common
extension. All queries of a tree are answered together in numpy.

Runs asked for have ``least`` words and ``repeats`` periods (3 at least, so
that every window of ``WINDOW`` words inside comes twice in the text). Before
any tree is built, windows are counted by hash: only stretches of neighbouring
windows that all come twice can hold a run, and no run crosses out of one. The
stretches of a text, with a symbol of their own behind each, are what the trees
hold. This loses no run: a hash that agrees by chance only makes a stretch longer.

One narrow pass over the documents; nothing is shuffled. Memory in a task: a
block of ``BLOCK_BYTES`` of text (a longer text is a block of its own), and the
trees of one text, about 1 kB for each word in its repeated stretches, ``TREE_WORDS``
words at a time where stretches are shorter.

Defined results: null or empty text, and text without words, has no words and
no runs, four nulls, and the digests of nothing. A null doc_id is never
rewritten. Repeated rows and ids give one row each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, slices

LEAST, REPEATS = 24, 3
WINDOW = 8
BLOCK_BYTES = 1 << 20
TREE_WORDS = 100_000
_STEP, _DOC = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def suffix_tree(s: list[int], sigma: int) -> tuple[np.ndarray, np.ndarray]:
    """Ukkonen's tree of ``s``, whose last symbol comes once; symbols are below ``sigma``.

    Returns the string depths along its Euler tour (children in the order of their
    symbols), and for each suffix the place of its leaf in the tour.
    """
    n = len(s)
    start, end, link, go = [0], [0], [0], {}
    node = edge = length = left = 0
    for i, c in enumerate(s):
        left += 1
        waits = 0
        while left:
            if not length:
                edge = i
            key = node * sigma + s[edge]
            child = go.get(key)
            if child is None:
                go[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if waits:
                    link[waits] = node
                    waits = 0
            else:
                begin = start[child]
                size = end[child] - begin
                if length >= size:
                    node, edge, length = child, edge + size, length - size
                    continue
                if s[begin + length] == c:
                    if waits:
                        link[waits] = node
                    length += 1
                    break
                inner = len(start)
                start += (begin, i)
                end += (begin + length, n)
                link += (0, 0)
                start[child] = begin + length
                go[key] = inner
                go[inner * sigma + c] = inner + 1
                go[inner * sigma + s[begin + length]] = child
                if waits:
                    link[waits] = inner
                waits = inner
            left -= 1
            if not node and length:
                length -= 1
                edge = i - left + 1
            else:
                node = link[node]
    del link
    return _euler_tour(n, go, np.array(end) - np.array(start), sigma)


def _euler_tour(n: int, go: dict[int, int], lengths: np.ndarray, sigma: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.fromiter(go.keys(), np.int64, len(go))
    children = np.fromiter(go.values(), np.int64, len(go))
    go.clear()
    order = np.argsort(keys)
    first = np.searchsorted(keys[order] // sigma, np.arange(len(lengths) + 1)).tolist()
    children = children[order].tolist()
    lengths = lengths.tolist()
    tour, leaf_at = [], [0] * n
    stack, depths, node, depth = [], [], 0, 0
    at, stop = first[0], first[1]
    while True:
        tour.append(depth)
        if at < stop:  # down to the next child
            stack.append((at + 1, stop))
            depths.append(depth)
            node = children[at]
            depth += lengths[node]
            at, stop = first[node], first[node + 1]
            if at == stop:
                leaf_at[n - depth] = len(tour)
        else:
            if not stack:
                return np.array(tour, np.int32), np.array(leaf_at, np.int64)
            at, stop = stack.pop()
            depth = depths.pop()


def common_extensions(tour: np.ndarray, leaf_at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefixes of the suffixes ``a`` and ``b`` (different ones): the lowest depths between their leaves."""
    low, high = np.minimum(leaf_at[a], leaf_at[b]), np.maximum(leaf_at[a], leaf_at[b])
    power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(a), np.int64)
    order = np.argsort(power, kind="stable")
    bounds = np.searchsorted(power[order], np.arange(int(power.max(initial=-1)) + 2))
    table = tour
    for k in range(len(bounds) - 1):
        asked = order[bounds[k]:bounds[k + 1]]
        out[asked] = np.minimum(table[low[asked]], table[high[asked] - (1 << k) + 1])
        if k + 2 < len(bounds):
            table = np.minimum(table[:-(1 << k)], table[1 << k:])
    return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of a smaller value, or the end."""
    out, stack = [len(rank)] * len(rank), []
    for i, value in enumerate(rank):
        while stack and rank[stack[-1]] > value:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: np.ndarray, least: int = 2, repeats: int = 2) -> np.ndarray:
    """All runs (start, length, period), by start and period, of at least ``least`` symbols and ``repeats`` periods.

    ``symbols`` are small integers from 0 on.
    """
    n = len(symbols)
    if n < 2:
        return np.empty((0, 3), np.int64)
    last = int(symbols.max()) + 1  # comes once, behind all
    tour, leaf_at = suffix_tree([*symbols.tolist(), last], last + 1)
    rank = np.empty(n + 1, np.int64)
    rank[np.argsort(leaf_at)] = np.arange(n + 1)
    place = np.arange(n + 1)
    left, right = [], []
    for order in (rank, n - rank):  # of both orders
        stop = _next_smaller(order.tolist())
        root = (place < n) & (stop < n)  # one that holds the last symbol comes once
        left.append(place[root])
        right.append(stop[root])
    at, to = np.concatenate(left), np.concatenate(right)
    period = to - at
    length = period + common_extensions(tour, leaf_at, at, to)
    del tour, leaf_at, rank
    # what the extension to the left can add: at most all that is before
    able = at + length >= np.maximum(repeats * period, least)
    at, to, period, length = at[able], to[able], period[able], length[able]
    if not len(at):
        return np.empty((0, 3), np.int64)
    tour, leaf_at = suffix_tree([*symbols[::-1].tolist(), last], last + 1)
    # place i is place n - 1 - i of the reversed; in front of the first there is only its end
    more = common_extensions(tour, leaf_at, n - at, n - to)
    found = np.column_stack((at - more, length + more, period))
    found = found[found[:, 1] >= np.maximum(repeats * period, least)]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def _stretches(symbols: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in a block of texts, of the stretches whose windows all come twice in their text.

    Windows across two texts count as coming once, so no stretch goes on from text to text.
    """
    size = len(symbols) - WINDOW + 1
    if size <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # symbols are spread first: small numbers alone would make like sums
    spread = (symbols.astype(np.uint64) + np.uint64(1)) * _DOC
    spread ^= spread >> np.uint64(31)
    h = np.zeros(size, np.uint64)
    for k in range(WINDOW):
        h = h * _STEP + spread[k:size + k]
    h ^= (doc[:size].astype(np.uint64) + np.uint64(1)) * _DOC
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(size + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    twice[:size] &= doc[:size] == doc[WINDOW - 1:]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], twice)).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2] + WINDOW - 1
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def _packed(pairs: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Stretches that share a tree."""
    group, size = [], 0
    for a, b in pairs:
        if group and size + b - a > TREE_WORDS:
            yield group
            group, size = [], 0
        group.append((a, b))
        size += b - a + 1
    if group:
        yield group


def _text_runs(symbols: np.ndarray, pairs: list[tuple[int, int]], least: int, repeats: int) -> np.ndarray:
    """Runs of one text inside the given stretches of it."""
    found = [np.empty((0, 3), np.int64)]
    for group in _packed(pairs):
        parts, own = np.unique(np.concatenate([symbols[a:b] for a, b in group]), return_inverse=True)
        sizes = np.array([b - a for a, b in group])
        joined = np.empty(len(own) + len(group), np.int64)
        ends = np.cumsum(sizes + 1) - 1
        joined[ends] = len(parts) + np.arange(len(group))  # each border comes once
        inside = np.ones(len(joined), bool)
        inside[ends] = False
        joined[inside] = own
        runs = runs_of(joined, least, repeats)
        which = np.searchsorted(ends, runs[:, 0])
        runs[:, 0] += np.array([a for a, _ in group])[which] - (ends - sizes)[which]
        found.append(runs)
    return np.concatenate(found)


def _rewritten(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where, and with which period, the words of a document repeat by the contract of the query; None: nowhere."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _row(words: list[bytes], runs: np.ndarray) -> tuple:
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    best = (None,) * 4
    kept = words
    listed = runs.tolist()
    if listed:
        drop = np.zeros(len(words) + 1, np.int64)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
        kept = [w for w, d in zip(words, np.cumsum(drop).tolist(), strict=False) if not d]
        top = listed[0]
        for run in listed[1:]:  # by start and period, so that the first of equal ones stays
            if run[1] * top[2] > top[1] * run[2]:
                top = run
        best = (*top, 1000 * top[1] // top[2])
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in listed)
    return len(listed), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()


def _block_rows(doc_ids: list[int | None], texts: list[str | None], least: int, repeats: int, rewrite: bool) -> list[tuple]:
    words, bounds = [], [0]
    for text in texts:
        words += (text or "").encode().split()  # at ASCII white space
        bounds.append(len(words))
    if rewrite:
        for i, doc_id in enumerate(doc_ids):
            first, n = bounds[i], bounds[i + 1] - bounds[i]
            if places := _rewritten(doc_id, n):
                a, p = places
                root = words[first + a:first + a + p]
                words[first + a:first + n] = (root * (-(-(n - a) // p)))[:n - a]
    symbols = np.asarray(pa.array(words, pa.large_binary()).dictionary_encode().indices, np.int64) if words else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    stretches: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(*(x.tolist() for x in _stretches(symbols, doc, least)), strict=True):
        i = int(doc[a])
        stretches.setdefault(i, []).append((a - bounds[i], b - bounds[i]))
    none = np.empty((0, 3), np.int64)
    return [_row(words[bounds[i]:bounds[i + 1]], _text_runs(symbols[bounds[i]:bounds[i + 1]], stretches[i], least, repeats)
                 if i in stretches else none) for i in range(len(texts))]


def detect(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS, rewrite: bool = False) -> DataFrame:
    """One row per document: its runs counted, the most periodic one, and digests of all runs and of the collapsed text.

    ``rewrite`` first makes the documents chosen by the query's contract periodic. ``repeats`` is 3 or more and
    ``least`` 24 or more, which the windows rely on.
    """
    if repeats < 3 or least < 3 * WINDOW:
        raise ValueError(f"runs of fewer than 3 periods or {3 * WINDOW} words can't be told by windows of {WINDOW} words")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in slices(batch, 1, BLOCK_BYTES):
                rows = _block_rows(block.column(0).to_pylist(), block.column(1).to_pylist(), least, repeats, rewrite)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([block.column(0), *columns], names=names)

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                       "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                       "runs_sha256 string, collapsed_sha256 string")
