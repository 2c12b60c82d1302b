"""Exact discrete percentiles without gathering a column into one task.

``percentile_disc`` semantics: the value at 1-based rank ``max(1, ceil(p * n))``
of the ascending non-null values, as doubles (NaN is the largest).

Spark's own ``percentile_disc`` merges a value->count map of the whole column
in one final task, and ``percentile_approx`` the sketches of all map tasks. Here
sketches are merged in two levels (``_merged``), every other step is a map-side
combined aggregate, and the one window runs per percentile over a group of
bounded size:

1. one pass counts ``n``, estimates the distinct values (HyperLogLog) and takes
   a KLL sketch, read at ``p -/+ margin`` for every wanted p; the two values
   bracket the wanted rank;
2. while a bracket may hold more than ``max_pairs`` distinct values, a
   narrowing pass counts the rows below and inside it, estimates its distinct
   values and sketches its rows; the bracket shrinks to the cells of a uniform
   grid around the rank (about ``3/grid`` of its rows, plus ties). A bracket
   that does not hold its rank (the sketch was off) is replaced by the part of
   the last good one on the rank's side. Good brackets shrink strictly, so the
   passes end by themselves and every bracket keeps its bound;
3. one pass reduces the rows inside each bracket to (value, count) pairs and
   counts the rows below each bracket by segment (one marker per row, not one
   row per bracket); a hot value collapses to one pair in the partial
   aggregate. A window per bracket, over at most about ``max_pairs`` pairs,
   turns the counts into absolute ranks.

Only scalars, values read from sketches and one value per percentile reach the
driver, never rows. KLL sketches draw random bits: passes may differ from run to
run, results do not.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Size parameter k of the KLL sketches: a rank is off by about 2.3 / k^0.9 of the rows.
DEFAULT_ACCURACY = 4096
# Largest number of distinct values one bracket may hold when it is ranked by a window.
DEFAULT_MAX_PAIRS = 1 << 20
# Cells of the uniform grid that narrows a bracket.
DEFAULT_GRID = 1000
# Groups that the sketches of all map tasks are merged in before the last task merges theirs.
MERGE_GROUPS = 256


def _target_rank(p: float, n: int) -> int:
    return max(1, math.ceil(p * n))


def _clip(q: float) -> float:
    return min(1.0, max(0.0, q))


def exact_percentiles(df: DataFrame, value: Column | str, probs: list[float],
                      accuracy: int = DEFAULT_ACCURACY, max_pairs: int = DEFAULT_MAX_PAIRS,
                      grid: int = DEFAULT_GRID) -> list:
    """Exact ``percentile_disc`` of ``value`` for every p in ``probs`` (None if no rows)."""
    return _percentiles(_values(df, value), probs, accuracy, max_pairs, grid)


def percentile_profile(df: DataFrame, value: Column | str, probs: dict[str, float],
                       summary: dict[str, Callable[[Column], Column]], columns: list[str],
                       accuracy: int = DEFAULT_ACCURACY, max_pairs: int = DEFAULT_MAX_PAIRS,
                       grid: int = DEFAULT_GRID) -> DataFrame:
    """One row: the ``summary`` aggregates and the exact percentiles ``probs``, as ``columns``.

    The percentiles are found first. The summary aggregates (min, max, mean, ...)
    are the job of the returned frame, a plain aggregate over the non-null values.
    """
    vals = _values(df, value)
    found = dict(zip(probs, _percentiles(vals, list(probs.values()), accuracy, max_pairs, grid), strict=True))
    return vals.agg(*[fn(F.col("_x")).alias(name) for name, fn in summary.items()]).select(
        *[F.col(c) if c in summary else F.lit(found[c]).cast("double").alias(c) for c in columns])


def _values(df: DataFrame, value: Column | str) -> DataFrame:
    x = (F.col(value) if isinstance(value, str) else value).cast("double").alias("_x")
    return df.select(x).filter(F.col("_x").isNotNull())


def _sketch_size(accuracy: int) -> int:
    return min(65_535, max(8, accuracy))


def _merged(vals: DataFrame, conditions: list[tuple[Column, Column]], fractions: list[float], k: int) -> DataFrame:
    """One row with, per (below, inside): ``b`` and ``m`` rows, ``d`` distinct values, ``s`` the inside rows at ``fractions``.

    The sketches of map tasks are merged by group of their partition first, so
    what the last task reads does not grow with the number of map tasks. ``s``
    is null if no row is inside but NaN, which KLL sketches leave out.
    """
    parts, wholes, reads = [], [], []
    for i, (below, inside) in enumerate(conditions):
        x = F.when(inside, F.col("_x"))
        parts += [F.count_if(below).alias(f"b{i}"), F.count_if(inside).alias(f"m{i}"),
                  F.hll_sketch_agg(F.when(inside, F.xxhash64("_x"))).alias(f"d{i}"), F.kll_sketch_agg_double(x, k).alias(f"s{i}")]
        wholes += [F.sum(f"b{i}").alias(f"b{i}"), F.sum(f"m{i}").alias(f"m{i}"),
                   F.hll_union_agg(f"d{i}").alias(f"d{i}"), F.kll_merge_agg_double(f"s{i}", k).alias(f"s{i}")]
        at = F.array(*[F.lit(q) for q in fractions])
        reads += [F.coalesce(f"b{i}", F.lit(0)).alias(f"b{i}"), F.coalesce(f"m{i}", F.lit(0)).alias(f"m{i}"),
                  F.hll_sketch_estimate(f"d{i}").alias(f"d{i}"),
                  F.when(F.kll_sketch_get_n_double(f"s{i}") > 0,
                         F.kll_sketch_get_quantile_double(f"s{i}", at)).alias(f"s{i}")]
    grouped = vals.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("_group")).agg(*parts)
    return grouped.agg(*wholes).select(*reads)


def _percentiles(vals: DataFrame, probs: list[float], accuracy: int, max_pairs: int, grid: int) -> list:
    """The exact value of every p in ``probs``."""
    wanted = list(dict.fromkeys(probs))
    k = _sketch_size(accuracy)
    margin = min(1.0, 2.3 / k ** 0.9)
    points = sorted({_clip(q) for p in wanted for q in (p - margin, p + margin)})
    first = _merged(vals, [(F.lit(False), F.lit(True))], points, k).first()
    n = int(first["m0"])
    if n == 0:
        return [None for _ in probs]
    brackets: dict[float, tuple] = {p: (None, None) for p in wanted}
    if first["s0"] is not None:
        sketch = dict(zip(points, first["s0"], strict=True))
        # open below (None) when p - margin reaches the minimum, open above near the maximum
        brackets = {p: (None if p - margin <= 0 else sketch[_clip(p - margin)],
                        None if p + margin >= 1 else sketch[_clip(p + margin)]) for p in wanted}
    small = int(first["d0"] or 0) <= max_pairs
    results: dict[float, object] = {}
    while brackets:
        if not small:
            brackets = _narrow(vals, n, brackets, k, max_pairs, grid)
        found = _resolve(vals, n, brackets)
        results.update({p: v for p, v in found.items() if v is not _MISS})
        brackets = {p: (None, None) for p, v in found.items() if v is _MISS}
    return [results[p] for p in probs]


_MISS = object()


def _in_bracket(lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("_x") >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col("_x") <= F.lit(hi))
    return cond


def _before(x: float | None) -> float | None:
    """The largest double below ``x`` (none below an open bound)."""
    return None if x is None else math.nextafter(x, -math.inf)


def _after(x: float | None) -> float | None:
    """The smallest double above ``x``; above infinity there is only NaN."""
    if x is None:
        return None
    return math.nan if x == math.inf else math.nextafter(x, math.inf)


def _narrow(vals: DataFrame, n: int, brackets: dict[float, tuple], k: int,
            max_pairs: int, grid: int) -> dict[float, tuple]:
    """Shrink every bracket until it holds its rank and at most about ``max_pairs`` distinct values.

    ``good`` is the smallest bracket known to hold a rank, ``todo`` the one to
    be counted next, inside it. Each round is one ``_merged`` pass.
    """
    fractions = [i / grid for i in range(grid + 1)]
    done: dict[float, tuple] = {}
    good: dict[float, tuple] = {p: (None, None) for p in brackets}
    todo = dict(brackets)
    while todo:
        conditions = [((F.col("_x") < F.lit(lo)) if lo is not None else F.lit(False), _in_bracket(lo, hi))
                      for lo, hi in todo.values()]
        stats = _merged(vals, conditions, fractions, k).first()
        nxt = {}
        for i, (p, (lo, hi)) in enumerate(todo.items()):
            below, inside, distinct = int(stats[f"b{i}"]), int(stats[f"m{i}"]), int(stats[f"d{i}"] or 0)
            rank = _target_rank(p, n)
            if rank <= below:
                nxt[p] = good[p] = (good[p][0], _before(lo))
            elif rank > below + inside:
                nxt[p] = good[p] = (_after(hi), good[p][1])
            elif distinct <= max_pairs or (cells := stats[f"s{i}"]) is None or (lo is not None and lo == hi):
                done[p] = (lo, hi)  # few values, nothing but NaN, or one value
            else:
                good[p] = (lo, hi)
                t = (rank - below) / inside
                i_lo, i_hi = max(0, math.floor(t * grid) - 1), min(grid, math.ceil(t * grid) + 1)
                closer = (cells[i_lo] if i_lo > 0 else lo, cells[i_hi] if i_hi < grid else hi)
                # cells as wide as the bracket: its two ends are hot values, next without them
                nxt[p] = closer if closer != (lo, hi) else (_after(cells[0]), _before(cells[grid]))
        todo = nxt
    return done


def _resolve(vals: DataFrame, n: int, brackets: dict[float, tuple]) -> dict[float, object]:
    """One pass: exact ranks inside every bracket.

    A row inside a bracket becomes a (bracket, value) pair; pairs of a hot
    value collapse in the map-side partial aggregate. A row below a bracket
    only has to be counted, so instead of one row per bracket it emits a
    single marker: its segment, the number of bracket lower bounds at or below
    it. After the aggregate, each segment's count (a handful of rows) is
    spread onto the brackets whose lower bound lies above it, as a null-valued
    pair. The running count per bracket, nulls first, is then the absolute rank.
    """
    probs = list(brackets)
    bounds = list(brackets.values())
    los = sorted({lo for lo, _ in bounds if lo is not None})
    seg = sum(((F.col("_x") >= F.lit(v)).cast("int") for v in los), F.lit(0))
    # only rows below some lower bound need counting; their key is negative
    marker = F.when(seg < len(los), -1 - seg)
    members = [F.when(_in_bracket(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(bounds)]
    keyed = (vals.select("_x", F.explode(F.array(marker, *members)).alias("_b"))
             .filter(F.col("_b").isNotNull())
             .select("_b", F.when(F.col("_b") < 0, F.lit(None)).otherwise(F.col("_x")).alias("_x")))
    counts = keyed.groupBy("_b", "_x").agg(F.count(F.lit(1)).alias("c"))
    # segment s lies below bracket i when s < (number of lower bounds <= lo_i)
    reach = [los.index(lo) + 1 if lo is not None else 0 for lo, _ in bounds]
    segment = -1 - F.col("_b")
    targets = F.when(F.col("_b") < 0,
                     F.array(*[F.when(segment < F.lit(r), F.lit(i)) for i, r in enumerate(reach)])
                     ).otherwise(F.array(F.col("_b")))
    pairs = counts.select(F.explode(targets).alias("_b"), "_x", "c").filter(F.col("_b").isNotNull())
    w = Window.partitionBy("_b").orderBy(F.col("_x").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    rank = F.element_at(F.array(*[F.lit(_target_rank(p, n)) for p in probs]), F.col("_b") + 1)
    hits = (pairs.withColumn("_cum", F.sum("c").over(w))
            .filter(F.col("_cum") >= rank)
            .groupBy("_b").agg(F.min_by("_x", "_cum").alias("v"))
            .collect())
    out = {p: _MISS for p in probs}
    for row in hits:
        if row["v"] is not None:        # the rank falls inside the bracket
            out[probs[int(row["_b"])]] = row["v"]
    return out
