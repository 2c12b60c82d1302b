"""Quality rules with adaptive thresholds per language and source.

Fixed rules (at least ``MIN_WORDS`` words, at most half of the words in
repeated 3-word windows) fail a document outright. The other thresholds are
learned: every feature is an integer per-mille share, and its distribution in
each (lang, source) group is held as an equi-width quantile sketch, that is
one count per share value, at most 1001 counters a group and feature. Counts
of two sketches add up, so map tasks combine them before the shuffle and the
group sketches merge into language sketches and one corpus sketch without
another look at the text. The sketch resolves a quantile to one per mille and
is the same in every run. A document fails a feature above
``Q3 + FENCE * spread`` of its group. The spread is read from the sketch: the
larger of ``Q3 - Q1`` and the distance from Q3 to the quantile at ``UPPER`` of 8,
which junk does not move while it is under an eighth of the group; it is at
least what one line (or word) is in the group's median document, by a sketch of
their numbers, and at least ``LEAST`` per mille. Groups of fewer than ``MIN_GROUP``
documents use their language's sketch, and small languages the corpus sketch.

``FENCE`` and ``LEAST`` were chosen on the labelled rows of the sf0.1 table that pass
the base rules: good ones have up to 45 per mille capitals, 31 of words without
a letter and no symbols; bad ones from 100 on.

DataFrame functions only; no Python runs on the executors. A 3-word window is
compared by a 64-bit hash of its words.

Defined results: null text counts as empty, so it has no words and fails the
base rules. Null ``lang`` or ``source`` form groups of their own. Only
documents that pass the base rules are counted in the sketches. Repeated rows
give one row each. Extra columns are ignored by ``judge``; ``keep`` returns
them untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SPACE, broadcast_if_small, settled, split_words

MIN_WORDS = 50
MIN_GROUP = 200
FENCE = 6
LEAST = 5
UPPER = 7
# per-mille features: (numerator, denominator, sketch of one unit) over the base columns.
FEATURES = {"symbol_pm": ("n_symbols", "word_chars", None), "bare_pm": ("n_bare", "n_words", "word_unit"),
            "dup_line_pm": ("n_dup_lines", "n_lines", "line_unit"), "upper_pm": ("n_upper", "word_chars", None),
            "mark_pm": ("n_marks", "word_chars", None)}
# What one unit is of a document, in per mille.
UNITS = {"word_unit": "n_words", "line_unit": "n_lines"}


def _window_hashes(words: Column) -> Column:
    """A hash of each 3-word window of the stored column ``words``.

    The column is named outside the lambda too; else Spark would merge it into
    the lambda and cut the text again for each word.
    """
    each = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, F.slice(each, 1, F.greatest(F.size(words) - 2, F.lit(1))))


def light_stats(docs: DataFrame, *carry: str) -> DataFrame:
    """Counts that need no window: the base of the adaptive features."""
    own = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    text = F.coalesce(F.col("text"), F.lit(""))
    with_word = lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))
    cut = docs.select(*own, split_words(F.col("text"), SPACE).alias("_w"),
                      F.filter(F.split(text, "\n"), with_word).alias("_l"),
                      # one pass over the text leaves the few characters that are counted below
                      F.regexp_replace(text, r"[^\p{Lu}#*$%&|<>!?]+", "").alias("_m"))
    count = lambda pattern: F.char_length(F.regexp_replace("_m", pattern, "")).cast("long")
    return cut.select(
        *[F.col(f"_c{i}") for i in range(len(carry))], "_w",
        F.size("_w").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        count(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        count(r"[^\p{Lu}]+").alias("n_upper"),
        count(r"[^!?]+").alias("n_marks"),
        F.size(F.filter("_w", lambda w: ~F.regexp_like(w, F.lit(r"[\p{L}\p{N}]")))).cast("long").alias("n_bare"))


def full_stats(docs: DataFrame, *carry: str) -> DataFrame:
    """``light_stats`` plus ``n_repeat_words`` and ``base_failed``."""
    light = light_stats(docs, *carry)
    hashed = light.withColumn("_g", _window_hashes(F.col("_w"))).drop("_w")
    # windows sorted with their place: equal ones are neighbours
    placed = F.when(F.size("_g") > F.size(F.array_distinct("_g")), F.sort_array(
        F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    is_repeat = lambda x, j: ((j > 0) & (F.get(F.col("_p"), j - 1)["g"] == x["g"])) | (
        F.get(F.col("_p"), j + 1)["g"] == x["g"])
    repeated = F.transform(F.filter("_p", lambda x, j: F.coalesce(is_repeat(x, j), F.lit(False))), lambda x: x["i"])
    words_in = F.size(F.array_distinct(F.concat(
        F.col("_r"), F.transform("_r", lambda i: i + 1), F.transform("_r", lambda i: i + 2))))
    counted = hashed.withColumn("_p", placed).drop("_g").withColumn("_r", repeated).drop("_p").withColumn(
        "n_repeat_words", F.when(F.col("_r").isNull(), 0).otherwise(words_in).cast("long")).drop("_r")
    return (counted.withColumn("n_words", F.col("n_words").cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def _per_mille(feature: str) -> Column:
    part, whole, _ = FEATURES[feature]
    return F.when(F.col(whole) > 0, F.expr(f"({part} * 1000) div {whole}")).otherwise(F.lit(0).cast("long"))


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, feature, share, n): the group sketches, of features and units, of rows that pass the base rules."""
    unit = lambda whole: F.when(F.col(whole) > 0, F.expr(f"1000 div {whole}")).otherwise(F.lit(0).cast("long"))
    # not a plain filter: Spark would push it below the counts and evaluate them twice
    shares = F.array(*[F.struct(F.lit(f).alias("feature"), F.least(_per_mille(f), F.lit(1000)).alias("share")) for f in FEATURES],
                     *[F.struct(F.lit(u).alias("feature"), unit(whole).alias("share")) for u, whole in UNITS.items()])
    long = (stats.select("lang", "source", F.explode_outer(F.when(~F.col("base_failed"), shares)).alias("x"))
            .where(F.col("x").isNotNull()).select("lang", "source", "x.*"))
    return long.groupBy("lang", "source", "feature", "share").agg(F.count("*").alias("n"))


def _limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Upper fence and size of each sketch; a window runs over at most 1001 counters."""
    order = Window.partitionBy(*keys, "feature").orderBy("share")
    ranked = sketch.groupBy(*keys, "feature", "share").agg(F.sum("n").alias("n")).select(
        *keys, "feature", "share", F.sum("n").over(order).alias("upto"),
        F.sum("n").over(Window.partitionBy(*keys, "feature")).alias("total"))
    quantile = lambda q: F.min(F.when(F.col("upto") * 8 >= F.col("total") * q, F.col("share")))
    found = ranked.groupBy(*keys, "feature").agg(
        quantile(2).alias("q1"), quantile(4).alias("median"), quantile(6).alias("q3"), quantile(UPPER).alias("upper"),
        F.max("total").alias("total"))
    group = Window.partitionBy(*(keys or [F.lit(0)]))  # a row for each feature
    least = F.lit(LEAST).cast("long")
    for f, (_, _, unit) in FEATURES.items():
        if unit:
            own = F.max(F.when(F.col("feature") == unit, F.col("median"))).over(group)
            least = F.when(F.col("feature") == f, F.greatest(F.lit(LEAST), own)).otherwise(least)
    spread = F.greatest(F.col("q3") - F.col("q1"), F.col("upper") - F.col("q3"), least)
    return found.select(*keys, "feature", (F.col("q3") + FENCE * spread).alias("limit"), "total")


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the fence of every feature, from the finest large enough sketch."""
    source, lang = _limits(sketch, ["lang", "source"]), _limits(sketch, ["lang"])
    corpus = _limits(sketch, [])
    lang = lang.select(F.col("lang").alias("_lang"), F.col("feature").alias("_f"),
                       F.col("limit").alias("_limit"), F.col("total").alias("_total"))
    corpus = corpus.select(F.col("feature").alias("_g"), F.col("limit").alias("_all"))
    best = F.when(F.col("total") >= MIN_GROUP, F.col("limit")).when(
        F.col("_total") >= MIN_GROUP, F.col("_limit")).otherwise(F.col("_all"))
    return (source.join(lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("feature") == F.col("_f")))
            .join(corpus, F.col("feature") == F.col("_g"))
            .groupBy("lang", "source")
            .agg(*[F.max(F.when(F.col("feature") == f, best)).alias(f"max_{f}") for f in FEATURES]))


def _judged(stats: DataFrame, limits: DataFrame) -> DataFrame:
    side = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    over = F.lit(False)
    for f in FEATURES:
        over = over | F.coalesce(_per_mille(f) > F.col(f"max_{f}"), F.lit(False))
    return stats.join(side, on, "left").withColumn("kept", ~F.col("base_failed") & ~over)


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, the base counts, base_failed, kept."""
    stats = settled(full_stats(docs, "doc_id", "lang", "source")
                    .withColumnsRenamed({"_c0": "doc_id", "_c1": "lang", "_c2": "source"}))
    limits = broadcast_if_small(settled(thresholds(settled(sketches(stats)))))
    return _judged(stats, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                         "n_repeat_words", "base_failed", "kept")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged.

    The counts are built again beside the text instead of joining the text to
    them, so no text is shuffled.
    """
    stats = full_stats(docs, "lang", "source").withColumnsRenamed({"_c0": "lang", "_c1": "source"})
    limits = broadcast_if_small(settled(thresholds(settled(sketches(stats)))))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", "lang", "source")
    again = full_stats(packed, "row", "lang", "source").withColumnsRenamed(
        {"_c0": "row", "_c1": "lang", "_c2": "source"})
    # not a plain filter: Spark would push it below the counts and evaluate them twice
    return (_judged(again, limits)
            .select(F.explode_outer(F.when(F.col("kept"), F.array("row"))).alias("row"))
            .where(F.col("row").isNotNull()).select("row.*"))


ORACLE_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
grams AS (SELECT rid, i, list_slice(ws, i, i + 2) AS g
          FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM cut WHERE len(ws) >= 3)),
again AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
stats AS (
  SELECT c.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
         length(t) - length(translate(t, '!?', '')) AS n_marks,
         len(list_filter(ws, lambda w: NOT regexp_matches(w, '[\p{L}\p{N}]'))) AS n_bare,
         CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words
  FROM cut c LEFT JOIN covered v USING (rid)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                 CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS f1,
                 CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS f2,
                 CASE WHEN word_chars > 0 THEN n_upper * 1000 // word_chars ELSE 0 END AS f3,
                 CASE WHEN word_chars > 0 THEN n_marks * 1000 // word_chars ELSE 0 END AS f4,
                 CASE WHEN n_words > 0 THEN n_bare * 1000 // n_words ELSE 0 END AS f5
          FROM stats),
long AS (SELECT lang, source, unnest([1, 2, 3, 4, 5, 6, 7]) AS feature,
                least(unnest([f1, f2, f3, f4, f5, CASE WHEN n_words > 0 THEN 1000 // n_words ELSE 0 END,
                              CASE WHEN n_lines > 0 THEN 1000 // n_lines ELSE 0 END]), 1000) AS share FROM based WHERE NOT base_failed),
read AS (
  SELECT grouping(lang, source) AS level, lang, source, feature, count(*) AS total, quantile_disc(share, 0.25) AS q1,
         quantile_disc(share, 0.5) AS med, quantile_disc(share, 0.75) AS q3, quantile_disc(share, 0.875) AS up
  FROM long GROUP BY GROUPING SETS ((lang, source, feature), (lang, feature), (feature))),
fences AS (
  SELECT level, lang, source, feature, total, q3 + 6 * greatest(q3 - q1, up - q3, 5, CASE feature
           WHEN 2 THEN max(CASE WHEN feature = 7 THEN med END) OVER (PARTITION BY level, lang, source)
           WHEN 5 THEN max(CASE WHEN feature = 6 THEN med END) OVER (PARTITION BY level, lang, source) ELSE 0 END) AS fence
  FROM read),
best AS (
  SELECT s.lang, s.source, s.feature,
         CASE WHEN s.total >= 200 THEN s.fence WHEN l.total >= 200 THEN l.fence ELSE a.fence END AS fence
  FROM (SELECT * FROM fences WHERE level = 0) s
  JOIN (SELECT * FROM fences WHERE level = 1) l ON s.lang IS NOT DISTINCT FROM l.lang AND s.feature = l.feature
  JOIN (SELECT * FROM fences WHERE level = 3) a ON s.feature = a.feature),
wide AS (SELECT lang, source, max(fence) FILTER (feature = 1) AS m1, max(fence) FILTER (feature = 2) AS m2,
                max(fence) FILTER (feature = 3) AS m3, max(fence) FILTER (feature = 4) AS m4,
                max(fence) FILTER (feature = 5) AS m5
         FROM best GROUP BY lang, source)
SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
       NOT b.base_failed AND NOT (coalesce(f1 > m1, FALSE) OR coalesce(f2 > m2, FALSE)
                                  OR coalesce(f3 > m3, FALSE) OR coalesce(f4 > m4, FALSE)
                                  OR coalesce(f5 > m5, FALSE)) AS kept
FROM based b LEFT JOIN wide w ON b.lang IS NOT DISTINCT FROM w.lang AND b.source IS NOT DISTINCT FROM w.source
"""
