"""Language identification: script ranges narrow candidates, Viterbi over words labels spans.

Training counts, over all training rows, the hashed letter bigrams and trigrams
of each language's words (``BUCKETS`` counters a language, summed by Spark), and
how many letters of each script it has. A word is a run of letters (Unicode
category L). Its candidates are the languages in which its script has a share of
``MIN_SCRIPT_SHARE`` or more, or all if none has it; its score for each is the
log-probability of its n-grams. A switch of language between two words costs
``SWITCH``; the best path (Viterbi) labels every word, and runs of one label are
the spans. The document's language has most of its letters; the score is the
share of letters it has.

``with_limits`` adds to a model how well texts must fit for ``keep``. A text's fit is
the mean log-probability of its n-grams along the best path. Of each language, the fit
that all but ``FIT_QUANTILE`` of all its training rows reach is read from counts by
``FIT_STEP`` (summed by Spark); ``keep`` rejects a text that is ``FIT_MARGIN`` or more below
that of its language, unless words above that have half of its letters, and one that has
most of its letters in scripts no language has.

Texts are worked on in numpy: n-grams of ``PIECE_CHARS`` characters at a time, and
the paths of all documents of a block of ``BLOCK_CHARS`` advanced together. The model has a fixed size
for each language.

Defined results: null text, or text without a letter, is ``und`` with score 0.
If nothing was learned (no training row with a letter) everything is ``und``.
Ties go to the first language by name. Training rows with null language or
text are ignored. Repeated rows and ids give one row each. Extra columns are
ignored by ``identify``; ``keep`` returns them untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import is_held_out, map_batches, slices

BUCKETS = 1 << 15
SWITCH = 12.0
MIN_SCRIPT_SHARE = 0.01
# Characters whose paths are advanced together, and of which n-grams are looked up at a time: these take about 80 bytes each.
BLOCK_CHARS = 3_000_000
PIECE_CHARS = 300_000
# Bytes of texts held as Python strings at a time.
SLICE_BYTES = 3 << 20
UNKNOWN = "und"
# A document stays in a filtered corpus if its main language has this share of its letters.
MIN_SHARE = 0.3
# And if its fit is not this far below that of nearly all training rows of the language. At sf0.01 training rows
# fit with -7.2 to -5.2, texts of other languages and letter junk with -8.7 to -13.4.
FIT_QUANTILE, FIT_MARGIN, FIT_STEP, FIT_BINS = 0.001, 1.5, 0.05, 1000
# Log-score of a word for a language that is no candidate.
_BARRED = -200.0
# First code point of each range, and its script (0: any other).
SCRIPT_RANGES = [
    (0x0000, 1), (0x0250, 1), (0x02B0, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6),
    (0x0700, 0), (0x0750, 6), (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0A80, 10), (0x0B00, 0),
    (0x0B80, 11), (0x0C00, 12), (0x0C80, 13), (0x0D00, 14), (0x0D80, 15), (0x0E00, 16), (0x0E80, 17), (0x0F00, 18),
    (0x1000, 19), (0x10A0, 20), (0x1100, 21), (0x1200, 22), (0x13A0, 0), (0x1780, 23), (0x1800, 24), (0x18B0, 0),
    (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2C80, 0), (0x3040, 25), (0x30A0, 26), (0x3100, 0),
    (0x3400, 27), (0xA000, 0), (0xAC00, 21), (0xD7B0, 0), (0xF900, 27), (0xFB00, 1), (0xFB07, 0), (0x20000, 27),
    (0x30000, 0)]
SCRIPTS = 28
_STARTS = np.array([s for s, _ in SCRIPT_RANGES])
_SCRIPT = np.array([s for _, s in SCRIPT_RANGES], np.int64)
_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter; built once in a worker."""
    if "letters" not in _TABLES:
        table = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            if (ch := chr(c)).isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _TABLES["letters"] = table
    return _TABLES["letters"]


def _scripts() -> np.ndarray:
    """The script of each code point; built once in a worker."""
    if "scripts" not in _TABLES:
        _TABLES["scripts"] = _SCRIPT[np.searchsorted(_STARTS, np.arange(0x110000), "right") - 1].astype(np.int8)
    return _TABLES["scripts"]


def _grams(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, two n-gram buckets for each place, and the letters themselves.

    The n-grams that end at places start..end (end included) are those of a word.
    """
    c = _letters()[code].astype(np.int64)
    inside = c > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    c = np.append(c, 0)  # a border after the last word
    one = np.append(0, c[:-1])
    two = np.where(one > 0, np.append(0, one[:-1]), 0)
    bi = one * 1_000_003 + c
    bucket = lambda h: ((h * 0x9E3779B1) >> 17) & (BUCKETS - 1)
    return edges[::2], edges[1::2], bucket(bi + 0x51ED), bucket(bi + two * 998_244_353 + 0xA3C7), c


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about ``PIECE_CHARS``, cut where no word is."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        stop = start + PIECE_CHARS
        while stop < len(text) and text[stop].isalpha():
            stop += 1
        yield text[start:stop]
        start = stop
    yield text[start:]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _blocks(texts: list[str]) -> Iterator[list[int]]:
    """Indexes of neighbouring texts that make a block together."""
    block, size = [], 0
    for i, text in enumerate(texts):
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append(i)
        size += len(text) + 1
    if block:
        yield block


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n): n-gram counts, and after them letters by script, of each block and language."""
    for batch in batches:
        total: dict[str, np.ndarray] = {}
        for part in slices(batch, 0, SLICE_BYTES):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                counts = total.setdefault(lang, np.zeros(BUCKETS + SCRIPTS, np.int64))
                for block in _blocks(texts):
                    for piece in _pieces("\n".join(texts[i] for i in block)):
                        _, _, bi, tri, c = _grams(_codes(piece))
                        near = (c > 0) | (np.append(0, c[:-1]) > 0)
                        counts[:BUCKETS] += np.bincount(bi[near], minlength=BUCKETS) + np.bincount(tri[near], minlength=BUCKETS)
                        script = _SCRIPT[np.searchsorted(_STARTS, c[c > 0], "right") - 1]
                        counts[BUCKETS:] += np.bincount(script, minlength=SCRIPTS)
        for lang, counts in total.items():
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int64()),
                                              pa.array(counts[slot], pa.int64())], names=["lang", "slot", "n"])


def train(docs: DataFrame) -> dict:
    """Languages, n-gram log-probabilities [language, bucket] and candidates [script, language]."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    counted = map_batches(rows.select(F.col("text").cast("string"), F.col("lang").cast("string")),
                          _counted, "lang string, slot long, n long")
    # at most BUCKETS + SCRIPTS rows a language
    found = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    langs = sorted(set(found["lang"]))
    table = np.zeros((len(langs), BUCKETS + SCRIPTS))
    place = {lang: i for i, lang in enumerate(langs)}
    table[[place[x] for x in found["lang"]], found["slot"]] = found["n"]
    grams, scripts = table[:, :BUCKETS] + 0.5, table[:, BUCKETS:]
    share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
    candidates = (share >= MIN_SCRIPT_SHARE).T
    known = candidates.any(1)
    candidates[~known] = True
    return {"langs": langs, "logs": np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32), "candidates": candidates,
            "known": known}


def _word_scores(model: dict, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and scores [word, language] of the words of one piece."""
    starts, ends, bi, tri, c = _grams(code)
    scores = np.empty((len(starts), len(model["langs"])))
    for k, logs in enumerate(model["logs"]):
        total = np.concatenate(([0.0], np.cumsum(logs[bi] + logs[tri], dtype=np.float64)))
        scores[:, k] = total[ends + 1] - total[starts]
    if len(starts):
        script = _SCRIPT[np.searchsorted(_STARTS, c[starts], "right") - 1]
        scores[~model["candidates"][script]] += _BARRED
    return starts, ends, scores


def _best_paths(scores: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The label of each word; the words of document i are bounds[i]..bounds[i + 1]."""
    labels = np.zeros(len(scores), np.int16)
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    if not len(order) or not scores.shape[1]:
        return labels
    first, sizes = bounds[:-1][order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # documents longer than t
    back = np.empty(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    value = scores[first].copy()
    last = np.empty(len(order), np.int64)
    done = len(order)
    for t in range(1, int(sizes[0]) + 1):
        now = int(active[t]) if t < sizes[0] else 0
        if now < done:  # these end at t - 1
            last[now:done] = value[now:done].argmax(1)
            done = now
            value = value[:now]
        if not now:
            break
        at = first[:now] + t
        top = value.argmax(1)
        bar = (value[np.arange(now), top] - SWITCH)[:, None]
        stay = value >= bar
        back[at] = np.where(stay, own, top[:, None].astype(np.int16))
        value = np.where(stay, value, bar) + scores[at]
    state = last
    for t in range(int(sizes[0]) - 1, -1, -1):
        now = int(active[t])
        at = first[:now] + t
        labels[at] = state[:now]
        if t:
            state[:now] = back[at, state[:now]]
    return labels


def _scored(model: dict, texts: list[str]) -> Iterator[tuple]:
    """Of each text in order: its index, and of its words starts, ends, labels, scores of the labels, letters of unknown scripts."""
    for block in _blocks(texts):
        joined = "\n".join(texts[i] for i in block)
        parts, offset = [], 0
        for piece in _pieces(joined):
            code = _codes(piece)
            s, e, x = _word_scores(model, code)
            unknown = np.concatenate(([0], np.cumsum(~model["known"][_scripts()[code]])))
            parts.append((s + offset, e + offset, x, unknown[e] - unknown[s]))
            offset += len(piece)
        starts, ends, scores, unknown = (np.concatenate([p[k] for p in parts]) for k in range(4))
        begins = np.cumsum([0] + [len(texts[i]) + 1 for i in block])
        bounds = np.searchsorted(starts, begins)
        labels = _best_paths(scores, bounds)
        own = scores[np.arange(len(scores)), labels] if model["langs"] else np.zeros(len(scores))
        for i, text_at, a, b in zip(block, begins.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=False):
            yield i, starts[a:b] - text_at, ends[a:b] - text_at, labels[a:b], own[a:b], unknown[a:b]


def _labelled(model: dict, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text in order: its index, and starts, ends and labels of its words."""
    for found in _scored(model, texts):
        yield found[:4]


def _verdict(langs: list[str], starts, ends, labels) -> tuple[str, float]:
    if not len(starts) or not langs:
        return UNKNOWN, 0.0
    letters = np.bincount(labels, weights=ends - starts, minlength=len(langs))
    best = int(letters.argmax())
    return langs[best], float(letters[best] / letters.sum())


def _fit(starts, ends, own) -> float:
    """Mean log-probability of the n-grams of a text's words: two end at each letter and behind the last."""
    return float(own.sum() / (2 * (ends - starts + 1)).sum())


def with_limits(docs: DataFrame, model: dict) -> dict:
    """``model`` with the least fit of each language, from all its training rows in ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = []
            for part in slices(batch, 0, SLICE_BYTES):
                langs = part.column(1).to_pylist()
                for i, starts, ends, _, own, _ in _scored(model, part.column(0).to_pylist()):
                    if len(starts):
                        found.append((langs[i], min(int(-_fit(starts, ends, own) / FIT_STEP), FIT_BINS)))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.int64())], names=["lang", "bin"])

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    fits = map_batches(rows.select(F.col("text").cast("string"), F.col("lang").cast("string")), run, "lang string, bin long")
    counts = np.zeros((len(model["langs"]), FIT_BINS + 1), np.int64)
    place = {lang: i for i, lang in enumerate(model["langs"])}
    # at most FIT_BINS + 1 rows a language
    for lang, fit_bin, n in fits.groupBy("lang", "bin").agg(F.count("*").alias("n")).collect():
        counts[place[lang], fit_bin] = n
    below = counts.sum(1, keepdims=True) - counts.cumsum(1)  # rows that fit worse than each bin
    reached = (below <= FIT_QUANTILE * counts.sum(1, keepdims=True)).argmax(1)
    return model | {"limits": -(reached + 1) * FIT_STEP - FIT_MARGIN}


def _fits(model: dict, starts, ends, labels, own, unknown) -> bool:
    """Whether a text with words fits its language, if the model tells how well it must."""
    if "limits" not in model:
        return True
    letters = ends - starts
    best = int(np.bincount(labels, weights=letters, minlength=len(model["langs"])).argmax())
    limit = model["limits"][best]
    # a short text with a key or a number in it stays by its other words
    fitting = letters[own / (2 * (letters + 1)) >= limit].sum()
    return 2 * unknown.sum() <= letters.sum() and (_fit(starts, ends, own) >= limit or 2 * fitting >= letters.sum())


def _spans(langs: list[str], starts, ends, labels) -> list[dict]:
    """Runs of one label as (start, end, lang), in characters of the text."""
    if not len(starts) or not langs:
        return []
    first = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
    last = np.append(first[1:], len(labels)) - 1
    return [{"start": int(starts[a]), "end": int(ends[b]), "lang": langs[labels[a]]} for a, b in zip(first, last, strict=True)]


def identify(docs: DataFrame, model: dict, with_spans: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, and the labelled spans if asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in (part for whole in batches for part in slices(whole, 2, SLICE_BYTES)):
            found = [w[1:] for w in _labelled(model, [t or "" for t in batch.column(2).to_pylist()])]
            verdicts = [_verdict(model["langs"], *w) for w in found]
            columns = [*batch.columns[:2], pa.array([v[0] for v in verdicts], pa.string()),
                       pa.array([v[1] for v in verdicts], pa.float64())]
            names = ["doc_id", "held_out", "lang_pred", "score"]
            if with_spans:
                columns.append(pa.array([_spans(model["langs"], *w) for w in found], span))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ("doc_id long, held_out boolean, lang_pred string, score double"
              + ", spans array<struct<start:long,end:long,lang:string>>" * with_spans)
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")), run, schema)


def keep(docs: DataFrame, model: dict, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` in a known language that has at least ``min_share`` of their letters, unchanged.

    A model ``with_limits`` also rejects texts that do not fit their language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in (part for whole in batches for part in slices(whole, place, SLICE_BYTES)):
            kept = []
            for _, *w in _scored(model, [t or "" for t in batch.column(place).to_pylist()]):
                lang, score = _verdict(model["langs"], *w[:3])
                kept.append(bool(lang != UNKNOWN and score >= min_share and _fits(model, *w)))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, run, docs.schema)
