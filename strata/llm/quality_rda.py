"""Quality classifier: regularised quadratic discriminant over transformed text statistics.

Each text gives a fixed vector of statistics (lengths, shares of character
classes, repeated words and lines), each transformed by a root or logarithm so that classes are
closer to normal. The vectors are settled once; training joins them to the labels
and sums counts, values and products by class in Spark, so every labelled training
row counts and the driver sees two rows. The class covariances are shrunk towards
the pooled one by ``SHRINK`` and towards its diagonal by ``DIAGONAL``; their
Cholesky factors are computed once and sent with the tasks. The score is the
logistic of the difference of the Mahalanobis log-densities plus the log prior.

Defined results: null text is scored as empty text, which has a vector like any
other. Without training rows of both classes every score is the share of label 1
(one half without any). Labels that are null or not 0 or 1, and labels without
document, are ignored; a document labelled several times counts as often. Repeated
rows and ids give one row each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import is_held_out, map_batches, settled

SHRINK, DIAGONAL, RIDGE = 0.1, 0.1, 1e-4
THRESHOLD = 0.3
# Log-density differences beyond this are all certain.
CERTAIN = 30.0
FEATURES = ["words", "word_length", "distinct_words", "repeated_lines", "echoes", "line_length", "upper", "digits", "marks",
            "symbols", "bars", "stops", "beyond_ascii"]
_CLASSES = ["upper", "digits", "marks", "symbols", "bars", "stops", "beyond_ascii"]
# Which bytes belong to which class of characters (0: none).
_BYTE_CLASS = np.zeros(256, np.uint8)
for _k, _bytes in enumerate([range(65, 91), range(48, 58), b"!?", b"#*$%&<>@^~=+_\\", b"|", b".,;:", range(0xC0, 0x100)]):
    _BYTE_CLASS[list(_bytes)] = _k + 1


def vector(text: str) -> list[float]:
    """The transformed statistics of one whole text."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, chars = len(words), sum(map(len, words))
    classes = np.bincount(_BYTE_CLASS[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1)[1:]
    return [np.log1p(n), np.log1p(chars / max(n, 1)), len(set(words)) / np.sqrt(max(n, 1)) if n else 0.0,
            np.sqrt(1 - len(set(lines)) / len(lines)) if lines else 0.0,
            np.sqrt(sum(map(eq, words, words[1:])) / max(n, 1)), np.log1p(n / max(len(lines), 1)),
            *np.sqrt(classes / max(chars, 1))]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [vector(t or "") for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(vectors, pa.list_(pa.float64()))],
                                         names=["doc_id", "held_out", "x"])


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, x) of every document."""
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")),
                       _vectors, "doc_id long, held_out boolean, x array<double>")


def fit(stats: DataFrame, labels: DataFrame) -> dict:
    """Prior and, for each class, mean and inverse Cholesky factor."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").alias("y")).where("y in (0, 1)")
    rows = stats.where(~F.col("held_out")).join(known, F.col("doc_id") == F.col("_id")).select("y", "x")
    d = len(FEATURES)
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    x = [F.col("x")[i] for i in range(d)]
    sums = rows.groupBy("y").agg(F.count("*").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(d)],
                                 *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in upper]).collect()  # two rows
    by_class = {r["y"]: r for r in sums}
    total = sum(r["n"] for r in sums)
    share = by_class[1]["n"] / total if 1 in by_class else 0.0
    if len(by_class) < 2:
        return {"share": share if total else 0.5}
    means, scatters = [], []
    for y in (0, 1):
        r = by_class[y]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        product = np.zeros((d, d))
        for i, j in upper:
            product[i, j] = product[j, i] = r[f"p{i}_{j}"]
        means.append(mean)
        scatters.append(product - r["n"] * np.outer(mean, mean))
    pooled = sum(scatters) / total
    factors = []
    for y in (0, 1):
        n = by_class[y]["n"]
        own = (1 - SHRINK) * scatters[y] / n + SHRINK * pooled
        cov = (1 - DIAGONAL) * own + DIAGONAL * np.diag(np.diag(pooled)) + RIDGE * np.eye(d)
        factors.append(np.linalg.inv(np.linalg.cholesky(cov)))
    return {"share": share, "means": means, "factors": factors}


def log_ratio(model: dict, x: np.ndarray) -> np.ndarray:
    """Log of p(1 | x) / p(0 | x) of each row of ``x``."""
    if "means" not in model:
        share = min(max(model["share"], 1e-9), 1 - 1e-9)
        return np.full(len(x), np.log(share / (1 - share)))
    log_density = []
    for mean, factor in zip(model["means"], model["factors"], strict=True):
        z = (x - mean) @ factor.T
        log_density.append(np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(1))
    return log_density[1] - log_density[0] + np.log(model["share"] / (1 - model["share"]))


def score(stats: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, len(FEATURES))
            value = 1 / (1 + np.exp(-np.clip(log_ratio(shared.value, x), -CERTAIN, CERTAIN)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return map_batches(stats, run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled training rows and score every document."""
    stats = settled(statistics(docs))
    return score(stats, fit(stats, labels))
