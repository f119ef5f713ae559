"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics of the whole text (lengths, shares of byte classes, repetition) are transformed towards symmetric
shapes. Class means and covariances come from sums that Spark adds over all labelled training rows. Each class
covariance is shrunk towards the pooled one and both towards its diagonal; the Cholesky factors are computed
once and kept with the model. A score is the logistic of the difference of the two log densities (half the
Mahalanobis distances and log determinants) plus the log of the class shares.

Training rows: labelled, crc32(doc_id) mod 3 is not 1. Labels, lang, source and doc_id are never inputs of a score.

Cases: null text is empty and is scored; null labels are no labels; without rows of both classes
the score is the share of label 1 (one half without labels) with half a row's doubt; a row of labels counts as
often as it is given, and conflicting labels count for both classes; repeated rows are scored alike; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm import words
from waymark.llm.support import crc32_of_id, map_batches, pick, prepare
from waymark.runtime import stage

#: weight of the pooled covariance, and of the diagonal, in a class covariance
TO_POOLED, TO_DIAGONAL = 0.1, 0.1
#: variance added to every statistic
FLOOR = 1e-3

_BYTE = np.arange(256)
_CLASSES = {
    "upper": (_BYTE >= 65) & (_BYTE <= 90),
    "lower": (_BYTE >= 97) & (_BYTE <= 122),
    "beyond": _BYTE >= 128,
    "digit": (_BYTE >= 48) & (_BYTE <= 57),
    "blank": (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)),
    "stop": np.isin(_BYTE, [ord(c) for c in ".,;:'\"()-?"]),
    "shout": _BYTE == ord("!"),
    "line": _BYTE == 10,
}
_SYMBOL = ~np.logical_or.reduce([_CLASSES[c] for c in ("upper", "lower", "beyond", "digit", "blank", "stop", "shout")])
_SHARES = [_CLASSES[c] for c in ("upper", "digit", "blank", "stop", "shout", "line")] + [_SYMBOL]
WIDTH = len(_SHARES) + 6


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _log_share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Logarithm of a share; one half stands for a count of nothing, and short texts say less."""
    return np.log((part + 0.5) / (whole + 20.0))


def statistics(column: pa.Array) -> np.ndarray:
    """(rows, WIDTH) transformed statistics of a text column."""
    data, offsets = words.buffer_of(column)
    made = []
    for first, last in words.chunks(offsets):
        own = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        size = np.diff(own).astype(float)
        hashes, bounds = words.word_hashes(part, own, "blank")
        n = np.diff(bounds).astype(float)
        columns = [np.log1p(size), np.log((size + 1) / (n + 1))]
        columns += [_log_share(_per_row(table[part], own), size) for table in _SHARES]
        distinct, pairs, repeats = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
        doubled = words.gram_hashes(hashes, 2)
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            distinct[i] = len(np.unique(hashes[a:b]))
            pairs[i] = len(np.unique(doubled[a : max(a, b - 1)]))
        letters = _per_row((_CLASSES["upper"] | _CLASSES["lower"] | _CLASSES["beyond"])[part], own)
        columns += [
            _log_share(n - distinct, n),
            _log_share(np.maximum(n - 1, 0) - pairs, n),
            _log_share(size - letters, size),
            _log_share(_ends_alike(part, own, bounds), n),
        ]
        made.append(np.stack(columns, axis=1))
    return np.concatenate(made) if made else np.zeros((0, WIDTH))


def _ends_alike(data: np.ndarray, offsets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of places per row where one and the same byte stands three times in a row."""
    if len(data) < 3:
        return np.zeros(len(offsets) - 1)
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    return _per_row(same, offsets)


@dataclass
class Discriminant:
    """Means, Cholesky factors of the inverse roots and constants of both classes."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.prior)
        density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(constant - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -60, 60)))


def fit(moments: list[tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
    """Model from (rows, sum, sum of outer products) of classes 0 and 1."""
    n = [m[0] for m in moments]
    prior = (n[1] + 0.5) / (n[0] + n[1] + 1)
    if min(n) < 2:
        return Discriminant([], [], [], float(prior))
    means = [s / c for c, s, _ in moments]
    own = [xx / c - np.outer(m, m) for (c, _, xx), m in zip(moments, means, strict=True)]
    pooled = (own[0] * n[0] + own[1] * n[1]) / sum(n)
    factors, constants = [], []
    for c, count in zip(own, n, strict=True):
        # few rows lean on the pooled shape
        toward = max(TO_POOLED, WIDTH / (WIDTH + count))
        shape = (1 - toward) * c + toward * pooled
        shape = (1 - TO_DIAGONAL) * shape + TO_DIAGONAL * np.diag(np.diag(shape)) + FLOOR * np.eye(WIDTH)
        factors.append(np.linalg.cholesky(shape))
        constants.append(float(np.log(count / sum(n)) - np.log(np.diag(factors[-1])).sum()))
    return Discriminant(means, factors, constants, float(prior))


def _statistics_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    x = statistics(batch.column("text"))
    values = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), WIDTH).cast(pa.list_(pa.float64()))
    return pa.record_batch([batch.column("doc_id"), values], names=["doc_id", "x"])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        y = batch.column("quality").to_numpy(zero_copy_only=False)
        for label in (0, 1):
            own = x[y == label]
            total[label] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).reshape(-1)])
    at = np.arange(total.size)
    yield pa.record_batch([pa.array(at), pa.array(total.reshape(-1))], names=["at", "value"])


def train(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """Model from all labelled training rows of (doc_id, x)."""
    known = pick(labels, "doc_id", "quality").where("quality in (0, 1)")
    rows = measured.where(F.pmod(crc32_of_id("doc_id"), F.lit(3)) != 1).join(known, "doc_id")
    sums = rows.select("x", F.col("quality").cast("int").alias("quality")).mapInArrow(_moments, "at long, value double")
    # a fixed number of sums, whatever the number of rows
    found = sums.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH)).reshape(-1)
    total[found["at"].to_numpy()] = found["value"].to_numpy()
    total = total.reshape(2, -1)
    return fit([(t[0], t[1 : 1 + WIDTH], t[1 + WIDTH :].reshape(WIDTH, WIDTH)) for t in total])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    spark = prepare(docs.sparkSession)
    own = pick(docs, "doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    measured = stage(map_batches(own, _statistics_rows, f"doc_id {kind}, x array<double>"), "quality-statistics")
    model = spark.sparkContext.broadcast(train(measured, labels))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        scores = model.value.scores(x)
        return pa.record_batch(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    rows = measured.select("doc_id", (F.pmod(crc32_of_id("doc_id"), F.lit(3)) == 1).alias("held_out"), "x")
    return map_batches(rows, score, f"doc_id {kind}, held_out boolean, score double, predicted int")
