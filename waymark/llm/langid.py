"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: n-grams of one to three characters of the whole lower-cased text, where every character that is no
letter counts as one and the same blank; hashed to FEATURES numbers. Values: (1 + ln count) * idf, scaled to
unit length; document frequencies are taken over all labelled training rows.

Training: follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties) on a bounded sample of
SAMPLE labelled rows per language, the first by a hash of the row. A softmax temperature is then fitted on a second
sample of CALIBRATION rows per language that training has not seen. Rows with crc32(doc_id) mod 5 = 0 are held
out of all of it. Predictions read nothing but the text.

Cases: null texts and texts without a letter give ``und`` and score 0; so does everything if no row is
labelled; null lang is no label; documents without an id count as held out if crc32 of the empty text says so;
repeated rows are predicted alike; ties go to the first language by code point; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.support import crc32_of_id, pick, prepare
from waymark.runtime import stage

FEATURES = 1 << 16
ORDERS = (1, 2, 3)
#: documents per language that training and calibration may use
SAMPLE, CALIBRATION = 1000, 400
#: parts of a language that find their first draws by themselves
SALTS = 128
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.01
#: a document below this calibrated probability is rejected by ``identified``
LEAST_SCORE = 0.3
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_ids(text: str) -> np.ndarray:
    """Feature numbers of all n-grams of a text that hold a letter, with repetition; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    padded = np.zeros(len(points) + 4, np.uint64)
    padded[2:-2] = np.where(letter, points, 0)
    made = []
    for n in ORDERS:
        total = np.zeros(len(padded) - n + 1, np.uint64)
        some = np.zeros(len(total), bool)
        for j in range(n):
            part = padded[j : j + len(total)]
            total += part * _FACTORS[j]
            some |= part > 0
        total = (total[some] + np.uint64(n)) * np.uint64(0xFF51AFD7ED558CCD)
        made.append(((total ^ (total >> np.uint64(32))) >> np.uint64(16)) & np.uint64(FEATURES - 1))
    return np.concatenate(made).astype(np.int64)


def weighed(ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct features, TF-IDF values of unit length)."""
    counts = np.bincount(ids, minlength=FEATURES)
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    return at, value / np.sqrt((value * value).sum())


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            total[np.unique(gram_ids(text.as_py() or ""))] += 1
            n += 1
    at = np.flatnonzero(total)
    ids = np.concatenate([[-1], at])
    yield pa.record_batch([pa.array(ids), pa.array(np.concatenate([[n], total[at]]))], names=["feature", "n"])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader for a softmax over sparse rows."""

    def __init__(self, classes: int):
        self.z = np.zeros((FEATURES, classes))
        self.n = np.zeros((FEATURES, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        kept = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -kept / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(value @ w)
        error[label] -= 1
        g = value[:, None] * error[None, :]
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, by golden section over its logarithm.

    One more row's worth of doubt is spread over the classes, so separable rows keep a finite temperature.
    """
    doubt = 1 / (len(labels) + 1)
    wanted = np.full(logits.shape, doubt / logits.shape[1])
    wanted[np.arange(len(labels)), labels] += 1 - doubt

    def loss(t: float) -> float:
        return -(wanted * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum(axis=1).mean()

    low, high, golden = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - golden * (high - low), low + golden * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def fit(sample: pd.DataFrame, langs: list[str], idf: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, temperature) from rows (text, lang, calibrates)."""
    label = {x: i for i, x in enumerate(langs)}
    leader = Leader(len(langs))
    rows = [(gram_ids(t or ""), label[x], c) for t, x, c in zip(sample.text, sample.lang, sample.calibrates, strict=True)]
    rows = [(*weighed(ids, idf), y, c) for ids, y, c in rows if len(ids)]
    learn = [r[:3] for r in rows if not r[3]]
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(learn)):
            leader.learn(*learn[i])
    w = leader.weights()
    held = [r for r in rows if r[3]]
    if not held:
        return w, 1.0
    return w, fit_temperature(np.array([v @ w[at] for at, v, _, _ in held]), np.array([r[2] for r in held]))


def drawn_sample(labelled: DataFrame) -> DataFrame:
    """(doc_id, text, lang, calibrates) of at most SAMPLE and CALIBRATION rows per language, the first by a hash.

    ``labelled``: doc_id, text, lang and crc of the id. Rows that are equal count once, rows that share an id each. A
    language is dealt over SALTS tasks before its first draws meet in one.
    """
    part = ["lang", "calibrates"]
    drawn = labelled.select(
        "doc_id", "text", "lang", F.expr("pmod(crc, 5) = 1").alias("calibrates"), F.xxhash64("doc_id", "text", "lang").alias("draw")
    )
    most = F.expr(f"if(calibrates, {CALIBRATION}, {SAMPLE})")

    def leading(rows: DataFrame, keys: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("draw"))
        return rows.withColumn("place", place).where(F.col("place") <= most).drop("place")

    draws = drawn.select(*part, "draw").distinct().withColumn("salt", F.pmod(F.hash("draw"), F.lit(SALTS)))
    chosen = leading(leading(draws, [*part, "salt"]).drop("salt"), part).select("draw")
    return drawn.join(chosen, "draw").dropDuplicates(["draw"]).drop("draw")


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, float] | None:
    """(languages, idf, weights, temperature), or None without labelled rows."""
    spark = docs.sparkSession
    remainder = F.expr("pmod(crc, 5)")
    labelled = docs.withColumn("crc", crc32_of_id("doc_id")).where(remainder != 0).where("lang is not null")
    counts = stage(labelled.select("text").mapInArrow(_document_frequency, "feature long, n long"), "langid-counts")
    # at most FEATURES + 1 rows and one per language: the driver keeps the model's size, not the data's
    table = counts.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    if not langs:
        return None
    df = np.zeros(FEATURES)
    known = table.feature >= 0
    df[table.feature[known]] = table.n[known]
    idf = np.log((1 + table.n[~known].sum()) / (1 + df)) + 1
    sample = stage(drawn_sample(labelled), "langid-sample")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        w, temperature = fit(rows.sort_values(["doc_id", "text", "lang"]), langs, idf)
        at, c = np.nonzero(w)
        return pd.DataFrame(
            {"feature": np.append(at, -1), "lang": np.append(c, -1), "weight": np.append(w[at, c], temperature)}
        )

    # a bounded sample: one task
    fitted = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "feature long, lang long, weight double")
    model = stage(fitted, "langid-model").toPandas()
    weights = np.zeros((FEATURES, len(langs)))
    own = model.feature >= 0
    weights[model.feature[own], model.lang[own]] = model.weight[own]
    return langs, idf, weights, float(model.weight[~own].iloc[0]) if len(model) else 1.0


def predict(text: str | None, model) -> tuple[str, float]:
    """(language, calibrated probability)."""
    if model is None:
        return UNKNOWN, 0.0
    langs, idf, weights, temperature = model
    ids = gram_ids(text or "")
    if not len(ids):
        return UNKNOWN, 0.0
    at, value = weighed(ids, idf)
    p = softmax(value @ weights[at] / temperature)
    best = int(p.argmax())
    return langs[best], float(p[best])


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    spark = prepare(docs.sparkSession)
    own = pick(docs, "doc_id", "text", "lang")
    model = spark.sparkContext.broadcast(train(own))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(t.as_py(), model.value) for t in batch.column("text")]
            yield pa.record_batch(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = own.select("doc_id", (F.pmod(crc32_of_id("doc_id"), F.lit(5)) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told with at least this probability."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(pick(docs, "doc_id", "text", "lang")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            found = [predict(t.as_py(), model.value) for t in batch.column(at)]
            yield batch.filter(pa.array([x != UNKNOWN and s >= least_score for x, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
