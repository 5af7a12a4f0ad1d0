"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: 1- to 3-grams of the lower-cased text in which every run of characters
that are not letters is one space, hashed into ``DIM`` columns; value
``(1 + log count) * idf``, L2-normalised.  Document frequencies cover all
training documents (one pass, summed per column in Spark).  The classifier is
fitted on a bounded sample of labelled rows, at most ``PER_LANG`` documents of
each language, smallest hash first: follow-the-regularised-leader (FTRL-proximal)
with elastic-net penalties.  A fifth of the sample is not fitted but sets the
temperature that minimises its log loss.

Prediction is row-wise over whole texts with the weights (DIM x languages) in a
broadcast.

Defined cases: a text that is null or has no letter gets ``und`` and score 0; a
training row with null lang or text is not learnt from; without any training row
every text is ``und``; ties go to the language that sorts first; repeated rows
are predicted alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, scramble, text_slices

DIM = 1 << 15
ORDERS = (1, 2, 3)
PER_LANG = 1000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(columns, counts) of each text's n-grams; empty if it has no letter."""
    is_letter = letters()
    for text in texts:
        point = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        real = is_letter[point]
        if not real.any():
            yield np.empty(0, np.int64), np.empty(0, np.int64)
            continue
        point = np.where(real, point, np.uint32(32))
        keep = real.copy()
        keep[1:] |= real[:-1]
        c = np.concatenate(([np.uint32(32)], point[keep], [np.uint32(32)][: 1 - int(not real[-1])])).astype(np.uint64)
        ids = [c]
        for _ in ORDERS[1:]:
            ids.append(ids[-1][:-1] * np.uint64(0x1000193) + c[len(ids):])
        flat = np.concatenate([scramble(x + np.uint64(n)) for n, x in enumerate(ids)]) & np.uint64(DIM - 1)
        if len(flat) < DIM // 8:
            yield np.unique(flat.astype(np.int64), return_counts=True)
        else:
            full = np.bincount(flat.astype(np.int64), minlength=DIM)
            at = np.flatnonzero(full)
            yield at, full[at]


def weigh(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(count)) * idf
    return v / np.sqrt(v @ v)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIM x languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        return weigh(count, self.idf[at]) @ self.weights[at] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for at, count in counts([t or "" for t in texts]):
            if not len(at) or not self.langs:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            p = softmax(self.logits(at, count) / self.temperature)
            names.append(self.langs[int(p.argmax())])
            scores.append(float(p.max()))
        return names, scores


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (DIM x k) and bias by FTRL-proximal with L1 and L2 penalties, one row at a time in a fixed order."""
    z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))  # the last row is the bias

    def solve(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    rng = np.random.default_rng(1)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            w, b = solve(z[at], n[at], L1), solve(z[DIM], n[DIM], 0.0)
            miss = softmax(v @ w + b)
            miss[labels[i]] -= 1
            for rows_at, grad, held in ((at, v[:, None] * miss[None, :], w), (DIM, miss, b)):
                grown = n[rows_at] + grad ** 2
                z[rows_at] += grad - (np.sqrt(grown) - np.sqrt(n[rows_at])) / ALPHA * held
                n[rows_at] = grown
    return solve(z[:DIM], n[:DIM], L1), solve(z[DIM], n[DIM], 0.0)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -np.log(p[np.arange(len(labels)), labels] + 1e-12).mean()

    a, b, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        x, y = b - g * (b - a), a + g * (b - a)
        a, b = (a, y) if loss(x) <= loss(y) else (x, b)
    return float(np.exp((a + b) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(DIM, np.int64), 0
    for b in batches:
        for lo, hi in text_slices(b.column("text")):
            for at, _ in counts(b.column("text").slice(lo, hi - lo).to_pylist()):
                total[at] += 1
                docs += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"col": pa.array(np.append(at, -1)), "n": pa.array(np.append(total[at], docs))})


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = list(counts(b.column("text").to_pylist()))
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), pa.array([a.astype(np.int32) for a, _ in got], pa.list_(pa.int32())),
                                          pa.array([c.astype(np.int32) for _, c in got], pa.list_(pa.int32()))], names=["lang", "h", "at", "count"])


def fit(train: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Model learnt from ``train`` (doc_id, text, lang)."""
    bounded_batches(train.sparkSession)
    train = train.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sums = {r["col"]: r["n"] for r in train.select("text").mapInArrow(_frequencies, "col long, n long").groupBy("col").agg(
        F.sum("n").alias("n")).collect()}
    n = sums.pop(-1, 0)
    df = np.zeros(DIM)
    df[list(sums)] = list(sums.values())
    idf = np.log((1 + n) / (1 + df)) + 1
    # sample: rows of each language whose hash lies below its share, then the smallest hashes
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    each = train.groupBy("lang").agg(F.count("*").alias("docs")).select(F.col("lang").alias("of"), "docs")
    some = train.withColumn("h", h).join(F.broadcast(each), F.col("lang") == F.col("of")).where(
        F.col("h") < F.lit(float(1 << 40)) * (F.lit(2.0 * per_lang + 100) / F.col("docs")))
    nth = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    some = some.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= per_lang).select("text", "lang", "h")
    rows = some.mapInArrow(_features, "lang string, h long, at array<int>, count array<int>").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("h", "ascending")])
    langs = sorted(set(rows.column("lang").to_pylist()))
    got, labels = [], []
    for lang, at, count in zip(rows.column("lang").to_pylist(), rows.column("at"), rows.column("count")):
        at, count = at.values.to_numpy(), count.values.to_numpy()
        if len(at):
            got.append((at, weigh(count, idf[at])))
            labels.append(langs.index(lang))
    if not got:
        return Model([], idf, np.zeros((DIM, 0)), np.zeros(0))
    labels = np.array(labels)
    held = np.arange(len(got)) % 5 == 4  # rows of each language are in hash order
    learn = np.flatnonzero(~held)
    weights, bias = ftrl([got[i] for i in learn], labels[learn], len(langs))
    model = Model(langs, idf, weights, bias)
    if held.any() and len(langs) > 1:
        model.temperature = temperature(np.array([got[i][1] @ weights[got[i][0]] + bias for i in np.flatnonzero(held)]), labels[held])
    return model


def predict_column(text: Column, model: Model, spark) -> Column:
    """struct(lang_pred, score) of each text."""
    held = spark.sparkContext.broadcast(model)

    def run(t: pa.Array) -> pa.Array:
        names, scores = [], []
        for lo, hi in text_slices(t):
            a, b = held.value.predict(t.slice(lo, hi - lo).to_pylist())
            names += a
            scores += b
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return F.arrow_udf(run, "struct<lang_pred:string,score:double>")(text)
