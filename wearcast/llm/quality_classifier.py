"""Supervised subword embeddings for document quality.

A document is the mean of the vectors of its features: hashed words and hashed character
n-grams (3 to 5 bytes of ``<word>``). A linear layer and softmax on the mean give the
class; vectors and layer are trained together by stochastic gradient descent in numpy.
For scoring, vectors and layer fold into one number per bucket, so a batch needs one
look-up per distinct word feature.

Learnt from: labelled rows whose crc32(doc_id as text) modulo 5 is not 0, at most
``PER_CLASS`` of each class with the smallest id hash (a documented bound); their
gradients are weighted back to the class shares of all such labelled rows.

Defined cases: null and empty texts have no features and score by the bias alone; labels
that are null or not 0/1 are ignored, several labels of one id count each; with no
labelled rows the score is 0.5, with one class only it leans to that class; rows with
null doc_id are scored and never learnt from; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PER_CLASS, BUCKETS, DIM, EPOCHS, RATE, SIZES = 2000, 1 << 18, 16, 6, 0.4, (3, 4, 5)
THRESHOLD = 0.3


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of the distinct words."""
    t = C.Texts(words)
    n = len(t)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    off = t.off + 2 * np.arange(n + 1)
    size = np.diff(off)
    row = np.repeat(np.arange(n), size)
    buf = np.full(off[-1], ord("<"), np.uint64)
    buf[off[1:] - 1] = ord(">")
    inner = np.ones(len(buf), bool)
    inner[off[:-1]] = inner[off[1:] - 1] = False
    buf[inner] = t.data
    buf += np.uint64(1)
    rows, keys = [], []
    with np.errstate(over="ignore"):
        step = np.uint64(1099511628211)
        power = np.cumprod(np.full(int(size.max()), step, np.uint64))
        whole = np.add.reduceat(buf * power[off[1:][row] - 1 - np.arange(len(buf))], off[:-1])
        rows.append(np.arange(n))
        keys.append(whole * np.uint64(0x9E3779B97F4A7C15))
        end = off[1:][row]
        for k in SIZES:
            at = np.flatnonzero(np.arange(len(buf)) + k <= end)
            h = np.zeros(len(at), np.uint64)
            for j in range(k):
                h = h * step + buf[at + j]
            rows.append(row[at])
            keys.append((h + np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9))
        key = np.concatenate(keys)
        return np.concatenate(rows), ((key >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int64)


def _features(batches):
    """Sparse features of training rows: distinct buckets and their shares."""
    for b in C.slices(batches):
        t = C.Texts(C.column(b, "text"))
        words = t.split(C.WS)
        code, distinct = words.codes()
        owner, bucket = word_features(distinct)
        order = np.argsort(owner, kind="stable")
        owner, bucket = owner[order], bucket[order]
        first = np.searchsorted(owner, np.arange(len(distinct) + 1))
        ids, shares = [], []
        for i in range(len(t)):
            mine, times = np.unique(code[words.bounds[i]:words.bounds[i + 1]], return_counts=True)
            at = np.concatenate([np.arange(first[k], first[k + 1]) for k in mine]) if len(mine) else np.zeros(0, np.int64)
            w = np.repeat(times, first[mine + 1] - first[mine]) if len(mine) else np.zeros(0)
            u, inv = np.unique(bucket[at], return_inverse=True)
            share = np.bincount(inv, weights=w, minlength=len(u)) / max(w.sum(), 1)
            ids.append(u.astype("<i4").tobytes())
            shares.append(share.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([C.column(b, "quality").cast(pa.int32()), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], names=["quality", "ids", "shares"])


class Classifier:
    """``fold``: logit share of each bucket; ``bias``: logit without features."""

    def __init__(self, fold: np.ndarray, bias: float):
        self.fold, self.bias = fold, bias

    def score(self, arr: pa.Array) -> np.ndarray:
        t = C.Texts(arr)
        words = t.split(C.WS)
        code, distinct = words.codes()
        owner, bucket = word_features(distinct)
        total = np.bincount(owner, weights=self.fold[bucket], minlength=len(distinct))
        n = np.bincount(owner, minlength=len(distinct))
        logit = np.bincount(words.row, weights=total[code], minlength=len(t)) if len(code) else np.zeros(len(t))
        many = np.bincount(words.row, weights=n[code], minlength=len(t)) if len(code) else np.zeros(len(t))
        return 1 / (1 + np.exp(-np.clip(logit / np.maximum(many, 1) + self.bias, -500, 500)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], weight: dict[int, float], seed: int = 5) -> Classifier:
    """Stochastic gradient descent over (class, buckets, shares) rows."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, EPOCHS * len(rows)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            y, ids, share = rows[i]
            rate = RATE * (1 - done / steps) * weight[y]
            done += 1
            mean = share @ vectors[ids]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ layer
            layer -= rate * np.outer(p, mean)
            bias -= rate * p * 0.1
            vectors[ids] -= (rate * len(ids) * share)[:, None] * back / max(1.0, len(ids) ** 0.5)
    return Classifier((vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Classifier:
    marks = labels.where("quality in (0, 1)").where(C.fold(5) != 0).select("doc_id", F.col("quality").cast("int").alias("quality"))
    count = {r["quality"]: r["count"] for r in marks.groupBy("quality").count().collect()}
    pick = C.stored(C.smallest(marks.distinct(), "quality", "doc_id", per_class), "quality-sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id")  # at most 2 * per_class rows
    got = [(r["quality"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["shares"], "<f4"))
           for r in rows.select("text", "quality").mapInArrow(_features, "quality int, ids binary, shares binary").collect()]
    if not got:
        return Classifier(np.zeros(BUCKETS), 0.0)
    have = pd.Series([y for y, _, _ in got]).value_counts().to_dict()
    total = sum(count.values())
    weight = {y: count[y] / total * len(got) / n for y, n in have.items()}
    return train(got, weight)


def score(docs: DataFrame, model: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (probability of class 1) and predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        for b in C.slices(batches):
            s = sent.value.score(C.column(b, "text"))
            yield pa.RecordBatch.from_arrays([C.column(b, "doc_id").cast(pa.int64()), C.column(b, "held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select("doc_id", "text", F.coalesce(C.fold(5) == 0, F.lit(False)).alias("held_out"))
            .mapInArrow(task, "doc_id long, held_out boolean, score double, predicted int"))


def op10_quality_classifier(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    return score(docs, fit(docs, C.table(spark, sf_dir, "labels")))
