"""Language identification by words first, with a back-off to shorter character n-grams.

Training counts words and character n-grams per language over a bounded sample of
labelled rows (``PER_LANGUAGE`` rows of each language with the smallest id hash, a
documented parameter) as a grouped aggregate; all of them form the model. A known word scores by its
smoothed log frequency in each language. An unseen word takes the mean log frequency of
its longest n-grams of which any is known (4, 3, 2, then 1 characters of ``_word_``).
A text's language is the one with the largest sum over all its words; ``score`` is the
softmax of the mean word score times at most ``SHARPNESS`` words.

Learnt from: rows with a language whose crc32(doc_id as text) modulo 3 is not 1.

Defined cases: null texts and texts without a letter are ``und`` with score 0; ties go to
the alphabetically first language; without labelled rows everything is ``und``; rows with
null doc_id are predicted, never learnt from; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PER_LANGUAGE, LONGEST, SHARPNESS, MEMO = 5000, 4, 20, 300_000
LETTERS = C.byte_table("a-z")
LETTERS[128:] = True


def split_words(arr: pa.Array) -> tuple[C.Texts, C.Runs]:
    """Lower-cased runs of ASCII letters and non-ASCII characters."""
    t = C.Texts(pc.utf8_lower(arr))
    return t, t.split(~LETTERS)


def _counts(batches):
    for b in C.slices(batches):
        t, words = split_words(C.column(b, "text"))
        code, distinct = words.codes()
        langs = C.column(b, "lang").to_pylist()
        names = sorted(set(langs))
        number = np.array([names.index(x) for x in langs])
        key, n = np.unique(number[words.row] * max(len(distinct), 1) + code, return_counts=True)
        total: dict[tuple[str, int, str], int] = {}
        text = distinct.to_pylist()
        for k, m in zip(key.tolist(), n.tolist()):
            lang, w = names[k // len(text)], text[k % len(text)]
            total[lang, 0, w] = total.get((lang, 0, w), 0) + m
            for size in range(1, LONGEST + 1):
                for g in grams(w, size):
                    total[lang, size, g] = total.get((lang, size, g), 0) + m
        if total:
            cols = list(zip(*((a, s, g, m) for (a, s, g), m in total.items())))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                                             names=["lang", "size", "gram", "n"])


def grams(word: str, size: int) -> list[str]:
    w = f"_{word}_" if size > 1 else word
    return [w[i:i + size] for i in range(len(w) - size + 1)]


class Model:
    """Log frequencies per language of known words (size 0) and n-grams (sizes 1 to ``LONGEST``)."""

    def __init__(self, rows: list[tuple[str, int, str, int]]):
        self.langs = sorted({r[0] for r in rows})
        at = {x: i for i, x in enumerate(self.langs)}
        self.tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        counts: list[list[np.ndarray]] = [[] for _ in self.tables]
        for lang, size, gram, n in rows:
            t = self.tables[size]
            if gram not in t:
                t[gram] = len(t)
                counts[size].append(np.zeros(len(self.langs)))
            counts[size][t[gram]][at[lang]] += n
        self.scores = []
        for c in counts:
            m = np.array(c).reshape(len(c), len(self.langs)) if c else np.zeros((0, len(self.langs)))
            self.scores.append(np.log((m + 0.5) / (m.sum(0) + 0.5 * max(len(m), 1))))
        self.memo: dict[str, np.ndarray] = {}

    def word(self, w: str) -> np.ndarray:
        k = self.tables[0].get(w)
        if k is not None:
            return self.scores[0][k]
        out = self.memo.get(w)
        if out is None:
            out = np.zeros(len(self.langs))
            for size in range(LONGEST, 0, -1):
                t = self.tables[size]
                known = [t[g] for g in grams(w, size) if g in t]
                if known:
                    out = self.scores[size][known].mean(0)
                    break
            if len(self.memo) > MEMO:
                self.memo.clear()
            self.memo[w] = out
        return out

    def predict(self, arr: pa.Array) -> tuple[list[str], np.ndarray]:
        t, words = split_words(arr)
        code, distinct = words.codes()
        names, score = np.full(len(t), "und", object), np.zeros(len(t))
        if not self.langs or not len(words):
            return names.tolist(), score
        table = np.array([self.word(w) for w in distinct.to_pylist()])
        total = np.column_stack([np.bincount(words.row, weights=table[code, k], minlength=len(t)) for k in range(len(self.langs))])
        best = total.argmax(1)
        z = total / np.maximum(words.count, 1)[:, None] * np.minimum(words.count, SHARPNESS)[:, None]
        z = np.exp(z - z.max(1, keepdims=True))
        letters = t.per_row(C.byte_table("a-z")[t.data]) > 0
        for i in np.flatnonzero(~letters & (words.count > 0)):
            letters[i] = any(map(str.isalpha, arr[i].as_py()))
        names[letters] = np.array(self.langs, object)[best[letters]]
        score[letters] = (z.max(1) / z.sum(1))[letters]
        return names.tolist(), score


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Model from rows outside fold 1 of 3; a bounded sample per language, counted as a Spark aggregate."""
    rows = docs.select("doc_id", "lang").where((C.fold(3) != 1) & F.col("lang").isNotNull()).distinct()
    pick = C.stored(C.smallest(rows, "lang", "doc_id", per_language), "language-sample")
    text = docs.where((C.fold(3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counted = (text.join(F.broadcast(pick), ["doc_id", "lang"], "left_semi").select("lang", "text")  # at most per_language ids a language
               .mapInArrow(_counts, "lang string, size int, gram string, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")))
    t = counted.toArrow()  # what the bounded sample holds, each word and n-gram once a language
    return Model(sorted(zip(*(t[c].to_pylist() for c in ("lang", "size", "gram", "n")))))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        for b in C.slices(batches):
            names, score = sent.value.predict(C.column(b, "text"))
            yield pa.RecordBatch.from_arrays([C.column(b, "doc_id").cast(pa.int64()), C.column(b, "held_out"), pa.array(names, pa.string()), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select("doc_id", "text", F.coalesce(C.fold(3) == 1, F.lit(False)).alias("held_out"))
            .mapInArrow(task, "doc_id long, held_out boolean, lang_pred string, score double"))


def op7_language_id(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
