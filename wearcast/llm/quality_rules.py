"""Quality rules: rule statistics of every text, an isolation forest on them, and
a threshold calibrated from labelled rows.

1. ``rule_statistics`` counts words, symbols, repeated lines and repeated
   5-word windows of whole texts (one narrow pass, vectorised per Arrow slice).
2. ``fit_forest`` grows ``trees`` isolation trees, each on ``psi`` rows. Isolation
   forests are defined on such subsamples; the rows are the ``trees * psi`` with
   the smallest hash of doc_id, a bound that does not grow with the input.
3. ``calibrate`` scores *all* labelled rows and sets the threshold where accepted
   rows (quality 1) lose at most ``max_loss`` of their number, or higher where the
   separation from rejected rows is best.

Defined cases: null text counts as empty; a text without words fails the base rule
(fewer than 10 words); rows with null or repeated doc_id are judged row by row; an
empty table gives an empty result; without labelled rows of both qualities nothing
beyond the base rule is rejected. Extra columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

TREES, PSI, MAX_LOSS, BINS = 100, 256, 0.005, 2000
SYMBOLS = C.byte_table("#*$%&|<>")
UPPER, LETTER, BANG = C.byte_table("A-Z"), C.byte_table("A-Za-z"), C.byte_table("!?")
NEWLINE = C.byte_table("\n")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs")
SCHEMA = "doc_id long, text_key long, " + ", ".join(f"{c} long" for c in COUNTS)


def repeated_words(row: np.ndarray, code: np.ndarray, n_codes: int, width: int = 5) -> np.ndarray:
    """Mark the words inside a ``width``-word window that occurs twice or more in its row.

    Windows are compared exactly through dense codes; a window can only repeat if
    its leading bigram repeats, so each step keeps the survivors of the last.
    """
    n = len(code)
    hit = np.zeros(n, bool)
    pos = np.flatnonzero(row[width - 1:] == row[:n - width + 1]) if n >= width else np.zeros(0, np.int64)
    if not len(pos):
        return hit
    key, size = row[pos], int(row[-1]) + 1
    for step in range(width):
        if size > (1 << 62) // max(n_codes, 1):
            key, size = C.factor(key)
        key, size = key * n_codes + code[pos + step], size * n_codes
        if step:
            key, size = C.factor(key)
            keep = np.bincount(key, minlength=size)[key] > 1
            pos, key = pos[keep], key[keep]
            if not len(pos):
                return hit
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, pos, 1)
    np.add.at(edge, pos + width, -1)
    return np.cumsum(edge[:-1]) > 0


def _statistics(batches):
    for b in C.slices(batches):
        t = C.Texts(C.column(b, "text"))
        words, lines = t.split(C.WS), t.split(NEWLINE)
        code, distinct = words.codes()
        hit = repeated_words(words.row, code, len(distinct))
        ws = C.WS[t.data]
        solid = np.zeros(len(t.data) + 1, np.int64)
        np.cumsum(~ws, out=solid[1:])
        real = solid[lines.end] > solid[lines.start]  # lines with a word
        line_code, line_kinds = lines.codes()
        key = lines.row[real] * max(len(line_kinds), 1) + line_code[real]
        n_lines = np.bincount(lines.row[real], minlength=len(t))
        kinds = np.bincount(np.unique(key) // max(len(line_kinds), 1), minlength=len(t)) if len(key) else np.zeros(len(t), np.int64)
        out = {
            "n_words": words.count, "word_chars": t.per_row(~ws & ((t.data & 0xC0) != 0x80)), "n_symbols": t.per_row(SYMBOLS[t.data]),
            "n_dup_lines": n_lines - kinds, "n_repeat_words": np.bincount(words.row[hit], minlength=len(t)), "n_lines": n_lines,
            "n_upper": t.per_row(UPPER[t.data]), "n_letters": t.per_row(LETTER[t.data] | (t.data >= 0xC0)), "n_bangs": t.per_row(BANG[t.data]),
        }
        yield pa.RecordBatch.from_arrays(
            [C.column(b, "doc_id").cast(pa.int64()), C.column(b, "text_key"), *(pa.array(out[c].astype(np.int64)) for c in COUNTS)],
            names=["doc_id", "text_key", *COUNTS])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, text_key and the rule counts."""
    return docs.select("doc_id", "text", C.text_key().alias("text_key")).mapInArrow(_statistics, SCHEMA)


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Length-free rates, so that long clean texts are not anomalous for their length."""
    c = {k: np.asarray(v, float) for k, v in counts.items()}
    words, lines, letters = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1), np.maximum(c["n_letters"], 1)
    return np.column_stack([
        np.minimum(c["n_symbols"] / words, 3), c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        np.minimum(c["n_upper"] / letters, 1), np.minimum(c["n_bangs"] / words, 3), np.minimum(c["word_chars"] / words, 30) / 10])


class Forest:
    """Isolation trees as flat arrays; ``score`` is 2 ** (-mean path length / c(psi))."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, psi: int = PSI, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.psi = max(2, min(psi, len(rows)))
        depth = int(np.ceil(np.log2(self.psi)))
        order, self.trees = rng.permutation(len(rows)), []
        for k in range(trees if len(rows) > 1 else 0):
            pick = np.take(order, np.arange(k * self.psi, (k + 1) * self.psi), mode="wrap")
            self.trees.append(self._grow(rows[pick], depth, rng))

    @staticmethod
    def normal(n: int) -> float:
        """Mean path length of an unsuccessful search among ``n`` rows."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, depth: int, rng) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, length = [], [], [], [], []

        def node(x: np.ndarray, d: int) -> int:
            at = len(feature)
            for a in (feature, cut, left, right, length):
                a.append(0)
            low, high = x.min(0), x.max(0)
            open_ = np.flatnonzero(high > low)
            if d >= depth or len(x) < 2 or not len(open_):
                left[at] = right[at] = at
                cut[at], length[at] = np.inf, d + self.normal(len(x))
                return at
            f = int(rng.choice(open_))
            c = rng.uniform(low[f], high[f])
            feature[at], cut[at] = f, c
            left[at], right[at] = node(x[x[:, f] <= c], d + 1), node(x[x[:, f] > c], d + 1)
            return at

        node(rows, 0)
        return tuple(np.array(a) for a in (feature, cut, left, right, length))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.ceil(np.log2(self.psi)))):
                at = np.where(x[np.arange(len(x)), feature[at]] <= cut[at], left[at], right[at])
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / max(self.normal(self.psi), 1e-9))


def fit_forest(stats: DataFrame, trees: int = TREES, psi: int = PSI) -> Forest:
    """Forest on the ``trees * psi`` rows (with words) of smallest id hash, a fixed bound."""
    worded = stats.where(F.col("n_words") > 0).select(F.xxhash64("doc_id", "text_key").alias("h"), *COUNTS)
    # a cut by hash from the row count leaves about twice the rows; only those are sorted and sent
    share = min(1.0, 2.0 * trees * psi / max(1, worded.count()))
    few = worded.where(F.col("h") < F.lit(int(-(1 << 63) + share * ((1 << 64) - 4096)))) if share < 1 else worded
    pick = few.orderBy("h", *COUNTS).limit(trees * psi).toPandas()
    return Forest(features({c: pick[c].to_numpy() for c in COUNTS}), trees, psi)


def with_score(stats: DataFrame, forest: Forest) -> DataFrame:
    model = stats.sparkSession.sparkContext.broadcast(forest)

    def score(batches):
        for b in batches:
            x = features({c: C.column(b, c).to_numpy(zero_copy_only=False) for c in COUNTS})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.value.score(x))], names=[*b.schema.names, "anomaly"])

    return stats.mapInArrow(score, SCHEMA + ", anomaly double")


def calibrate(scored: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """Threshold on the anomaly score from every labelled row that passes the base rule.

    A histogram of at most ``2 * (BINS + 1)`` cells reaches the driver.
    """
    marks = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    cells = (scored.where(~base_failed()).select("doc_id", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
             .join(marks, "doc_id").groupBy("quality", "bin").count().collect())
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for r in cells:
        (good if r["quality"] else bad)[min(r["bin"], BINS)] += r["count"]
    if not good.sum() or not bad.sum():
        return 2.0
    lost, caught = good[::-1].cumsum()[::-1] / good.sum(), bad[::-1].cumsum()[::-1] / bad.sum()
    allowed = np.flatnonzero(lost <= max_loss)
    best = allowed[np.argmax((caught - lost)[allowed])]
    return float(best / BINS)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rule counts, ``base_failed``, ``anomaly`` and ``kept`` for every document row."""
    stats = C.stored(rule_statistics(docs), "rule-stats")
    scored = with_score(stats, fit_forest(stats))
    limit = calibrate(scored, labels)
    bad = F.floor(F.col("anomaly") * BINS) >= F.lit(round(limit * BINS))
    return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~bad)


def op1_quality_rules(spark, sf_dir):
    out = judge(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
