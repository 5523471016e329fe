"""Phrase collocations per language: frequent n-grams by mergeable Misra-Gries summaries, counted exactly and scored.

* First pass. The n-grams (single words included) of a slice of texts are hashed to 64 bits and
  dealt to hash partitions by their high bits; a slice's summary of a partition is the list of
  its n-grams with counts. Summaries of one partition are merged by adding counts; if more than
  the capacity remain, the largest count beyond it is taken from all and what falls to zero goes.
  The capacity exceeds the partition's mass (occurrences) divided by the threshold, so the error
  stays below the threshold and every n-gram that reaches it survives. The number of partitions
  follows the bytes of text, so a merge holds a bounded mass.
* Survivors mark bits of a bitmap of fixed size (``BITS``), which is all that is broadcast.
* Second pass. Only n-grams whose bit is set are written out, as words, and counted exactly by a
  Spark aggregate; hash collisions and full bitmaps let more n-grams through, never fewer.
* Scores, the sub-phrase rule and the ranks are joins and aggregates on the counted table; cut
  parts that very many candidates share are joined by broadcast (``graph.hot_join``), and a
  language's candidates are ranked by salt first.

Defined cases: null texts are empty; null languages are ``und``; ties of a score are ordered by
count and phrase; an empty table gives no rows; rows that repeat count again; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import graph
from .jaccard_join import _mix, word_hash

WORDS, LEAST, COVERED, TOP = 3, 10, 50, 2000
#: Bitmap of survivors: 2^27 bits are 16 MB.
BITS = 27
#: Occurrences of n-grams that a hash partition should hold, and text bytes of a slice.
MASS, SLICE = 1 << 21, 5 << 19
#: Candidates of one language that are ranked in one task, in multiples of the ranks asked for.
RANKED = 8
PIECE_END = C.byte_table("\n-\r.,;:!?")
BLANK = PIECE_END | C.byte_table(" \t")


class Grams:
    """Words of a slice in order, with the n-grams that start at each of them."""

    def __init__(self, batch: pa.RecordBatch, words: int):
        t = C.Texts(C.column(batch, "text"))
        low = C.LOWER[t.data]
        runs = t.split(BLANK, low)
        self.langs = C.column(batch, "lang").fill_null("und").dictionary_encode()
        self.lang = self.langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[runs.row]
        self.code, self.distinct = runs.codes()
        self.n = len(self.code)
        piece = np.cumsum(PIECE_END[low])[runs.start] if self.n else np.zeros(0, np.int64)
        joined = (runs.row[1:] == runs.row[:-1]) & (piece[1:] == piece[:-1]) if self.n else np.zeros(0, bool)
        #: whole[k]: words at which an n-gram of k + 1 words starts
        self.whole = [np.ones(self.n, bool)]
        for k in range(1, words):
            on = np.zeros(self.n, bool)
            if self.n > k:
                on[:self.n - k] = self.whole[-1][:self.n - k] & joined[k - 1:]
            self.whole.append(on)

    def hashes(self) -> list[np.ndarray]:
        """Hash of the n-gram of k + 1 words at each word (only those at ``whole[k]`` count)."""
        word = word_hash(C.Texts(self.distinct))[self.code] if self.n else np.zeros(0, np.uint64)
        tongue = word_hash(C.Texts(pc.binary_join_element_wise("l", self.langs.dictionary, "")))[self.lang] if self.n else word
        out = []
        with np.errstate(over="ignore"):
            gram = _mix(word + tongue, 31)
            for k in range(len(self.whole)):
                if k:
                    gram = gram.copy()
                    gram[:self.n - k] = _mix(gram[:self.n - k] + word[k:], 31 + k)
                out.append(gram)
        return out

    def counted(self, marked: list[np.ndarray]) -> pa.RecordBatch:
        """lang, phrase, words, n of the distinct n-grams at the marked words, by words and not by hash."""
        size = max(1, len(self.distinct))
        tables = []
        ident = np.zeros(self.n, np.int64)
        for k, mark in enumerate(marked):
            # dense identity of the first k + 1 words and the language, so the products stay small
            step = (self.lang if k == 0 else ident) * size
            step[:self.n - k] += self.code[k:]
            ident, _ = C.factor(step)
            at = np.flatnonzero(mark & self.whole[k])
            _, first, n = np.unique(ident[at], return_index=True, return_counts=True)
            at = at[first]
            words = [self.distinct.take(pa.array(self.code[at + j])) for j in range(k + 1)]
            phrase = pc.binary_join_element_wise(*words, " ") if k else words[0]
            tables.append(pa.table({"lang": self.langs.dictionary.take(pa.array(self.lang[at])), "phrase": phrase.cast(pa.string()),
                                    "words": pa.array(np.full(len(at), k + 1, np.int32)), "n": pa.array(n.astype(np.int64))}))
        per = np.bincount(self.lang, minlength=len(self.langs.dictionary))
        tables.append(pa.table({"lang": self.langs.dictionary, "phrase": pa.array([""] * len(per), pa.string()),
                                "words": pa.array(np.zeros(len(per), np.int32)), "n": pa.array(per.astype(np.int64))}))
        return pa.concat_tables(tables).combine_chunks().to_batches()


def merge(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries merge of summaries laid end to end: at most ``capacity`` keys stay.

    The third result is what every count has lost, at most mass / (capacity + 1).
    """
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    lost = 0
    if len(keys) > capacity:
        lost = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
        counts = counts - lost
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts, lost


def summaries(docs: DataFrame, words: int, shift: int) -> DataFrame:
    """part, keys, counts: one summary per slice of texts and hash partition (2^shift of them), keys cut to 32 bits."""

    def task(batches):
        for b in C.slices(batches, limit=SLICE):
            g = Grams(b, words)
            keys, counts = np.unique(np.concatenate([h[w] for h, w in zip(g.hashes(), g.whole)]), return_counts=True)
            if not len(keys):
                continue
            part = (keys >> np.uint64(64 - shift)).astype(np.int64)
            low = ((keys << np.uint64(shift)) >> np.uint64(32)).astype("<u4")
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            many = counts.astype("<u4")
            off = pa.py_buffer((at * 4).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[at[:-1]].astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, off, pa.py_buffer(low)]),
                 pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, off, pa.py_buffer(many)])], names=["part", "keys", "counts"])

    return docs.select("lang", "text").mapInArrow(task, "part int, keys binary, counts binary")


def survivors(docs: DataFrame, words: int = WORDS, least: int = LEAST, bits: int = BITS, mass: int = MASS) -> bytes:
    """Bitmap over the high ``bits`` bits of n-gram hashes: every n-gram found ``least`` times or more has its bit set."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a partition's bits fill whole bytes
    shift = min(20, bits - 3, max(1, math.ceil(math.log2(max(1, size * words // 4 / mass)))))

    def fold(t: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(t["keys"].to_pylist()), "<u4")
        counts = np.frombuffer(b"".join(t["counts"].to_pylist()), "<u4").astype(np.int64)
        kept, left, lost = merge(keys, counts, int(counts.sum()) // least + 1)
        kept = kept[left + lost >= least]  # the others cannot reach the threshold
        # a partition's bits lie side by side
        segment = np.zeros(1 << (bits - shift), bool)
        segment[kept >> np.uint32(32 - (bits - shift))] = True
        return pa.table({"part": t["part"].slice(0, 1), "bits": pa.array([np.packbits(segment, bitorder="little").tobytes()], pa.binary())})

    found = (summaries(docs, words, shift).repartition(max(2, min(1 << shift, 8192)), "part")
             .groupBy("part").applyInArrow(fold, "part int, bits binary"))
    step = (1 << (bits - shift)) // 8
    out = bytearray(step << shift)
    for row in found.collect():  # 2^bits bits in all, whatever the input
        out[row["part"] * step:(row["part"] + 1) * step] = row["bits"]
    return bytes(out)


def counts(docs: DataFrame, words: int = WORDS, least: int = LEAST, bits: int = BITS, mass: int = MASS) -> DataFrame:
    """lang, phrase, words, n of every n-gram found ``least`` times or more; ``words`` 0 holds the language's words."""
    shared = docs.sparkSession.sparkContext.broadcast(survivors(docs, words, least, bits, mass))

    def task(batches):
        marks = np.frombuffer(shared.value, np.uint8)
        for b in C.slices(batches, limit=SLICE):
            g = Grams(b, words)
            marked = []
            for h in g.hashes():
                bit = h >> np.uint64(64 - bits)
                marked.append((marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1)
            yield from g.counted(marked)

    rows = docs.select("lang", "text").mapInArrow(task, "lang string, phrase string, words int, n long")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(15,0)")


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, covered: int = COVERED, top: int = TOP, **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``words`` words."""
    found = C.stored(counts(docs, words, least, **sizes), "phrases")
    known = found.where("words > 0").select("lang", "phrase", F.col("n").alias("m"))
    cands = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    # sub-phrases of longer candidates, whether those are dropped or not
    inner = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    inside = (cands.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    cut = F.expr("transform(sequence(1, words - 1), k -> struct(k, array_join(slice(w, 1, k), ' ') as head, array_join(slice(w, k + 1, words - k), ' ') as tail))")
    open_ = (cands.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
             .select("lang", "phrase", "a", F.explode(cut).alias("c")).select("lang", "phrase", "a", "c.k", "c.head", "c.tail"))
    left = graph.hot_join(C.stored(open_, "cuts"), known.withColumnsRenamed({"phrase": "head", "m": "l"}), ["lang", "head"])
    both = graph.hot_join(C.stored(left, "cuts"), known.withColumnsRenamed({"phrase": "tail", "m": "r"}), ["lang", "tail"])
    a, l, r = _wide("a"), _wide("l"), _wide("r")
    scored = both.withColumns({"top": F.lit(1_000_000).cast("decimal(7,0)") * (a * a), "base": l * r}).withColumn("score", F.expr("top div base"))
    low = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.score", "s.l", "s.r")
    ranked = C.stored(low, "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # rounds of the first by salt, until a language's rest is small enough for one task
    while (widest := ranked.groupBy("lang").count().agg(F.max("count")).first()[0] or 0) > RANKED * top:
        salted = ranked.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(widest // (RANKED * top // 2) + 1)))
        some = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
        ranked = C.stored(some.drop("salt", "place"), "ranked")
    best = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = found.where("words = 0").select("lang", "n")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir):
    """Collocations of two and three words of ``documents``, 2000 a language (the report's length)."""
    return collocations(C.table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM numbered),
runs AS (SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS words, w1 AS phrase FROM runs UNION ALL
  SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL),
f AS (SELECT lang, phrase, words, count(*) AS m FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(m)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, phrase, words, m AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND m >= 10),
inside AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE words = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE coalesce(100 * longer < 50 * a, true)),
cuts AS (
  SELECT kept.*, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:words], ' ') AS tail
  FROM kept, unnest(range(1, words)) t(k)),
headed AS MATERIALIZED (SELECT cuts.*, m AS l FROM cuts JOIN f ON f.lang = cuts.lang AND f.phrase = head),
scored AS (
  SELECT headed.lang, headed.phrase, a, k, l, m AS r, ((1000000::HUGEINT * a * a) // (l::HUGEINT * m))::BIGINT AS score
  FROM headed JOIN f ON f.lang = headed.lang AND f.phrase = tail),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
