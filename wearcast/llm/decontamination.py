"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

1. ``build_index`` stores the postings (document row, position, term) of every training
   token whose term occurs in the benchmark: one pass over the texts, written once to the
   shared folder. Each document also has one row with its word count.
2. Every benchmark window (``WINDOW`` consecutive words; a shorter item is one window) is
   entered through its rarest terms: the lists of the two rarest positions of all windows
   are shifted by their offsets, and document diagonals (position minus item position) on
   which two of them meet are candidates.
3. The candidates' other terms are intersected the same way, and runs of matched positions
   at least a window long are exact occurrences.

Common words are never joined with each other, and a passage shared by many documents costs
one candidate per document. What is broadcast is the benchmark's vocabulary and anchor table,
or the candidate documents' numbers, each only after its size was counted; beyond
``BROADCAST_ROWS`` the same joins shuffle.

Defined cases: null text has no words; an item without words matches nothing; items that
repeat an id count once; a null item_id is listed as an empty string; rows that repeat a
doc_id are judged row by row; empty tables give no rows or no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WINDOW = 10
BROADCAST_ROWS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else; ``lower`` is the fast way for pure ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, A_Z, a_z))


def raw_words(text: Column) -> Column:
    """Words with an empty string in front (behind) where the text begins (ends) with a separator."""
    return F.split(lowered(text), SEPARATORS)


def limited(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table whose rows were counted, if they are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_words(items: DataFrame) -> DataFrame:
    """(item, item_id, size, ipos, word, term) of every distinct benchmark row; stored."""
    flat = (items.select("item_id", "text").distinct()
            .select(F.xxhash64("item_id", "text").alias("item"), "item_id", F.filter(raw_words(F.col("text")), lambda w: w != "").alias("w"))
            .select("item", "item_id", F.size("w").alias("size"), F.posexplode("w").alias("ipos", "word")))
    return C.stored(flat.withColumn("term", F.xxhash64("word")), "benchmark-words")


def build_index(docs: DataFrame, vocabulary: DataFrame, terms: int) -> DataFrame:
    """Stored postings: rid (row number), doc_id, text_key, n_words, pos, term. Each document has one extra
    row with its text_key and n_words, which are null in the others, and no term."""
    split = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", C.text_key().alias("text_key"), raw_words(F.col("text")).alias("w"))
    lead = (F.element_at("w", 1) == "").cast("int")
    trail = ((F.size("w") > 1) & (F.element_at("w", -1) == "")).cast("int")
    words = (split.select("rid", "doc_id", "text_key", F.coalesce(F.size("w") - lead - trail, F.lit(0)).alias("n_words"), F.coalesce(lead, F.lit(0)).alias("lead"),
                          F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("w", F.array().cast("array<string>")))).alias("at", "word")))
    found = words.join(limited(vocabulary, terms), "word", "left")
    rows = found.where("at = 0 or term is not null").select(
        "rid", "doc_id", F.when(F.col("at") == 0, F.col("text_key")).alias("text_key"), F.when(F.col("at") == 0, F.col("n_words")).alias("n_words"), (F.col("at") - 1 - F.col("lead")).alias("pos"), "term")
    return C.stored(rows, "postings")


def anchors(items: DataFrame, postings: DataFrame, window: int = WINDOW, lists: int = 2) -> DataFrame:
    """(item, ipos, term, need): the positions of the rarest terms of each window; ``need`` of them lie on a true diagonal."""
    counts = postings.where("term is not null").groupBy("term").count()
    rated = items.join(counts, "term", "left").select("item", "size", "ipos", "term", F.struct(F.coalesce("count", F.lit(0)).alias("n"), "ipos", "term").alias("rate"))
    span = Window.partitionBy("item").orderBy("ipos").rowsBetween(0, window - 1)
    picks = (rated.withColumn("near", F.collect_list("rate").over(span))
             .where((F.col("ipos") == 0) | (F.col("ipos") <= F.col("size") - window))
             .select("item", F.least(F.lit(lists), "size").alias("need"), F.explode(F.slice(F.array_sort("near"), 1, lists)).alias("r")))
    return picks.select("item", "r.ipos", "r.term", "need").distinct()


def occurrences(items: DataFrame, postings: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, item, item_id, first, past): maximal runs of document words covered by an item's consecutive words, each run at least a window."""
    entry = C.stored(anchors(items, postings, window), "anchors")
    seeds = (postings.select("rid", "pos", "term").join(limited(entry, entry.count()), "term")
             .groupBy("rid", "item", (F.col("pos") - F.col("ipos")).alias("diagonal"))
             .agg(F.count_distinct("ipos").alias("n"), F.max("need").alias("need")).where("n >= need").select("rid", "item", "diagonal"))
    candidates = C.stored(seeds, "diagonals")
    rids = candidates.select("rid").distinct()
    near = postings.where("term is not null").select("rid", "pos", "term").join(limited(rids, rids.count()), "rid", "left_semi")
    expected = (candidates.join(items.select("item", "item_id", "size", "ipos", "term"), "item")
                .select("rid", "item", "item_id", "size", "diagonal", "ipos", "term", (F.col("diagonal") + F.col("ipos")).alias("pos")))
    matched = expected.join(near, ["rid", "pos", "term"])
    order = Window.partitionBy("rid", "item", "diagonal").orderBy("ipos")
    return (matched.withColumn("run", F.col("ipos") - F.row_number().over(order))
            .groupBy("rid", "item", "item_id", "size", "diagonal", "run").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
            .where(F.col("n") >= F.least(F.lit(window), "size"))
            .select("rid", "item", "item_id", "first", (F.col("first") + F.col("n")).alias("past")))


def proximity(items: DataFrame, postings: DataFrame, slop: int = 20) -> DataFrame:
    """(rid, item): documents in which an item's two rarest distinct terms stand at most ``slop`` words apart.

    Positions are binned by ``slop``, so that only postings of the same or the next bin meet.
    """
    counts = postings.where("term is not null").groupBy("term").count()
    two = (items.join(counts, "term").groupBy("item").agg(F.slice(F.array_sort(F.collect_set(F.struct("count", "term"))), 1, 2).alias("t"))
           .where(F.size("t") == 2).select("item", F.col("t")[0]["term"].alias("a"), F.col("t")[1]["term"].alias("b")))
    p = postings.where("term is not null").select("rid", "pos", "term", F.floor(F.col("pos") / slop).alias("bin"))
    left = p.join(two, p["term"] == two["a"]).select("rid", "item", "b", F.col("pos").alias("pa"), F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"))
    right = p.select("rid", "bin", F.col("term").alias("b"), F.col("pos").alias("pb"))
    return left.join(right, ["rid", "bin", "b"]).where(F.abs(F.col("pa") - F.col("pb")) <= slop).select("rid", "item").distinct()


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(postings, occurrences) of the benchmark in the documents."""
    items = item_words(benchmark)
    vocabulary = items.select("word", "term").distinct()
    terms, hashes = vocabulary.agg(F.count("*"), F.count_distinct("term")).first()
    if terms != hashes:
        raise ValueError("two benchmark words share a 64-bit hash")
    postings = build_index(docs, vocabulary, terms)
    return postings, occurrences(items, postings, window)


def report(postings: DataFrame, found: DataFrame) -> DataFrame:
    """One row per document row: rid, doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated."""
    before = Window.partitionBy("rid").orderBy("first", "past").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("rid", "first", "past").distinct().withColumn("seen", F.coalesce(F.max("past").over(before), F.lit(0)))
    hits = spans.groupBy("rid").agg(F.sum(F.greatest(F.lit(0), F.col("past") - F.greatest("first", "seen"))).alias("n_hit"))
    names = found.groupBy("rid").agg(F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("ids"))
    each = postings.where("n_words is not null").select("rid", "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (each.join(hits, "rid", "left").join(names, "rid", "left")
            .select("rid", "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    return report(*search(docs, benchmark, window))


def op4_decontamination(spark, sf_dir):
    out = decontaminate(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return out.drop("rid", "text_key")


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> ''), []) AS w
  FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT rid, p, size, array_to_string(w[p + 1 : p + size], ' ') AS phrase
  FROM (SELECT rid, w, size, unnest(range(len(w) - size + 1)) AS p FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
m AS (SELECT dw.rid, dw.p, dw.size, iw.item_id FROM dw JOIN iw USING (size, phrase)),
h AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS q FROM m) GROUP BY rid),
n AS (SELECT rid, list_sort(list(DISTINCT coalesce(CAST(item_id AS VARCHAR), ''))) AS ids FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN n USING (rid)
"""
