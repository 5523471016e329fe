"""Merkle dataset manifest: a content-addressed DAG over all rows, and a proof for each of them.

* Leaves. A row's leaf is the SHA-256 of its five columns, each with its length in front.
* Numbering. Leaves are range-partitioned by (source, doc_id, leaf); counts per partition give
  every leaf its rank in its source, so a source with a third of all rows is spread like any
  other. Equal rows stay one row with a count until a block of ranks is handled.
* Building. Ranks are cut into blocks of 3^7 leaves. A task folds one block by seven levels and
  stores one record per interior node, digest to children; the blocks' top digests are the
  leaves of the next round, so three rounds are enough for 10^10 rows of a source. The subroots,
  ordered by source, are built in the same way.
* Descent. Requests go down from the root: the record of the digest at hand is looked up, the
  rank's digit says which child is selected, the other children are collected, until the rank's
  digits are used up. The path of a block is found once and handed to all requests in it. At the
  leaf the path's segments are reversed, which gives the proof from leaf to root.

Defined cases: a null doc_id comes first in its source and is never tampered with; rows of one
doc_id are ordered by leaf, rows equal in all five columns get neighbouring ranks and a proof
each; null and empty texts have different leaves; a null source is a source and comes first; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import graph

FAN, LEVELS = 3, 7
BLOCK = FAN ** LEVELS
#: Leaves or blocks' leaves that one task gets at least.
TASK_ROWS = 16_384
WORK = "tree long, block long, kind int, n long, rank long, copies long, doc_id long, digest binary, payload binary, tampered binary, subroot binary, root binary"
MADE = "tree long, block long, n long, digest binary, payload binary"
PATHS = "tree long, block long, digest binary, payload binary, subroot binary, root binary"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _hash(parts: list[bytes]) -> bytes:
    """SHA-256 over the digests as lowercase hex text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def _field(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, tampered (digests as binary) of every row."""
    kept = docs.select("doc_id", "source", "lang", "n_chars", "text")

    def leaf(text: Column) -> Column:
        cols = [F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), F.col("n_chars").cast("string"), text]
        return F.unhex(F.sha2(F.concat(*[_field(c) for c in cols]).cast("binary"), 256))

    changed = (C.fold(2) == 0) & F.contains("text", F.lit("\n"))
    other = F.when(changed, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    return kept.select("source", "doc_id", leaf(F.col("text")).alias("leaf"), other.alias("other")).select(
        "source", "doc_id", "leaf", F.coalesce("other", "leaf").alias("tampered"))


def positions(df: DataFrame, order: list[str], weight: str) -> DataFrame:
    """Stored ``df`` with ``at``: the weight of all rows before a row in ``order``, over the whole table."""
    ranged = C.stored(df.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("pid").agg(F.sum(weight).alias("held"))  # one row per range of the table
    before = sums.select("pid", F.coalesce(F.sum("held").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum(weight).over(Window.partitionBy("pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(weight)
    return C.stored(ranged.withColumn("inside", inside).join(F.broadcast(before), "pid")
                    .withColumn("at", F.col("before") + F.col("inside")).drop("pid", "inside", "before"), "positions")


# ---------------------------------------------------------------- one block

def fold_up(level: list[bytes], whole: bool) -> tuple[bytes, list[tuple[bytes, bytes]]]:
    """Top digest of a block and its records; a ``whole`` tree ends at one node, a part always goes up by all levels."""
    records, done = [], 0
    while (len(level) > 1) if whole else (done < LEVELS):
        up = []
        for i in range(0, len(level), FAN):
            up.append(_hash(level[i:i + FAN]))
            records.append((up[-1], b"".join(level[i:i + FAN])))
        level, done = up, done + 1
    return level[0], records


def levels_of(size: int, whole: bool) -> int:
    done = 0
    while whole and size > 1:
        size, done = -(-size // FAN), done + 1
    return done if whole else LEVELS


def descend(records: dict[bytes, bytes], top: bytes, rank: int, levels: int) -> tuple[bytes, bytes]:
    """The digest at ``rank`` and its siblings, level by level upwards: place, number, digests."""
    at, path = top, []
    for k in range(levels - 1, -1, -1):
        children = records[at]
        digit = rank // FAN ** k % FAN
        path.append(bytes([digit, len(children) // 32 - 1]) + children[:32 * digit] + children[32 * digit + 32:])
        at = children[32 * digit:32 * digit + 32]
    return at, b"".join(reversed(path))


def climb(digest: bytes, path: bytes) -> tuple[bytes, bytes]:
    """The root that a leaf and a path lead to, and the hash of the path's siblings."""
    i, proof = 0, []
    while i < len(path):
        place, many = path[i], path[i + 1]
        i, rest = i + 2 + 32 * many, path[i + 2:i + 2 + 32 * many]
        proof.append(rest)
        digest = _hash([rest[:32 * place], digest, rest[32 * place:]])
    return digest, _hash(proof)


# ---------------------------------------------------------------- rounds

def _deal(df: DataFrame, rows: int) -> DataFrame:
    """By (tree, block) over a number of tasks that follows the rows, not their bytes."""
    return df.repartition(int(max(1, min(8192, rows // TASK_ROWS))), "tree", "block")


def _fill(df: DataFrame, kind: int) -> DataFrame:
    """``df`` with the columns of WORK, null where it has none."""
    want = [c.split(" ") for c in WORK.split(", ")]
    return df.withColumn("kind", F.lit(kind)).select(
        *[(F.col(n) if n in df.columns or n == "kind" else F.lit(None)).cast(t).alias(n) for n, t in want])


def _arrow(columns: dict, schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.table({n: pa.array(columns[n], kinds[t]) for n, t in (c.split(" ") for c in schema.split(", "))})


def _build_block(t: pa.Table) -> pa.Table:
    low, n = t["block"][0].as_py() * BLOCK, t["n"][0].as_py()
    t = t.sort_by("rank")
    level: list[bytes] = []
    for r, c, d in zip(t["rank"].to_pylist(), t["copies"].to_pylist(), t["digest"].to_pylist()):
        level += [d] * (min(r + c, low + BLOCK) - max(r, low))
    top, records = fold_up(level, n <= BLOCK)
    records = list(dict.fromkeys(records))  # equal nodes are one record
    many = len(records) + 1
    # the block's top comes last, without a payload
    return _arrow({"tree": [t["tree"][0].as_py()] * many, "block": [low // BLOCK] * many, "n": [n] * many,
                   "digest": [d for d, _ in records] + [top], "payload": [p for _, p in records] + [None]}, MADE)


def build(nodes: DataFrame, rows: int) -> list[tuple[DataFrame, DataFrame, DataFrame]]:
    """Per round the stored requests (tree, block, n, rank, copies, digest, ...), records and blocks' tops."""
    rounds = []
    while True:
        blocks = F.sequence(F.expr(f"rank div {BLOCK}"), F.expr(f"(rank + copies - 1) div {BLOCK}"))
        asked = C.stored(nodes.withColumn("block", F.explode(blocks)), "merkle-nodes")
        dealt = _deal(asked.select("tree", "block", "n", "rank", "copies", "digest"), rows)
        made = C.stored(dealt.groupBy("tree", "block").applyInArrow(_build_block, MADE), "merkle-records")
        tops = made.where("payload is null").drop("payload")
        rounds.append((asked, made.where("payload is not null"), tops))
        widest = tops.agg(F.max("n")).first()[0]
        if widest is None or widest <= BLOCK:
            return rounds
        nodes = tops.where(F.col("n") > BLOCK).select("tree", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("rank"),
                                                      F.lit(1).cast("long").alias("copies"), "digest")
        rows = rows // BLOCK + 1


def roots(rounds: list) -> DataFrame:
    """(tree, digest): what remains of each tree."""
    done = [tops.where(F.col("n") <= BLOCK).select("tree", "digest") for _, _, tops in rounds]
    return reduce(DataFrame.unionByName, done)


def _walk(t: pa.Table) -> tuple[dict, list]:
    """The block's path row and its requests as (row, rank, digest, path), each checked against its leaf."""
    kind = t["kind"]
    own = t.filter(pc.equal(kind, 0))
    records = dict(zip(own["digest"].to_pylist(), own["payload"].to_pylist()))
    up = t.filter(pc.equal(kind, 1)).slice(0, 1).to_pylist()[0]
    asked = t.filter(pc.equal(kind, 2)).to_pylist()
    low, n = up["block"] * BLOCK, asked[0]["n"]
    levels = levels_of(n, n <= BLOCK)
    out = []
    for row in asked:
        for rank in range(max(row["rank"], low), min(row["rank"] + row["copies"], low + BLOCK)):
            digest, path = descend(records, up["digest"], rank - low, levels)
            if digest != row["digest"]:
                raise ValueError(f"the descent to rank {rank} of tree {row['tree']} ends at another digest")
            out.append((row, rank, digest, path + up["payload"]))
    return up, out


def _paths(t: pa.Table) -> pa.Table:
    up, found = _walk(t)
    return _arrow({"tree": [up["tree"]] * len(found), "block": [rank for _, rank, _, _ in found], "digest": [d for *_, d, _ in found],
                   "payload": [p for *_, p in found], "subroot": [up["subroot"]] * len(found), "root": [up["root"]] * len(found)}, PATHS)


def _source_paths(t: pa.Table) -> pa.Table:
    """Leaves of the tree of sources are the subroots: the path to each source's tree."""
    up, found = _walk(t)
    digests = [d for *_, d, _ in found]
    return _arrow({"tree": [rank for _, rank, _, _ in found], "block": [0] * len(found), "digest": digests,
                   "payload": [p for *_, p in found], "subroot": digests, "root": [up["root"]] * len(found)}, PATHS)


def _proofs(t: pa.Table) -> pa.Table:
    up, found = _walk(t)
    ends = [climb(row["tampered"], path) for row, _, _, path in found]
    return _arrow({"doc_id": [row["doc_id"] for row, *_ in found], "leaf": [d.hex() for *_, d, _ in found],
                   "subroot": [up["subroot"].hex()] * len(found), "root": [up["root"].hex()] * len(found),
                   "proof_sha256": [p.hex() for _, p in ends], "folded_root": [b.hex() for b, _ in ends],
                   "verified": [b == up["root"] for b, _ in ends]}, PROOFS)


def down(rounds: list, above: DataFrame, rows: int, last, schema: str) -> DataFrame:
    """``last`` applied to the first round's blocks, after the descent from the trees' roots (``above``, columns of PATHS)."""
    reached = None
    for k in range(len(rounds) - 1, -1, -1):
        asked, records, tops = rounds[k]
        # trees that end in this round start here, the others come from the round above
        paths = above.join(tops.where(F.col("n") <= BLOCK).select("tree"), "tree", "left_semi")
        paths = paths if reached is None else paths.unionByName(reached)
        work = _fill(records.drop("n"), 0).unionByName(_fill(paths, 1)).unionByName(_fill(asked, 2))
        groups = _deal(work, rows // BLOCK ** k).groupBy("tree", "block")
        if k:
            reached = C.stored(groups.applyInArrow(_paths, PATHS), "merkle-paths")
    return groups.applyInArrow(last, schema)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    spark = docs.sparkSession
    slim = leaves(docs).groupBy("source", "doc_id", "leaf", "tampered").agg(F.count(F.lit(1)).alias("copies"))
    placed = positions(slim, ["source", "doc_id", "leaf"], "copies")
    spans = placed.groupBy("source").agg(F.min("at").alias("start"), F.sum("copies").alias("n")).withColumn("one", F.lit(1).cast("long"))
    sources = positions(spans, ["source"], "one").withColumnRenamed("at", "tree").drop("one")
    rows, trees = (int(x or 0) for x in sources.agg(F.sum("n"), F.count("*")).first())
    if not rows:
        return spark.createDataFrame([], PROOFS)
    key = F.concat(F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.lit(":")), F.coalesce("source", F.lit("")))
    nodes = graph.hot_join(placed.withColumn("key", key).drop("source"), sources.withColumn("key", key).drop("source"), ["key"])
    nodes = nodes.select("tree", "n", (F.col("at") - F.col("start")).alias("rank"), "copies", "doc_id", F.col("leaf").alias("digest"), "tampered")
    lower = build(nodes, rows)
    one = F.lit(1).cast("long")
    upper = build(roots(lower).select((one - 1).alias("tree"), (one * trees).alias("n"), F.col("tree").alias("rank"), one.alias("copies"), "digest"), trees)
    root = bytes(roots(upper).first()["digest"])
    start = spark.createDataFrame([(0, 0, root, b"", None, root)], PATHS)
    above = C.stored(down(upper, start, trees, _source_paths, PATHS), "merkle-sources")
    return down(lower, above, rows, _proofs, PROOFS)


def op12_merkle_manifest(spark, sf_dir):
    """Manifest and proofs of ``documents``, ready for a check of every row."""
    return manifest(C.table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE
crc AS (  -- CRC-32 of the decimal doc_id, bit by bit
  SELECT DISTINCT doc_id, xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS crc
  FROM documents WHERE doc_id IS NOT NULL),
parts AS (
  SELECT documents.doc_id, source, text, crc,
    coalesce(strlen(documents.doc_id::VARCHAR)::VARCHAR || ':' || documents.doc_id::VARCHAR, '-')
    || coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head
  FROM documents LEFT JOIN crc USING (doc_id)),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(t)::VARCHAR || ':' || t, '-')) AS tampered
  FROM (SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t FROM parts)),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
low AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS d FROM ranked
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
sub AS (SELECT tree, lvl AS depth, d AS subroot FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, tree AS pos, (SELECT count(*) FROM sub) AS n, subroot AS d FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
steps AS (  -- one row per document and level: what stands before and after its node in its run
  SELECT ranked.tree, ranked.pos AS leaf_pos, low.lvl, coalesce(string_agg(d, '' ORDER BY low.pos) FILTER (WHERE low.pos < here), '') AS before,
    coalesce(string_agg(d, '' ORDER BY low.pos) FILTER (WHERE low.pos > here), '') AS after
  FROM (SELECT r.tree, r.pos, lvl, (r.pos // (3 ** lvl)::BIGINT)::BIGINT AS here FROM ranked r JOIN sub USING (tree), unnest(range(0, depth)) t(lvl)) ranked
  JOIN low ON low.tree = ranked.tree AND low.lvl = ranked.lvl AND low.pos // 3 = here // 3
  GROUP BY ALL),
tops AS (
  SELECT s.tree, s.lvl, coalesce(string_agg(d, '' ORDER BY high.pos) FILTER (WHERE high.pos < here), '') AS before,
    coalesce(string_agg(d, '' ORDER BY high.pos) FILTER (WHERE high.pos > here), '') AS after
  FROM (SELECT tree, lvl, (tree // (3 ** lvl)::BIGINT)::BIGINT AS here FROM sub, (SELECT DISTINCT lvl FROM high WHERE n > 1)) s
  JOIN high ON high.lvl = s.lvl AND high.pos // 3 = here // 3
  GROUP BY ALL),
path AS (
  SELECT tree, leaf_pos, lvl AS step, before, after FROM steps
  UNION ALL
  SELECT ranked.tree, ranked.pos, depth + tops.lvl, before, after FROM ranked JOIN sub USING (tree) JOIN tops USING (tree)),
proof AS (SELECT tree, leaf_pos, string_agg(before || after, '' ORDER BY step) AS siblings FROM path GROUP BY ALL),
climb AS (
  SELECT tree, pos, 0 AS step, tampered AS d FROM ranked
  UNION ALL
  SELECT climb.tree, climb.pos, climb.step + 1, sha256(before || d || after)
  FROM climb JOIN path ON path.tree = climb.tree AND path.leaf_pos = climb.pos AND path.step = climb.step),
folded AS (SELECT tree, pos, arg_max(d, step) AS folded_root FROM climb GROUP BY ALL),
root AS (SELECT d AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM ranked JOIN sub USING (tree) JOIN folded USING (tree, pos) LEFT JOIN proof ON proof.tree = ranked.tree AND proof.leaf_pos = ranked.pos, root
"""
