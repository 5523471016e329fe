"""SimHash near-duplicates by vantage-point trees.

* Fingerprints. Every three-word shingle of a whole text is hashed (XXH64); a fingerprint bit
  is set if it is set in more than half of the hashes.
* Equal fingerprints are one node from here on, so exact copies cost nothing more.
* Tree. Vantage points and cuts are fitted on a bounded sample of the distinct fingerprints
  (``SAMPLE``); each cut is the one with the least growth of visits for the work it saves.
  Every fingerprint is then walked down the tree: it is at home in one shard (inside: distance
  to the vantage point up to the cut), and it also visits the shards in which the triangle
  bound allows a partner. At the node where a pair parts, the outer one lies within the radius
  of the cut and visits the inner side, so each pair meets in the home shard of one of them.
* Shards. A task holds the homes of one shard and a bounded part of its visitors, plants
  another tree over them and compares what is left with XOR and bit counts. It returns a
  spanning forest of the links, never all pairs; a fingerprint has at most 2,080 others within
  two bits. Links are exact: sample and tree only decide which shards a fingerprint sees.

Defined cases: null texts and texts without a word have fingerprint zero, which links like any
other; fewer words than the shingle width form one shingle; a row with a null doc_id links too,
its component is named by the smallest doc_id in it (null if there is none); rows that repeat a
doc_id keep a fingerprint each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import graph

WIDTH, RADIUS = 3, 2
SEED = 42
#: Fingerprints the tree is fitted on, at most about this many.
SAMPLE = 1 << 17
#: Homes of a shard that the fit aims at, and visitors that one task takes.
SHARD, VISITORS = 4096, 65_536
#: Homes of a shard inside a task, and fingerprints walked down the tree at once.
LOCAL, ROUTED = 384, 1 << 17
_LOWER = bytes(C.LOWER.tolist())


def shingle_hashes(text: bytes, width: int = WIDTH) -> np.ndarray:
    """XXH64 of each shingle of a UTF-8 text (A-Z lower-cased, words joined by a space), repeats included."""
    import xxhash

    whole = b" ".join(text.translate(_LOWER).split())  # bytes.split: exactly \x20 and \x09-\x0D
    if not whole:
        return np.zeros(0, np.uint64)
    gap = np.flatnonzero(np.frombuffer(whole, np.uint8) == 32)
    if len(gap) + 1 <= width:
        return np.array([xxhash.xxh64_intdigest(whole, SEED)], np.uint64)
    start = np.concatenate([[0], gap[:len(gap) - width + 1] + 1] if width > 1 else [[0], gap + 1])
    end = np.concatenate([gap[width - 1:], [len(whole)]])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[a:b], SEED) for a, b in zip(start.tolist(), end.tolist())), np.uint64, len(end))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have."""
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[i:i + (1 << 15)], "<u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and fingerprint (a signed long with the same bits) of every row."""

    def task(batches):
        for b in C.slices(batches):
            t = C.Texts(C.column(b, "text"))
            data = t.data.tobytes()
            fp = [fingerprint(shingle_hashes(data[i:j], width)) for i, j in zip(t.off[:-1].tolist(), t.off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([C.column(b, "doc_id").cast(pa.int64()), pa.array(np.array(fp, np.uint64).view(np.int64))],
                                             names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, fingerprint long")


# ---------------------------------------------------------------- vantage-point tree

class Tree:
    """Nodes as rows of (vantage point, cut, inner child, outer child); a child below zero is shard ``-1 - child``."""

    def __init__(self, points: np.ndarray, leaf: int, radius: int):
        self.radius, self.nodes, self.shards = radius, [], 0
        self.root = self._plant(points, leaf)

    def _plant(self, points: np.ndarray, leaf: int) -> int:
        best = self._cut(points) if len(points) > leaf else None
        if best is None:
            self.shards += 1
            return -self.shards
        at = len(self.nodes)
        self.nodes.append(None)
        _, vantage, cut = best
        inside = np.bitwise_count(points ^ np.uint64(vantage)) <= cut
        self.nodes[at] = (vantage, cut, self._plant(points[inside], leaf), self._plant(points[~inside], leaf))
        return at

    def _cut(self, points: np.ndarray):
        """The vantage point and cut with the least growth of visits per factor of work saved."""
        best = None
        for i in np.unique(np.linspace(0, len(points) - 1, 12).astype(int)):
            hist = np.bincount(np.bitwise_count(points ^ points[i]), minlength=65) / len(points)
            upto = np.cumsum(hist)
            for cut in np.flatnonzero((upto > 0.05) & (upto < 0.95)).tolist():
                near = hist[max(0, cut - self.radius + 1):cut + self.radius + 1].sum()
                saved = -np.log(upto[cut] ** 2 + (1 - upto[cut]) ** 2)
                cost = np.log1p(near) / saved
                if best is None or cost < best[0]:
                    best = (cost, int(points[i]), cut)
        return best

    def walk(self, points: np.ndarray, home: np.ndarray):
        """Yield (shard, rows at home there, rows that visit it)."""
        todo = [(self.root, np.flatnonzero(home), np.flatnonzero(~home))]
        while todo:
            node, homes, guests = todo.pop()
            if not len(homes) and not len(guests):
                continue
            if node < 0:
                yield -1 - node, homes, guests
                continue
            vantage, cut, inner, outer = self.nodes[node]
            d = np.bitwise_count(points[homes] ^ np.uint64(vantage)).astype(np.int64)
            g = np.bitwise_count(points[guests] ^ np.uint64(vantage)).astype(np.int64)
            edge = homes[(d > cut) & (d <= cut + self.radius)]
            todo.append((inner, homes[d <= cut], np.concatenate([guests[g <= cut + self.radius], edge])))
            todo.append((outer, homes[d > cut], guests[g > cut - self.radius]))


def forest(points: np.ndarray, home: np.ndarray, radius: int, own: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(row, smaller row) links that connect what links within the radius connect: homes with guests, and with each other if ``own``."""
    label = np.arange(len(points))

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    tree = Tree(points[home], LOCAL, radius)
    for _, homes, guests in tree.walk(points, home):
        if not len(homes):
            continue
        rows = np.concatenate([homes, guests])
        step = max(1, (1 << 21) // len(homes))
        for i in range(0, len(rows), step):
            some = rows[i:i + step]
            a, b = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[homes][None, :]) <= radius)
            a, b = some[a], homes[b]
            keep = a != b
            if not own:
                keep &= ~home[a]
            for x, y in zip(a[keep].tolist(), b[keep].tolist()):
                x, y = find(x), find(y)
                if x != y:
                    label[max(x, y)] = min(x, y)
    root = np.array([find(i) for i in range(len(points))], np.int64)
    moved = np.flatnonzero(root != np.arange(len(points)))
    return moved, root[moved]


def links(points: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD, visitors: int = VISITORS) -> DataFrame:
    """(node, root) links that connect the distinct ``fingerprint`` values exactly as all pairs within ``radius`` bits do."""
    total = points.count()
    share = min(1.0, sample / max(total, 1))
    drawn = points.where(F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30)) < int(share * (1 << 30)))
    seen = np.sort(np.array([r[0] for r in drawn.collect()], np.int64).view(np.uint64))
    tree = Tree(seen, max(8, int(shard * share)), radius)

    def many(batches):
        held, rows = [], 0
        for b in batches:
            held, rows = held + [b.column(0).to_numpy(zero_copy_only=False)], rows + b.num_rows
            if rows >= ROUTED:
                yield np.concatenate(held)
                held, rows = [], 0
        if rows:
            yield np.concatenate(held)

    def route(batches):
        for p in many(batches):
            p = p.astype(np.int64).view(np.uint64)
            for s, homes, guests in tree.walk(p, np.ones(len(p), bool)):
                at = np.concatenate([homes, guests])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), s, np.int32)), pa.array(p[at].view(np.int64)),
                                                  pa.array(np.arange(len(at)) < len(homes))], names=["shard", "fingerprint", "home"])

    routed = C.stored(points.select("fingerprint").mapInArrow(route, "shard int, fingerprint long, home boolean"), "routed")
    # visitors of a shard are cut into parts no larger than a bound or than its homes, which meet each part
    load = F.count_if(~F.col("home")) / F.greatest(F.lit(visitors), F.count_if("home"))
    parts = routed.groupBy("shard").agg(F.greatest(F.lit(1), F.ceil(load)).cast("int").alias("parts"))
    parts = C.stored(parts, "parts")
    tasks = parts.agg(F.sum("parts")).first()[0] or 1
    guest = F.array(F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    dealt = (routed.join(F.broadcast(parts), "shard")  # one row per shard of a tree of bounded size
             .select("shard", "fingerprint", "home", F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(guest)).alias("part"))
             .repartition(int(min(tasks, 8192)), "shard", "part"))

    def search(pdf):
        import pandas as pd

        pdf = pdf.sort_values("fingerprint", kind="stable")
        p = pdf["fingerprint"].to_numpy()
        a, b = forest(p.view(np.uint64), pdf["home"].to_numpy(bool), radius, own=bool(pdf["part"].iloc[0] == 0))
        return pd.DataFrame({"node": p[a], "root": p[b]}, dtype="int64")

    return dealt.groupBy("shard", "part").applyInPandas(search, "node long, root long")


def join(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, **fit) -> DataFrame:
    """doc_id, fingerprint (a signed long) and component_id of every row."""
    rows = C.stored(fingerprints(docs, width), "fingerprints")
    points = C.stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "points")
    edges = C.stored(links(points, radius, **fit), "links")
    labels = graph.components(edges).withColumnRenamed("node", "fingerprint")
    # a component is a label's fingerprints; its name is the smallest doc_id in it
    labelled = C.stored(points.join(labels, "fingerprint", "left").select("fingerprint", "least", F.coalesce("label", "fingerprint").alias("label")), "labelled")
    names = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = C.stored(graph.hot_join(labelled.select("fingerprint", "label"), names, ["label"]).select("fingerprint", "component_id"), "named")
    return graph.hot_join(rows, named, ["fingerprint"]).select("doc_id", "fingerprint", "component_id")


def op13_simhash_neardup(spark, sf_dir):
    """Near-duplicates of ``documents`` at two differing bits."""
    found = join(C.table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
