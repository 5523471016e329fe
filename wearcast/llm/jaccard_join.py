"""N-gram Jaccard join: links between documents whose shingle sets overlap enough, and the
components they form.

* Documents with equal sets are one class; only the class's smallest doc_id goes on.
* Routing. Two sets of sizes a and b that link differ in at most d = (1-t)/(1+t) (a+b)
  shingles. Sets of a size class are cut by hash range into more than d parts, so a linking
  pair has an equal part; a document is entered under a signature of each of its parts
  (and, near the border of a size class, of the parts it has in the joint class). Parts are
  several shingles wide, so a frequent shingle or passage alone routes nothing. Signatures are
  first packed per slice of documents and hash partition; those that stand in one place only are
  dropped by a bitmap before rows of them are dealt. It has eight bits for each shared signature,
  so that it stays as sparse when the table grows (up to ``MOST_BITS``; a full bitmap drops none).
  There are more parts than a linking pair can change, so partners share several of them, and
  documents that share fewer (a common passage, or chance bits) are set aside by count, first by
  their bits and then by the signatures.
* First round. Every document is searched against the smallest document that shares a part
  with it, which links most groups of near-copies to one component each.
* Second round. Signature groups that still hold several components are joined to blocks
  (components over "shares a part"). A block is cut into chunks of bounded shingle count in
  component order, and every pair of chunks with different components is one task. Inside a
  task the T-occurrence search runs over the block's inverted lists, rarest shingles first:
  the short lists that one of any T common shingles must be in are merged, the others
  (long) are only probed for the documents found, and documents of one component are never
  compared. Chunks inside one component are never paired, so a large
  group of mutual near-copies stays linear, and no pair of different components is left out.

Links and components stay distributed (alternating large-star and small-star steps).

Defined cases: null texts and texts without a word have an empty set and no links; fewer
words than the shingle width form one shingle; rows that repeat a doc_id are one document
for linking; a row with a null doc_id has a null component; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import cumulative_sum
from . import common as C
from .graph import components

WIDTH, PERCENT = 3, 90
#: Shingles that one T-occurrence task gets beside its root's.
PIECE_SHINGLES, BROADCAST_IDS = 400_000, 1_000_000
#: Shingles of one chunk of a block (8 bytes each); a task holds two chunks.
CHUNK_SHINGLES = 800_000
SKETCH = "doc_id long, text_key long, n_shingles long, k1 long, k2 long"
#: Least and most bits of the bitmap of shared signatures (2^26 are 8 MB, 2^29 are 64 MB), and signatures that a hash partition should hold.
BITS, MOST_BITS, MASS = 26, 29, 1 << 21


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = x + np.uint64(int(seed) * 0x9E3779B97F4A7C15 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def sliced(batches):
    """Slices of the batches; at the end of a task freed memory goes back, for a worker lives on."""
    yield from C.slices(batches)
    C.release()


def word_hash(words: C.Texts) -> np.ndarray:
    """64-bit hash of each (non-empty) word: two byte polynomials, mixed."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = np.diff(words.off)
    left = np.repeat(words.off[1:], size) - 1 - np.arange(len(words.data))
    with np.errstate(over="ignore"):
        out = size.astype(np.uint64)
        for step in (0x100000001B3, 0x9E3779B97F4A7C15):
            power = np.cumprod(np.full(int(size.max()) + 1, step, np.uint64))
            out = _mix(out + np.add.reduceat((words.data.astype(np.uint64) + np.uint64(1)) * power[left], words.off[:-1]), 3)
        return out


def shingle_sets(arr: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row (A-Z lower-cased, split at ASCII white space)."""
    t = C.Texts(arr)
    words = t.split(C.WS, C.LOWER[t.data])
    code, distinct = words.codes()
    h = word_hash(C.Texts(distinct))[code] if len(code) else np.zeros(0, np.uint64)
    n = len(h)
    with np.errstate(over="ignore"):
        gram = np.zeros(max(n - width + 1, 0), np.uint64)
        for k in range(width):
            gram = _mix(gram + h[k:n - width + 1 + k], k + 11) if len(gram) else gram
    out = []
    for i in range(len(t)):
        a, b = words.bounds[i], words.bounds[i + 1]
        if b - a >= width:
            out.append(np.unique(gram[a:b - width + 1]))
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for k in range(a, b):
                whole = _mix(whole + h[k:k + 1], k - a + 101)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Router:
    """Signatures of shingle sets for a similarity of at least ``percent`` per cent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = [1]
        self.ratio = max(1.4, 102 / percent)

    def differ(self, total: int) -> int:
        """Largest symmetric difference of two linking sets with ``total`` members together."""
        return (100 - self.percent) * total // (100 + self.percent)

    def _class(self, n: int) -> int:
        while self.bounds[-1] <= n:
            self.bounds.append(max(self.bounds[-1] + 1, math.ceil(self.bounds[-1] * self.ratio)))
        return int(np.searchsorted(self.bounds, n, "right")) - 1

    def tags(self, n: int) -> list[tuple[int, int, int]]:
        """(tag, parts, least number of parts that a linking pair leaves untouched) for a set of ``n``."""
        i = self._class(n)
        self._class(self.bounds[i + 1])
        low, high = self.bounds[i], self.bounds[i + 1]
        out = [(2 * i, 2 * (high - 1))]
        if 100 * n >= self.percent * high:  # a partner may be in the next class
            out.append((2 * i + 1, high - 1 + 100 * (high - 1) // self.percent))
        if i and self.percent * n <= 100 * (low - 1):  # or in the one before
            out.append((2 * i - 1, low - 1 + 100 * (low - 1) // self.percent))
        found = [(tag, self.differ(total)) for tag, total in out]
        # sets that cannot differ are equal, which is a class already
        return [(tag, d + 1 + self.spare(tag, d), 1 + self.spare(tag, d)) for tag, d in found if d]

    def spare(self, tag: int, d: int) -> int:
        """Parts beyond d + 1: a few empty parts do no harm, and linking pairs share several; depends on the tag alone."""
        i = (tag + 1) // 2
        smallest = self.bounds[i] if tag % 2 == 0 else max(1, self.percent * self.bounds[i] // 100)
        return 2 + d // 4 + math.ceil(2 * (d + 1) * math.exp(-smallest / (d + 1)))

    def signatures(self, s: np.ndarray) -> np.ndarray:
        return self.entries(s)[0]

    def entries(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Signatures of a set, with the tag of each and the number of them that it shares at least with any partner in that tag."""
        n = len(s)
        none = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        if not n:
            return none
        out, tags, needs = [], [], []
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(s, 1), dtype=np.uint64)])
            for tag, parts, untouched in self.tags(n):
                cuts = (np.arange(1, parts) * ((1 << 64) / parts)).astype(np.uint64) if parts > 1 else np.zeros(0, np.uint64)
                at = np.concatenate([[0], np.searchsorted(s, cuts), [n]])
                many = np.diff(at)
                sig = _mix(sums[at[1:]] - sums[at[:-1]] + many.astype(np.uint64), 2)
                sig = _mix(sig + _mix(np.arange(parts, dtype=np.uint64) + np.uint64(tag << 32), 5), 7)
                # an untouched part is sure to have members unless as many parts are empty
                empty = int((many == 0).sum())
                out.append(sig if empty >= untouched else sig[many > 0])
                tags.append(np.full(len(out[-1]), tag, np.int32))
                needs.append(np.full(len(out[-1]), max(1, untouched - empty), np.int32))
        return (np.concatenate(out), np.concatenate(tags), np.concatenate(needs)) if out else none


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key, n_shingles and a 128-bit key of the set."""

    def task(batches):
        for b in sliced(batches):
            sets = shingle_sets(C.column(b, "text"), width)
            keys = [[int(x) for x in (_mix(s, 21).sum(dtype=np.uint64), _mix(s, 22).sum(dtype=np.uint64))] for s in sets]
            k = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [C.column(b, "doc_id").cast(pa.int64()), C.column(b, "text_key"), pa.array(np.array([len(s) for s in sets], np.int64)),
                 pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy())], names=["doc_id", "text_key", "n_shingles", "k1", "k2"])

    return docs.select("doc_id", "text", C.text_key().alias("text_key")).mapInArrow(task, SKETCH)


def signature_slices(docs: DataFrame, width: int, percent: int, shift: int) -> DataFrame:
    """(part, keys): the signatures that a slice of documents has, by hash partition (2^shift of them), cut to 32 bits
    and packed; one that several documents of the slice have stands there twice."""

    def task(batches):
        router = Router(percent)
        for b in sliced(batches):
            # rows of one document count once
            own: dict[int, list[np.ndarray]] = {}
            for i, s in zip(C.column(b, "doc_id").to_pylist(), shingle_sets(C.column(b, "text"), width)):
                own.setdefault(i, []).append(router.signatures(s))
            found, many = np.unique(np.concatenate([np.unique(np.concatenate(x)) for x in own.values()]), return_counts=True)
            if not len(found):
                continue
            found = np.repeat(found, np.minimum(many, 2))
            part = (found >> np.uint64(64 - shift)).astype(np.int32)
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            low = ((found << np.uint64(shift)) >> np.uint64(32)).astype("<u4")
            packed = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(low)])
            yield pa.RecordBatch.from_arrays([pa.array(part[at[:-1]]), packed], names=["part", "keys"])

    return docs.select("doc_id", "text").mapInArrow(task, "part int, keys binary")


def shared_bits(slices: DataFrame, shift: int, least: int | None = None) -> bytes:
    """Bitmap over the high bits of signatures: each one that two documents or more have has its bit set.

    The shared signatures are counted first and get eight bits each (2^``least`` bits at least, 2^``MOST_BITS`` at most).
    """

    def several(t: pa.Table) -> pa.Table:
        keys, many = np.unique(np.frombuffer(b"".join(t["keys"].to_pylist()), "<u4"), return_counts=True)
        keys = keys[many > 1]
        return pa.table({"part": t["part"].slice(0, 1), "keys": pa.array([keys.tobytes()], pa.binary()), "many": pa.array([len(keys)], pa.int64())})

    dealt = slices.repartition(max(2, min(1 << shift, 8192)), "part").groupBy("part")
    found = C.stored(dealt.applyInArrow(several, "part int, keys binary, many long"), "shared-keys")
    many = found.agg(F.sum("many")).first()[0] or 0
    bits = max(BITS if least is None else least, shift + 3, min(MOST_BITS, math.ceil(math.log2(max(1, 8 * many)))))

    def segments(batches):
        for b in batches:
            out = []
            for keys in C.column(b, "keys"):
                segment = np.zeros(1 << (bits - shift), bool)
                segment[np.frombuffer(keys.as_buffer(), "<u4") >> np.uint32(32 - (bits - shift))] = True
                out.append(np.packbits(segment, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([C.column(b, "part"), pa.array(out, pa.binary())], names=["part", "bits"])

    step = (1 << (bits - shift)) // 8
    out = bytearray(step << shift)
    for row in found.select("part", "keys").mapInArrow(segments, "part int, bits binary").collect():  # 2^bits bits in all, at most 64 MB
        out[row["part"] * step:(row["part"] + 1) * step] = row["bits"]
    C.drop(found)
    return bytes(out)


def postings(docs: DataFrame, marks: bytes, width: int, percent: int) -> DataFrame:
    """(doc_id, sig, tag, need) of the documents' signatures whose bit is set, where they are as many of a tag as any partner shares."""
    shared, bits = docs.sparkSession.sparkContext.broadcast(marks), (8 * len(marks)).bit_length() - 1

    def task(batches):
        router, on = Router(percent), np.frombuffer(shared.value, np.uint8)
        for b in sliced(batches):
            found = []
            for s in shingle_sets(C.column(b, "text"), width):
                sig, tag, need = router.entries(s)
                bit = sig >> np.uint64(64 - bits)
                set_ = (on[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                # every signature that a partner has too is set, so fewer than it shares are chance or a common passage
                kind, at = np.unique(tag, return_inverse=True)
                set_ &= (np.bincount(at[set_], minlength=len(kind))[at] >= need) if len(kind) else set_
                found.append((sig[set_], tag[set_], need[set_]))
            owner = np.repeat(np.arange(len(found)), [len(x) for x, *_ in found])
            sig, tag, need = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([C.column(b, "doc_id").cast(pa.int64()).take(pa.array(owner)), pa.array(sig.view(np.int64)), pa.array(tag), pa.array(need)],
                                             names=["doc_id", "sig", "tag", "need"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, sig long, tag int, need int")


def shared_groups(posts: DataFrame) -> DataFrame:
    """(sig, node, least): signatures that several documents have, of documents that share as many of a tag as a partner asks for.

    A document that shares fewer (one passage, say) has no partner in that tag; what it leaves
    behind is looked at once more. Stored, as ``posts`` must be, which is read up and dropped.
    """
    for _ in range(2):
        least = posts.groupBy("sig").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("sig", "least")
        open_ = C.stored(posts.join(least, "sig"), "shared")
        C.drop(posts)
        enough = open_.groupBy("doc_id", "tag").agg(F.count_distinct("sig").alias("n"), F.min("need").alias("need")).where("n >= need").select("doc_id", "tag")
        posts = C.stored(open_.drop("least").join(enough, ["doc_id", "tag"]), "posts")
        C.drop(open_)
    least = posts.groupBy("sig").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("sig", "least")
    groups = C.stored(posts.join(least, "sig").select("sig", F.col("doc_id").alias("node"), "least").distinct(), "groups")
    C.drop(posts)
    return groups


def divide_skip(query: np.ndarray, sets: list[np.ndarray], need: np.ndarray, mu: float = 0.02) -> np.ndarray:
    """Overlap of each set with the query where it reaches ``need`` (else -1), by T-occurrence search.

    The query's shingles have an inverted list of the sets each. The ``long`` longest lists
    are set aside, the others merged and counted; a set that has at least its need less
    ``long`` is then looked up in the long lists by binary search.
    """
    out = np.full(len(sets), -1, np.int64)
    if not len(sets) or not len(query):
        return out
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.searchsorted(query, tokens)
    hit = at < len(query)
    hit[hit] = query[at[hit]] == tokens[hit]
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")  # lists by shingle, each in ascending set order
    at, owner = at[order], owner[order]
    first = np.searchsorted(at, np.arange(len(query) + 1))
    length = np.diff(first)
    t = max(1, int(need.min()))
    long = min(t - 1, int(t / (mu * math.log2(max(2, int(length.max(initial=1)))) + 1)))
    by_length = np.argsort(-length, kind="stable")
    far = by_length[:long]
    near = np.ones(len(query), bool)
    near[far] = False
    count = np.bincount(owner[near[at]], minlength=len(sets))
    for c in np.flatnonzero(count >= np.maximum(need - long, 1)).tolist():
        n = int(count[c])
        for k, x in enumerate(far.tolist()):
            if n + long - k < need[c]:
                break
            lst = owner[first[x]:first[x + 1]]
            p = int(np.searchsorted(lst, c))
            n += p < len(lst) and lst[p] == c
        if n >= need[c]:
            out[c] = n
    return out


def verify(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (node, root) edges whose sets link; ``sets`` holds (node, tokens) of all nodes, ``w`` of an edge its node's set size."""
    pieces = edges.groupBy("root").agg(F.ceil((F.sum("w") + 1) / PIECE_SHINGLES).cast("int").alias("pieces"))
    salted = edges.join(pieces, "root").select("node", "root", F.pmod(F.xxhash64("node", "root"), F.col("pieces")).alias("salt"))
    members = salted.join(sets, "node").select("root", "salt", "node", F.lit(False).alias("query"), "tokens")
    queries = salted.select("root", "salt").distinct().join(sets.withColumnRenamed("node", "root"), "root").select("root", "salt", F.col("root").alias("node"), F.lit(True).alias("query"), "tokens")

    def search(pdf):
        import pandas as pd

        mine = pdf["query"].to_numpy(bool)
        sets_ = [np.frombuffer(x, "<u8") for x in pdf["tokens"]]
        rest = [s for s, q in zip(sets_, mine) if not q]
        nodes = pdf["node"].to_numpy()[~mine]
        size = np.array([len(s) for s in rest], np.int64)
        linked = np.zeros(len(rest), bool)
        for q in (s for s, m in zip(sets_, mine) if m):
            need = -(-percent * (size + len(q)) // (100 + percent))
            linked |= divide_skip(q, rest, need) >= 0
        C.release()
        return pd.DataFrame({"node": nodes[linked], "root": np.full(linked.sum(), pdf["root"].iloc[0])}).drop_duplicates()

    return members.unionByName(queries).groupBy("root", "salt").applyInPandas(search, "node long, root long")


def search_block(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between documents of different labels that merge them: T-occurrence search over the block.

    ``side`` is 0 for all documents if every pair counts, else 0 and 1: only pairs of both sides.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    _, token, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((token, many[token], owner))  # each document's shingles, shortest lists first
    begin = np.cumsum(size) - size
    need = -(-percent * size // 100)  # least overlap with any partner
    keep = np.arange(len(order)) - np.repeat(begin, size) < np.repeat(size - need + 1, size)
    at, who = token[order][keep], owner[order][keep]  # entries of the short lists
    by = np.argsort(at, kind="stable")
    lists, members = at[by], who[by]
    first, last = np.searchsorted(lists, at, "left"), np.searchsorted(lists, at, "right")
    entry = np.searchsorted(who, np.arange(n + 1))
    label, links, mark = label.copy(), [], np.zeros(len(many), bool)
    for d in range(n):
        spans = [(a, b) for a, b in zip(first[entry[d]:entry[d + 1]], last[entry[d]:entry[d + 1]]) if b - a > 1]
        if not spans:
            continue
        found = np.unique(np.concatenate([members[a:b] for a, b in spans]))
        found = found[found < d]
        if side.any():
            found = found[side[found] != side[d]]
        both = size[found] + size[d]
        found = found[(100 * np.minimum(size[found], size[d]) >= percent * np.maximum(size[found], size[d])) & (both > 0)]
        mark[token[begin[d]:begin[d] + size[d]]] = True
        batch = 32
        while True:
            found = found[label[found] != label[d]]
            if not len(found):
                break
            some, found, batch = found[:batch], found[batch:], 1024
            # the long lists are probed for the documents found: which of their shingles does the query have
            lens = size[some]
            stop = np.cumsum(lens)
            has = mark[token[np.arange(stop[-1]) + np.repeat(begin[some] - stop + lens, lens)]]
            overlap = np.add.reduceat(has, stop - lens, dtype=np.int64)
            for c in some[(100 + percent) * overlap >= percent * (lens + size[d])].tolist():
                if label[c] != label[d]:
                    links.append((d, c))
                    label[label == max(label[c], label[d])] = min(label[c], label[d])
        mark[token[begin[d]:begin[d] + size[d]]] = False
    return links


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) links that merge components inside blocks; ``members`` holds (block, node, label)."""
    sized = members.join(sets.groupBy("node").agg(F.max(F.octet_length("tokens")).alias("w")), "node")
    summed = cumulative_sum(sized.select("block", "label", "node", (F.col("w") / 8).cast("long").alias("w")), ["block"], ["label", "node"], ["w"])
    chunked = C.stored(summed.select("block", "node", "label", F.floor((F.col("w_cum") - F.col("w")) / CHUNK_SHINGLES).cast("int").alias("chunk")), "chunks")
    chunks = chunked.groupBy("block", "chunk").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    other = chunks.select("block", F.col("chunk").alias("chunk2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    # one row per pair of chunks, never of documents
    pairs = (chunks.join(other, "block").where("chunk <= chunk2").where("not (low = high and low2 = high2 and low = low2)")
             .select("block", "chunk", "chunk2"))
    tasks = pairs.select("block", "chunk", "chunk2", F.explode(F.when(F.col("chunk") == F.col("chunk2"), F.array("chunk")).otherwise(F.array("chunk", "chunk2"))).alias("part"))
    rows = tasks.join(chunked.withColumnRenamed("chunk", "part"), ["block", "part"]).join(sets, "node")

    def search(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["label", "node"], kind="stable")
        nodes = pdf["node"].to_numpy()
        side = (pdf["part"] == pdf["chunk2"]).to_numpy(np.int64) if (pdf["chunk"] != pdf["chunk2"]).any() else np.zeros(len(pdf), np.int64)
        links = search_block([np.frombuffer(x, "<u8") for x in pdf["tokens"]], pdf["label"].to_numpy(), side, percent)
        C.release()
        return pd.DataFrame({"node": [nodes[max(a, b, key=lambda i: nodes[i])] for a, b in links],
                             "root": [nodes[min(a, b, key=lambda i: nodes[i])] for a, b in links]}, dtype="int64")

    return rows.groupBy("block", "chunk", "chunk2").applyInPandas(search, "node long, root long")


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id of every row."""
    rows = C.stored(sketches(docs, width), "sketches")
    real = rows.where("n_shingles > 0 and doc_id is not null")
    classes = C.stored(real.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    # signatures of class representatives only, and only those that another document may have
    reps = C.stored(real.join(classes, ["k1", "k2"]).where("doc_id = rep").select("doc_id", "text_key", "n_shingles"), "reps")
    mine = C.by_row(docs.select("doc_id", "text"), reps.drop("n_shingles"), "left_semi")
    shingles = reps.agg(F.sum("n_shingles")).first()[0] or 0
    shift = min(20, BITS - 3, max(1, math.ceil(math.log2(max(1, shingles / MASS)))))
    marks = shared_bits(signature_slices(mine, width, percent, shift), shift)
    open_ = shared_groups(C.stored(postings(mine, marks, width, percent), "posts"))
    nodes = open_.select("node").distinct()
    many = nodes.count()
    ids = (F.broadcast(nodes) if many <= BROADCAST_IDS else nodes).withColumnRenamed("node", "doc_id")

    def tokens(batches):
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([C.column(b, "doc_id").cast(pa.int64()), pa.array([s.astype("<u8").tobytes() for s in shingle_sets(C.column(b, "text"), width)], pa.binary())],
                                             names=["node", "tokens"])

    sets = C.stored(docs.where("doc_id is not null and text is not null").select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(tokens, "node long, tokens binary"), "sets")
    # documents whose rows are in several classes
    twice = real.join(classes, ["k1", "k2"]).groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.collect_set("rep").alias("r")).where("a < b")
    links = C.stored(twice.select(F.explode("r").alias("node"), F.col("a").alias("root")).where("node != root"), "links")
    sizes = reps.groupBy(F.col("doc_id").alias("node")).agg(F.max("n_shingles").alias("w"))
    nearest = C.stored(open_.where("least < node").groupBy("node").agg(F.min("least").alias("root")).join(sizes, "node"), "nearest")
    links = links.unionByName(C.stored(verify(nearest, sets, percent), "links"))
    labels = components(links)
    # signature groups that hold several components still
    state = open_.join(labels, "node", "left").select("sig", "node", F.coalesce("label", "node").alias("label"))
    mixed = state.groupBy("sig").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.min("node").alias("least")).where("a < b").select("sig", "least")
    live = C.stored(state.join(mixed, "sig").select("node", "label", "least").distinct(), "open")
    if live.take(1):
        blocks = components(live.select("node", F.col("least").alias("root")))
        members = (live.select("node", "label").distinct().join(blocks.withColumnRenamed("label", "block"), "node", "left")
                   .select(F.coalesce("block", "node").alias("block"), "node", "label"))
        links = links.unionByName(C.stored(block_links(C.stored(members, "blocks"), sets, percent), "links"))
        labels = components(links)
    out = rows.join(classes, ["k1", "k2"], "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    inside = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return out.select("doc_id", "text_key", "n_shingles", F.when(inside, F.coalesce("label", "rep")).otherwise(F.col("doc_id")).alias("component_id"))


def op3_ngram_jaccard(spark, sf_dir):
    return join(C.table(spark, sf_dir, "documents")).drop("text_key")
