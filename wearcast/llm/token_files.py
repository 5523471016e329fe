"""Token-id files: raw id payload shards and a minimal perfect hash index over document keys.

Files under ``path`` (a folder all executors share):

* ``shard-00000.ids``: little-endian ids of documents in ascending doc_id order, each with
  its end id, two bytes an id where the vocabulary allows, else four; shard numbers follow
  the key order;
* ``index-00000.mph``: keys with ``bucket(key) == number``. A minimal perfect hash
  (levels of bit arrays) maps a key to a slot; a slot stores the key's fingerprint,
  shard, first id and number of documents. A look-up takes a few hashes and one slot
  whatever the number of documents, and a key that was not stored is refused by its
  fingerprint (64 bits, independent of the slot hash).

Writing: one range shuffle on (doc_id, text hash), then each task streams its sorted
rows through the tokenizer into one shard; index buckets are hash partitions of the
small (key, place) rows. Tasks write to a temporary name and move it, so a retried
task replaces equal bytes.

Defined cases: null text is an empty document (its end id only); rows with one doc_id
are stored next to each other ordered by text hash, and the key's slot spans them (number
of documents, and their lengths behind the slots; ``nth`` counts them); null keys are
stored under the key ``NULL_KEY`` behind all others; an empty table gives no files and no
rows. Extra columns of the input are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

END_ID = 0
NULL_KEY = np.iinfo(np.int64).max
SHARD_CHARS, INDEX_KEYS = 64_000_000, 50_000
PLACES = "key long, nth int, shard int, first long, n_tokens int"


def mix(x: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) of int64 keys under a seed, or a seed for each."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + (np.atleast_1d(np.asarray(seed, np.uint64)) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct int64 keys, slots 0 to n - 1, by levels of bit arrays.

    On each level the remaining keys are hashed into twice as many bits; a key alone on its
    bit stays there, the others go to the next level. A key's slot is the number of set bits
    before its own, so a look-up takes the same few steps whatever the number of keys.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes.astype(np.int64), bits
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)
        self.n = int(self.rank[-1])

    @staticmethod
    def build(keys: np.ndarray) -> "PerfectHash":
        rest, sizes, bits = keys, [], []
        while len(rest):
            m = max(64, 2 * len(rest))
            at = (mix(rest, len(sizes) + 2) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            bits.append(alone)
            rest = rest[~alone[at]]
        return PerfectHash(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not built in gets any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = base + (mix(keys[left], level + 2) % np.uint64(m)).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + m
        return out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys, 0) % np.uint64(buckets)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return mix(keys, (1 << 40) + 11)


SLOT = np.dtype([("print", "<u8"), ("shard", "<u4"), ("docs", "<u4"), ("first", "<u8"), ("at", "<u8")])
HEAD = np.dtype([("magic", "S8"), ("keys", "<u8"), ("levels", "<u8"), ("lengths", "<u8")])


def index_bytes(keys: np.ndarray, shard: np.ndarray, first: np.ndarray, docs: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> bytes:
    """File form of one index bucket: head, level sizes, level bits, slots, and the lengths of each key's documents."""
    mph = PerfectHash.build(keys)
    slots = np.zeros(len(keys), SLOT)
    s = mph.slot(keys)
    slots["print"][s], slots["shard"][s], slots["first"][s] = fingerprint(keys), shard, first
    slots["docs"][s], slots["at"][s] = docs, at
    head = np.array([(b"TOKMPH1", len(keys), len(mph.sizes), len(lengths))], HEAD)
    return head.tobytes() + mph.sizes.astype("<u8").tobytes() + np.packbits(mph.bits).tobytes() + slots.tobytes() + lengths.astype("<u4").tobytes()


class Index:
    """Constant-time look-ups in one index bucket file."""

    def __init__(self, raw: bytes):
        head = np.frombuffer(raw, HEAD, 1)[0]
        if head["magic"] != b"TOKMPH1":
            raise ValueError("not an index bucket")
        k, at = int(head["keys"]), HEAD.itemsize
        sizes = np.frombuffer(raw, "<u8", int(head["levels"]), at)
        at += 8 * len(sizes)
        total = int(sizes.sum())
        packed = np.frombuffer(raw, np.uint8, -(-total // 8), at)
        at += len(packed)
        self.mph = PerfectHash(sizes, np.unpackbits(packed, count=total).astype(bool))
        self.slots = np.frombuffer(raw, SLOT, k, at)
        self.lengths = np.frombuffer(raw, "<u4", int(head["lengths"]), at + SLOT.itemsize * k)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where its fingerprint differs."""
        s = self.mph.slot(keys)
        if not self.mph.n:
            return s
        return np.where((s >= 0) & (self.slots["print"][s] == fingerprint(keys)), s, -1)


def _put(path: str, name: str, raw) -> None:
    fs, base = C.shared_fs(path)
    tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as f:
        f.write(raw)
    C.publish(fs, tmp, f"{base}/{name}")


def _get(path: str, name: str) -> bytes:
    fs, base = C.shared_fs(path)
    with fs.open_input_file(f"{base}/{name}") as f:
        return f.read()


def write(docs: DataFrame, path: str, end_id: int = END_ID, vocabulary: str | None = None) -> dict:
    """Write shards and index of ``docs`` under ``path``; returns the manifest (shard bases, buckets)."""
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(int(NULL_KEY)))
    rows = docs.select(key.alias("key"), "text", C.text_key().alias("tie"))
    total = docs.select(F.sum(F.length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-total // SHARD_CHARS))
    fs, base = C.shared_fs(path)
    fs.create_dir(base, recursive=True)
    width = 2 if T.encoder(vocabulary).small and end_id < 65536 else 4

    def shard_task(batches):
        from pyspark import TaskContext

        shard, first = TaskContext.get().partitionId(), 0
        fs, base = C.shared_fs(path)
        name, out, tmp = f"shard-{shard:05d}.ids", None, None
        last, nth = None, 0
        for b in C.slices(batches):
            if out is None:
                tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
                out = fs.open_output_stream(tmp)
            flat, off = T.encoder(vocabulary).encode(C.column(b, "text"))
            n = np.diff(off) + 1
            out.write(np.insert(flat, off[1:], end_id).astype(f"<u{width}").tobytes())
            keys = C.column(b, "key").to_numpy()
            which = np.zeros(len(keys), np.int32)
            for i in range(len(keys)):  # rows of one key follow each other
                nth = nth + 1 if keys[i] == last else 0
                last, which[i] = keys[i], nth
            begin = first + np.cumsum(n) - n
            first += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(which), pa.array(np.full(len(n), shard, np.int32)), pa.array(begin), pa.array(n.astype(np.int32))],
                names=["key", "nth", "shard", "first", "n_tokens"])
        if out is not None:
            out.close()
            C.publish(fs, tmp, f"{base}/{name}")

    ordered = rows.repartitionByRange(shards, "key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    places = C.stored(ordered.mapInArrow(shard_task, PLACES), "places")

    # bases of the shards: one row per shard
    sizes = {r["shard"]: (r["t"], r["n"]) for r in places.groupBy("shard").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()}
    bases, ids, n_docs = {}, 0, 0
    for s in sorted(sizes):
        bases[s] = ids
        ids, n_docs = ids + sizes[s][0], n_docs + sizes[s][1]
    buckets = max(1, -(-n_docs // INDEX_KEYS), min(n_docs, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))

    def bucketed(batches):
        for b in batches:
            keys = C.column(b, "key").to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bucket_of(keys, buckets).astype(np.int32))], names=[*b.schema.names, "bucket"])

    def index_task(pdf):
        pdf = pdf.sort_values(["key", "shard", "first"], kind="stable")
        keys, at, docs = np.unique(pdf["key"].to_numpy(), return_index=True, return_counts=True)
        raw = index_bytes(keys, pdf["shard"].to_numpy()[at], pdf["first"].to_numpy()[at], docs, pdf["n_tokens"].to_numpy(), at)
        _put(path, f"index-{int(pdf['bucket'].iloc[0]):05d}.mph", raw)
        return pdf[["bucket"]].iloc[:1].assign(keys=len(keys))

    if n_docs:
        made = (places.mapInArrow(bucketed, PLACES + ", bucket int").groupBy("bucket")
                .applyInPandas(index_task, "bucket int, keys long").agg(F.sum("keys")).first()[0])
        if not made:
            raise RuntimeError("no index written")
    return {"path": path, "id_bytes": width, "bases": bases, "buckets": buckets, "documents": n_docs}


def locate(keys: DataFrame, manifest: dict) -> DataFrame:
    """Index entries of the keys (column ``key``): key, nth, shard, first, n_tokens; unknown keys give no row."""
    spark: SparkSession = keys.sparkSession
    path, buckets, bases = manifest["path"], manifest["buckets"], manifest["bases"]
    # 16 bytes a shard of many million characters
    shards = spark.sparkContext.broadcast((np.array(sorted(bases), np.int64), np.array([bases[s] for s in sorted(bases)], np.int64)))

    def bucketed(batches):
        for b in batches:
            k = C.column(b, "key").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(bucket_of(k, buckets).astype(np.int32))], names=["key", "bucket"])

    def look(pdf):
        import pandas as pd

        want = np.unique(pdf["key"].to_numpy())
        ix = Index(_get(path, f"index-{int(pdf['bucket'].iloc[0]):05d}.mph"))
        slot = ix.find(want)
        want, entry = want[slot >= 0], ix.slots[slot[slot >= 0]]
        docs = entry["docs"].astype(np.int64)
        row = np.repeat(np.arange(len(want)), docs)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(docs) - docs, docs)
        n = ix.lengths[entry["at"].astype(np.int64)[row] + nth].astype(np.int64)
        run = np.cumsum(n) - n
        numbers, bases = shards.value
        place = bases[np.searchsorted(numbers, entry["shard"][row])] + entry["first"].astype(np.int64)[row] + run - run[np.searchsorted(row, row)]
        at = np.searchsorted(bases, place, "right") - 1  # a key's span may run into the following shards
        shard, first = numbers[at], place - bases[at]
        return pd.DataFrame({"key": want[row], "nth": nth.astype(np.int32), "shard": shard.astype(np.int32), "first": first, "n_tokens": n.astype(np.int32)})

    return keys.mapInArrow(bucketed, "key long, bucket int").groupBy("bucket").applyInPandas(look, PLACES)


def read(keys: DataFrame, manifest: dict, gap: int = 1 << 16, most: int = 8 << 20) -> DataFrame:
    """Documents of the keys from the files: key, nth, start (ids of all documents before), n_tokens, ids (4 bytes each).

    Entries are dealt by shard and a block of its ids, sorted, and near ranges are read together.
    """
    path, bases, width = manifest["path"], manifest["bases"], manifest["id_bytes"]
    base = keys.sparkSession.sparkContext.broadcast(bases)

    def fetch(batches):
        fs, root = C.shared_fs(path)
        f, opened = None, None
        for b in batches:
            shard, first, n = (C.column(b, c).to_numpy().astype(np.int64) for c in ("shard", "first", "n_tokens"))
            cut = [0, *(np.flatnonzero((np.diff(shard) != 0) | (first[1:] - (first + n)[:-1] > gap) | (first[1:] < first[:-1])) + 1).tolist(), len(n)]
            parts = []
            for i, j in zip(cut[:-1], cut[1:]):
                while i < j:
                    k = max(i + 1, i + int(np.searchsorted((first + n)[i:j] - first[i], most // width, "right")))
                    parts.append((i, k))
                    i = k
            for i, j in parts:
                if opened != shard[i]:
                    opened, f = shard[i], fs.open_input_file(f"{root}/shard-{shard[i]:05d}.ids")
                f.seek(int(first[i]) * width)
                raw = np.frombuffer(f.read(int(first[j - 1] + n[j - 1] - first[i]) * width), f"<u{width}").astype("<u4")
                ids = [raw[a:a + m].tobytes() for a, m in zip((first[i:j] - first[i]).tolist(), n[i:j].tolist())]
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [C.column(part, "key"), C.column(part, "nth"), pa.array(first[i:j] + base.value[int(shard[i])]), C.column(part, "n_tokens"), pa.array(ids, pa.binary())],
                    names=["key", "nth", "start", "n_tokens", "ids"])

    found = locate(keys, manifest)
    block = F.floor(F.col("first") / F.lit(most))
    return (found.repartition(F.col("shard"), block).sortWithinPartitions("shard", "first")
            .mapInArrow(fetch, "key long, nth int, start long, n_tokens int, ids binary"))


def op6_token_output(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    manifest = write(docs, C.fresh_dir(spark, "token-files"))
    keys = docs.select(F.coalesce(F.col("doc_id"), F.lit(int(NULL_KEY))).alias("key"))
    out = read(keys, manifest)
    return out.select(F.when(F.col("key") != int(NULL_KEY), F.col("key")).alias("doc_id"), "start",
                      F.col("n_tokens").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
