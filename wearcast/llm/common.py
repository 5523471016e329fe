"""Helpers shared by the corpus operators: vectorised splitting of text columns
inside Arrow batches, shared-folder paths, and file access from tasks.

Text never leaves its Arrow buffer: words are found with byte look-up tables
over the UTF-8 data of a slice of rows (``slices`` bounds the bytes handled at
once, a single longer text forms a slice of its own) and are dictionary
encoded, so Python objects are only made for distinct words.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

SLICE_BYTES = 4 << 20
#: Texts that the pipeline hands to Python at once.
BATCH_ROWS = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder, worker imports and batch size, for callers that enter a stage directly."""
    ensure_checkpoint_dir(spark)
    # a batch of texts is held by the JVM and by Python at once
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of ``spark.checkpoint.dir`` (never a machine-local one on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once and survives lost executors."""
    path = fresh_dir(df.sparkSession, name)
    # without the marker file: on a local file system the driver starts a process (chmod) for every file it makes
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop(table: DataFrame) -> None:
    """Remove the files of a ``stored`` table that nothing reads any more, and the shuffle files of the jobs before it.

    Shuffle files go when the driver has collected the plan they belong to, which on its own it may not do for a whole stage.
    """
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()


def text_key(col: str = "text") -> Column:
    """64-bit key of a text; with doc_id it finds a row's decision again (null text: 0)."""
    return F.when(F.col(col).isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(F.col(col)))


def fold(n: int, col: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``n`` (null ids: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def smallest(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows of smallest key hash of each group (a bounded sample); ``rows`` are distinct.

    Groups are counted first and cut to about four times ``n`` rows by their hash, so no task
    ranks a whole group, however many of the rows it has.
    """
    h, many, rank = (f"{x}_{uuid.uuid4().hex}" for x in ("h", "many", "rank"))
    size = rows.groupBy(group).agg(F.count(F.lit(1)).alias(many))
    hashed = rows.join(size, group).withColumn(h, F.xxhash64(key))
    few = hashed.where((F.col(many) <= 4 * n) | (F.pmod(F.col(h), F.lit(1 << 40)) < F.lit(4.0 * n) / F.col(many) * float(1 << 40)))
    place = Window.partitionBy(group).orderBy(F.pmod(F.col(h), F.lit(1 << 40)), h, key)
    return few.withColumn(rank, F.row_number().over(place)).where(F.col(rank) <= n).drop(h, many, rank)


#: Decisions up to this many rows (16 bytes a row) are broadcast; more of them are joined by a shuffle.
BROADCAST_DECISIONS = 1_000_000


def by_row(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """Join ``docs`` with ``decisions`` (doc_id, text_key, ...) row by row, nulls equal to nulls.

    Decisions are functions of the id and the text, so equal rows share theirs. Key columns
    get names that no input has; the documents' own columns are left alone.
    """
    tag = uuid.uuid4().hex
    i, k, left = f"id_{tag}", f"key_{tag}", f"left_{tag}"
    small = decisions.dropDuplicates(["doc_id", "text_key"]).withColumnsRenamed({"doc_id": i, "text_key": k})
    if small.count() <= BROADCAST_DECISIONS:
        small = F.broadcast(small)
    keyed = docs.withColumn(left, text_key())
    on = keyed["doc_id"].eqNullSafe(small[i]) & (keyed[left] == small[k])
    return keyed.join(small, on, how).drop(i, k, left)


# ---------------------------------------------------------------- byte tables

def byte_table(pattern: str) -> np.ndarray:
    """Boolean table over byte values from ranges like ``"\\t-\\r "`` (a-b pairs and single characters)."""
    t, i = np.zeros(256, bool), 0
    while i < len(pattern):
        if i + 2 < len(pattern) and pattern[i + 1] == "-":
            t[ord(pattern[i]):ord(pattern[i + 2]) + 1] = True
            i += 3
        else:
            t[ord(pattern[i])] = True
            i += 1
    return t


WS = byte_table("\t-\r ")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Texts:
    """UTF-8 bytes and row offsets of a string array; nulls count as empty."""

    def __init__(self, arr: pa.Array):
        if isinstance(arr, pa.ChunkedArray):
            arr = arr.combine_chunks()
        self.null = np.asarray(arr.is_null())
        if arr.null_count:
            arr = arr.fill_null("")
        wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
        _, off, data = arr.buffers()
        off = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64) \
            if len(arr) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data, self.off = raw[off[0]:off[-1]], off - off[0]

    def __len__(self) -> int:
        return len(self.off) - 1

    def split(self, sep: np.ndarray, data: np.ndarray | None = None) -> "Runs":
        return Runs(self, sep, self.data if data is None else data)

    def per_row(self, mask: np.ndarray) -> np.ndarray:
        """Number of marked bytes of each row."""
        c = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.off[1:]] - c[self.off[:-1]]


class Runs:
    """Maximal runs of non-separator bytes, never across rows: ``row``, ``start``, ``end`` and dictionary codes."""

    def __init__(self, texts: Texts, sep: np.ndarray, data: np.ndarray):
        n, off = len(data), texts.off
        inside = ~sep[data]
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            full = off[:-1] < off[1:]
            begin, end = off[:-1][full], off[1:][full] - 1
            first[begin], last[end] = inside[begin], inside[end]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, off)  # first run of each row
        self.count = np.diff(self.bounds)
        self.row = np.repeat(np.arange(len(texts)), self.count)
        self._data, self._inside = data, inside

    def __len__(self) -> int:
        return len(self.start)

    def strings(self, kind=pa.string()) -> pa.Array:
        off = np.zeros(len(self) + 1, np.int32)
        np.cumsum(self.end - self.start, out=off[1:])
        return pa.Array.from_buffers(kind, len(self), [None, pa.py_buffer(off), pa.py_buffer(self._data[self._inside])])

    def codes(self, kind=pa.string()) -> tuple[np.ndarray, pa.Array]:
        """Code of each run and the distinct runs (in order of first appearance)."""
        if not len(self):
            return np.zeros(0, np.int64), pa.array([], kind)
        d = self.strings(kind).dictionary_encode()
        return d.indices.to_numpy().astype(np.int64), d.dictionary


def factor(codes: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense codes of an int64 array and their number (hash based, exact)."""
    out, uniques = pd.factorize(codes)
    return out, len(uniques)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` text bytes (or one longer text)."""
    for b in batches:
        if not b.num_rows:
            continue
        off = Texts(b.column(b.schema.get_field_index(text))).off
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield b.slice(i, j - i)
            i = j


def release() -> None:
    """Give freed memory back to the system: a worker lives on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


# ---------------------------------------------------------------- files

def shared_fs(path: str):
    """pyarrow file system and path for a folder that all executors share (file:, hdfs:, s3: ... or a plain path)."""
    import pyarrow.fs as pafs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def publish(fs, tmp: str, final: str) -> None:
    """Move a finished temporary file to its name; a retried task replaces the same bytes."""
    fs.move(tmp, final)
