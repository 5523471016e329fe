"""Best-fit packing of token pieces into sequences by linear grouping.

The packing is solved on the histogram of piece lengths (at most ``size`` cells,
whatever the input), and the solution is a short list of *patterns*: the lengths in
one sequence, and how many sequences look like it.

1. Large lengths are put in groups of equal cardinality; each is rounded up to its
   group's largest length, which leaves few sizes.
2. Configurations of those few sizes are optimised: the largest remaining size with its
   fullest completion (dynamic programming over the capacity) is used as often as the
   remaining counts allow, then the next.
3. Actual lengths are substituted for the rounded ones, which opens some space.
4. Small pieces go best-fit, longest first, into what is left, then into new sequences.

The assignment of documents is distributed: pieces are ranked within (length, salt),
which splits a hot length, ranks are shifted by a prefix sum over the salts, and a
piece's rank finds its run of equal slots. Only the runs (bounded by the number of
patterns) are sent to the tasks.

Defined cases: a null or empty text is one piece (its end id); rows with null or
repeated doc_id are packed as documents of their own; an empty table gives no rows;
extra columns of the input are ignored unless carried.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

SIZE, END_ID, GROUPS, SMALL = 1024, 2, 1023, 0.25
#: Rows of one (length, salt) cell when a third of all pieces have one length.
CELL_ROWS = 50_000
#: Slices of texts after which a worker gives freed memory back.
RELEASE = 16
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """Token pieces of every row: ids (little-endian unsigned 32-bit) with the end id,
    cut into ``size``-token pieces where longer; the first piece takes the remainder."""

    def cut(batches):
        enc = T.encoder(vocabulary)
        for turn, b in enumerate(C.slices(batches)):
            if turn % RELEASE == RELEASE - 1:
                C.release()
            flat, off = enc.encode(C.column(b, "text"))
            n = np.diff(off) + 1
            data = np.insert(flat, off[1:], end_id).astype("<u4").tobytes()
            begin = np.concatenate([[0], np.cumsum(n)])[:-1]
            parts = -(-n // size)
            row = np.repeat(np.arange(len(n)), parts)
            k = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            head = n - (parts - 1) * size
            start = np.where(k == 0, 0, head[row] + (k - 1) * size)
            length = np.where(k == 0, head[row], size)
            edges = np.concatenate([(begin[row] + start) * 4, [len(data)]]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [C.column(b, "doc_id").cast(pa.int64()).take(pa.array(row)), pa.array(k.astype(np.int32)), pa.array(start), pa.array(length), ids],
                names=["doc_id", "piece", "start", "length", "ids"])
        C.release()

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


# ---------------------------------------------------------------- the packing of a histogram

def _groups(lengths: np.ndarray, counts: np.ndarray, groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) lists of equal cardinality, longest first; a length may be split over groups."""
    total = int(counts.sum())
    out, cur, room = [], [], -(-total // groups) if total else 0
    for length, count in zip(lengths[::-1].tolist(), counts[::-1].tolist()):
        while count:
            take = min(count, room)
            cur.append((length, take))
            count, room = count - take, room - take
            if not room:
                out.append(cur)
                cur, room = [], -(-total // groups)
    if cur:
        out.append(cur)
    return out


def _configuration(sizes: list[int], left: list[int], size: int) -> dict[int, int]:
    """Multiset of groups (group -> times): the largest remaining size and the fullest
    completion that the counts allow (bounded knapsack on bit sets; larger sizes first)."""
    top = next(g for g in range(len(sizes)) if left[g])
    room = size - sizes[top]
    reach, layers = 1, []  # bit s: total s can be reached
    order = [g for g in range(len(sizes)) if left[g] > (g == top) and sizes[g] <= room]
    for g in reversed(order):  # smaller sizes below, so that the walk back prefers larger ones
        layers.append((g, reach))
        times, step = min(left[g] - (g == top), room // sizes[g]), 1
        while times:
            step = min(step, times)
            reach |= reach << (sizes[g] * step)
            times, step = times - step, step * 2
        reach &= (1 << (room + 1)) - 1
    total, pick = reach.bit_length() - 1, {top: 1}
    for g, below in reversed(layers):
        while total >= sizes[g] and not below >> total & 1:
            total -= sizes[g]
            pick[g] = pick.get(g, 0) + 1
    return pick


def _substitute(pick: dict[int, int], copies: int, stock: list[list[tuple[int, int]]]) -> list[tuple[int, tuple[int, ...]]]:
    """Replace rounded sizes by actual lengths of the groups' stock: (copies, lengths) rows."""
    slots = []
    for g, times in pick.items():
        for _ in range(times):
            need, run = copies, []
            while need:
                length, count = stock[g][-1]
                take = min(count, need)
                run.append((length, take))
                need -= take
                if take == count:
                    stock[g].pop()
                else:
                    stock[g][-1] = (length, count - take)
            slots.append(run)
    out = []
    while copies:
        take = min(run[0][1] for run in slots)
        out.append((take, tuple(run[0][0] for run in slots)))
        for run in slots:
            if run[0][1] == take:
                run.pop(0)
            else:
                run[0] = (run[0][0], run[0][1] - take)
        copies -= take
    return out


def _best_fit(bins: list[tuple[int, tuple[int, ...]]], small: list[tuple[int, int]], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit of (length, count) rows, longest first, into classes of equal sequences."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for copies, lengths in bins:
        by_room.setdefault(size - sum(lengths), []).append((copies, lengths))
    rooms = sorted(by_room)

    def add(room: int, entry: tuple[int, tuple[int, ...]]) -> None:
        if room not in by_room or not by_room[room]:
            if room not in by_room:
                by_room[room] = []
            i = bisect_left(rooms, room)
            if i == len(rooms) or rooms[i] != room:
                rooms.insert(i, room)
        by_room[room].append(entry)

    for length, count in small:
        while count:
            i = bisect_left(rooms, length)
            while i < len(rooms) and not by_room[rooms[i]]:
                rooms.pop(i)
            if i == len(rooms):
                room, copies, lengths = size, -(-count // (size // length)), ()
            else:
                room = rooms[i]
                copies, lengths = by_room[room].pop()
            each = min(room // length, count)  # best fit keeps filling the same sequence
            full = min(copies, count // each)
            if full < copies and lengths:
                add(room, (copies - full, lengths))
            add(room - each * length, (full, (*lengths, *[length] * each)))
            count -= full * each
    return [e for room in by_room.values() for e in room if e[0]]


def solve(histogram: dict[int, int], size: int = SIZE, groups: int = GROUPS, small: float = SMALL) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (number of sequences, lengths in each) that hold exactly the given counts of lengths."""
    rest = {n: c for n, c in histogram.items() if c and n < size}
    out = [(histogram[size], (size,))] if histogram.get(size) else []
    big = sorted(n for n in rest if n > small * size)
    grouped = _groups(np.array(big, np.int64), np.array([rest[n] for n in big], np.int64), groups)
    stock = [sorted(g) for g in grouped]  # longest at the end
    sizes, left = [max(n for n, _ in g) for g in grouped], [sum(c for _, c in g) for g in grouped]
    bins = []
    while any(left):
        pick = _configuration(sizes, left, size)
        copies = min(left[g] // times for g, times in pick.items())
        for g, times in pick.items():
            left[g] -= copies * times
        bins += _substitute(pick, copies, stock)
    return out + _best_fit(bins, sorted(((n, c) for n, c in rest.items() if n <= small * size), reverse=True), size)


# ---------------------------------------------------------------- assignment

def runs(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first ranks of its runs of slots, the first sequence of each and the slot's offset."""
    taken: dict[int, int] = {}
    table: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for copies, lengths in patterns:
        at = 0
        for n in lengths:
            table.setdefault(n, []).append((taken.get(n, 0), base, at))
            taken[n] = taken.get(n, 0) + copies
            at += n
        base += copies
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in table.items()}


def pack(parts: DataFrame, carry: dict[str, Column] | None = None, size: int = SIZE) -> DataFrame:
    """``parts`` (with a ``length`` column, stored) plus ``sequence_id`` and ``offset``.

    ``carry`` names the columns to take along, so that ids need not be shuffled when
    only a digest of them is wanted; default: all columns.
    """
    spark = parts.sparkSession
    cells = parts.groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in cells.collect()}  # at most ``size`` rows
    table = spark.sparkContext.broadcast(runs(solve(histogram, size)))
    salts = max(16, -(-sum(histogram.values()) // CELL_ROWS))
    cols = {c: F.col(c) for c in parts.columns} if carry is None else carry
    salt = F.pmod(F.xxhash64(*[c for c in ("doc_id", "piece", "start") if c in parts.columns]), F.lit(salts)).cast("int")
    flat = parts.select(*(c.alias(n) for n, c in cols.items()), F.col("length").alias("_n"), salt.alias("_salt"))
    ranked = flat.withColumn("_rank", F.row_number().over(Window.partitionBy("_n", "_salt").orderBy(F.lit(0))).cast("long") - 1)
    sums = parts.select(F.col("length").alias("_n"), salt.alias("_salt")).groupBy("_n", "_salt").count()
    before = sums.select("_n", "_salt", (F.sum("count").over(Window.partitionBy("_n").orderBy("_salt")) - F.col("count")).alias("_before"))
    placed = ranked.join(before, ["_n", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    keep = list(cols)

    def find(batches):
        T.forget()  # the worker may have cut pieces before
        for b in batches:
            n, rank = C.column(b, "_n").to_numpy(), C.column(b, "_rank").to_numpy()
            seq, off = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for length in np.unique(n).tolist():
                first, base, at = table.value[length]
                mine = np.flatnonzero(n == length)
                k = np.searchsorted(first, rank[mine], "right") - 1
                seq[mine], off[mine] = base[k] + rank[mine] - first[k], at[k]
            yield pa.RecordBatch.from_arrays([*(C.column(b, c) for c in keep), pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.select(*keep).schema)
    return placed.select(*keep, "_n", "_rank").mapInArrow(find, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, carry: dict[str, Column] | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` with their place; ``carry`` as in ``pack`` over the columns of ``pieces``."""
    return pack(C.stored(pieces(docs, size, end_id), "pieces"), carry, size)


def op2_best_fit_packing(spark, sf_dir):
    digest = {c: F.col(c) for c in ("doc_id", "piece", "start", "length")} | {"ids_crc32": F.crc32("ids")}
    return pack_documents(C.table(spark, sf_dir, "documents"), digest)
