"""Token ids of whole texts by a public tokenizer file, through the ``tokenizers`` library.

Byte-level BPE works on each pre-token alone, so ids are computed once per distinct
space-led chunk of a worker and looked up for its other occurrences. Cutting a text
in front of a space keeps the tokenizer's own pre-token borders unless the space
stands in a longer run of white space; such texts (and those that contain a special
token's string) are encoded whole. ``tests/llm`` holds the ids against plain
``encode`` on random texts.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from . import common as C

VOCABULARY = "byte_bpe_50k.json"
SPACE = C.byte_table(" ")
#: White-space runs whose pre-tokens reach over a cut in front of a space.
ODD_SPACE = re.compile(r"\s \s| \s* |\s $|^ $")
#: Bytes before and after a space that may belong to white space (ASCII, and lead bytes of wider spaces).
ASCII_WS = C.byte_table("\t-\r \x1c-\x1f")
WIDE_LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
MEMO_ENTRIES, PIECE_ENTRIES = 1_000_000, 100_000
#: ASCII marks that form one pre-token behind a word.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def default_vocabulary() -> str:
    """Path of the public vocabulary, looked up where the code runs (every worker has the package)."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def chunk_hash(words: C.Texts, led: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key and 32-bit check of each chunk from two polynomials over its bytes."""
    n, off = len(words), words.off
    size = np.diff(off)
    left = np.repeat(off[1:], size) - 1 - np.arange(len(words.data))  # bytes behind each byte
    out = []
    with np.errstate(over="ignore"):
        for step in (np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)):
            power = np.cumprod(np.full(int(size.max(initial=0)) + 1, step, np.uint64))
            h = np.zeros(n, np.uint64)
            full = np.flatnonzero(size)
            if len(full):
                h[full] = np.add.reduceat((words.data.astype(np.uint64) + np.uint64(1)) * power[left], off[:-1][full])
            h = (h + size.astype(np.uint64) * np.uint64(2) + led) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            out.append(h ^ (h >> np.uint64(32)))
    return out[0], out[1].astype(np.uint32)


def _append(kept: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``new`` behind the first ``used`` values; a full array is replaced by one with a quarter more room."""
    if used + len(new) > len(kept):
        kept = np.concatenate([kept[:used], np.zeros(len(new) + (used + len(new)) // 4, kept.dtype)])
    kept[used:used + len(new)] = new
    return kept


class Mapped(dict):
    """Character to its byte-mapped form, asked from the pre-tokenizer once per character."""

    def __init__(self, pre):
        self.pre = pre

    def __missing__(self, c: int) -> str:
        self[c] = out = "".join(p for p, _ in self.pre.pre_tokenize_str(chr(c)))
        return out


class Encoder:
    """Ids of whole texts. What is remembered of earlier texts is bounded and dropped when full."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path or default_vocabulary())
        self.model, self.pre = self.tok.model, self.tok.pre_tokenizer
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.simple = self.tok.normalizer is None and type(self.model).__name__ == "BPE" and type(self.pre).__name__ == "ByteLevel"
        self.mapped = Mapped(self.pre) if self.simple else {}
        self.pieces: dict[str, list[int]] = {}
        self.small = self.tok.get_vocab_size() < 65536
        if self.simple:
            self.model._resize_cache(0)  # every piece is asked for once
        self._clear()

    def _clear(self) -> None:
        # chunks by 64-bit hash (sorted) with a 32-bit check of another hash: 25 bytes a chunk instead of 200 for a dict
        self.keys, self.check, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int32)
        # ids of all chunks and the first of each, read in place: both have room behind, ``slots`` are in use
        self.flat, self.first, self.slots = np.zeros(0, np.uint16 if self.small else np.uint32), np.zeros(1, np.int64), 0

    def _piece(self, piece: str) -> list[int]:
        """Ids of one byte-mapped pre-token."""
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > PIECE_ENTRIES:
                self.pieces.clear()
            ids = self.pieces[piece] = [t.id for t in self.model.tokenize(piece)]
        return ids

    def forget(self) -> None:
        """Drop what is remembered of earlier texts: a worker lives on between tasks."""
        self._clear()
        self.pieces.clear()

    def _learn(self, chunk: str, out: array) -> None:
        """Ids of a new chunk: a plain word with ASCII marks behind it is cut here, all else by the pre-tokenizer."""
        lead = chunk[0] == " "
        core = chunk[lead:].rstrip(MARKS)
        if core.isalpha():
            out.extend(self._piece(("\u0120" if lead else "") + (core if core.isascii() else core.translate(self.mapped))))
            tail = chunk[lead + len(core):]
            if tail:
                out.extend(self._piece(tail))
        else:
            for p, _ in self.pre.pre_tokenize_str(chunk):
                out.extend(self._piece(p))

    def _slots(self, words: pa.Array, led: np.ndarray) -> np.ndarray:
        """Slot of each distinct chunk (word, and whether a space leads it); new ones are learnt."""
        if len(self.keys) > MEMO_ENTRIES:
            self._clear()
        key, check = chunk_hash(C.Texts(words), led)
        at = np.searchsorted(self.keys, key)
        inside = np.minimum(at, max(len(self.keys) - 1, 0))
        known = (self.keys[inside] == key) & (self.check[inside] == check) if len(self.keys) else np.zeros(len(key), bool)
        out = np.zeros(len(key), np.int64)
        out[known] = self.slot[inside[known]]
        new = np.flatnonzero(~known)
        if len(new):
            slot = self.slots + np.arange(len(new))
            ids, ends = array("H" if self.small else "I"), array("q")
            for w, space in zip(words.take(pa.array(new)).to_pylist(), led[new].tolist()):
                self._learn(" " + w if space else w, ids)
                ends.append(len(ids))
            used = int(self.first[self.slots])
            self.flat = _append(self.flat, used, np.array(ids, self.flat.dtype))
            self.first = _append(self.first, self.slots + 1, np.array(ends, np.int64) + used)
            self.slots += len(new)
            out[new] = slot
            order = np.argsort(key[new])
            new, slot = new[order], slot[order]
            at = np.searchsorted(self.keys, key[new])
            self.keys, self.check = np.insert(self.keys, at, key[new]), np.insert(self.check, at, check[new])
            self.slot = np.insert(self.slot, at, slot.astype(np.int32))
        return out

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _odd(self, arr: pa.Array, texts: C.Texts) -> dict[int, str]:
        """Rows whose pre-tokens may reach over a cut, found from the bytes around their spaces."""
        if not self.simple:
            return {i: t for i, t in enumerate(arr.to_pylist()) if t}
        d = texts.data
        look = np.zeros(len(texts), bool)
        for s in self.special:
            look |= np.asarray(pc.fill_null(pc.match_substring(arr, s), False))
        sp = np.flatnonzero(d == 32)
        if len(sp):
            p = np.concatenate([[0, 0, 0], d, [0]])  # d[i] is p[i + 3]
            back, back2, back3, ahead = p[sp + 2], p[sp + 1], p[sp], p[sp + 4]
            near = (ASCII_WS[back] | ASCII_WS[ahead] | WIDE_LEAD[ahead] | ((back2 == 0xC2) & ((back == 0x85) | (back == 0xA0)))
                    | (np.isin(back2, [0x80, 0x81, 0x9A]) & np.isin(back3, [0xE1, 0xE2, 0xE3])))
            look[np.searchsorted(texts.off, sp[near], "right") - 1] = True
        look |= np.diff(texts.off) == 1  # a single space
        rows = np.flatnonzero(look)
        near_rows = zip(rows, arr.take(pa.array(rows)).to_pylist())
        return {int(i): t for i, t in near_rows if t and (ODD_SPACE.search(t) or any(s in t for s in self.special))}

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all rows and the row offsets (null: no ids)."""
        texts = C.Texts(arr)
        whole = {i: self.whole(t) for i, t in self._odd(arr, texts).items()}
        odd = np.zeros(len(texts), bool)
        odd[list(whole)] = True
        # chunks: runs of non-spaces, led by the space before them unless they begin their row
        runs = texts.split(SPACE)
        code, distinct = runs.codes()
        use = np.flatnonzero(~odd[runs.row])
        row = runs.row[use]
        key = code[use] * 2 + (runs.start[use] > texts.off[:-1][row])
        inverse, kinds = pd.factorize(key)
        at = self._slots(pa.concat_arrays([distinct.take(pa.array(kinds // 2)), pa.array([""])]), np.append(kinds % 2, 1).astype(bool))
        flat, first = self.flat, self.first
        begin, size = first[at], first[at + 1] - first[at]
        tail = np.zeros(len(texts), bool)  # a last space is a pre-token of its own
        full = np.flatnonzero(texts.off[1:] > texts.off[:-1])
        tail[full] = texts.data[texts.off[1:][full] - 1] == 32
        tail &= ~odd
        lens = size[inverse]
        in_row = np.bincount(row, weights=lens, minlength=len(texts)).astype(np.int64)
        n = in_row + tail * size[-1]
        for i, x in whole.items():
            n[i] = len(x)
        off = np.concatenate([[0], np.cumsum(n)])
        out = np.zeros(off[-1], np.uint32)
        total = int(lens.sum())
        if total:
            step = np.arange(total)
            src = np.repeat(begin[inverse] - (np.cumsum(lens) - lens), lens)
            dst = np.repeat(off[:-1][row] - (np.cumsum(in_row) - in_row)[row], lens)
            out[dst + step] = flat[src + step]
        for i in np.flatnonzero(tail):
            out[off[i + 1] - size[-1]:off[i + 1]] = flat[begin[-1]:begin[-1] + size[-1]]
        for i, x in whole.items():
            out[off[i]:off[i + 1]] = x
        return out, off


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Free what this worker's encoders remember, if it has any."""
    for enc in _ENCODERS.values():
        enc.forget()
    C.release()
