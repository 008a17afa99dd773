"""Words of whole texts as 64-bit hashes, many documents at a time, computed on arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import mix

#: Bytes of documents handled at once (a longer document alone and whole), and bytes hashed at once.
SLICE_BYTES, BLOCK_BYTES = 1_000_000, 1 << 18
#: A word's hash is the sum of a random value for each byte times a power of BASE by its place in the word.
BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20240229).integers(0, 2**64, 256, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**k and BASE**-k for k below n, modulo 2**64; kept up to the size of two blocks."""
    if not _POWERS or len(_POWERS[0]) < n:
        made = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        if n > 2 * BLOCK_BYTES:
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a text given as bytes."""
    starts, hashes = [], []
    lo = 0
    while lo < len(text):
        hi = lo + BLOCK_BYTES
        if hi < len(text):  # cut at a blank: behind the last one of the block, else at the next
            blanks = np.flatnonzero(_SPACE[text[lo:hi]])
            if len(blanks):
                hi = lo + int(blanks[-1]) + 1
            else:
                more = np.flatnonzero(_SPACE[text[hi:]])
                hi = hi + int(more[0]) + 1 if len(more) else len(text)
        block = text[lo:hi]
        edge = np.diff(np.concatenate([[True], _SPACE[block], [True]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _powers(len(block))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[block] * up)])
        starts.append(begin + lo)
        hashes.append(mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)) if len(begin) else np.empty(0, np.uint64))
        lo = hi
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.empty(0, np.int64), np.empty(0, np.uint64))


class Slice:
    """Words of some documents behind each other: hash of each word and the number of its document."""

    def __init__(self, ids: list[int], texts: list[bytes], lower: bool):
        self.ids = np.array(ids, np.int64)
        self.text = b"\n".join(texts)
        whole = np.frombuffer(self.text, np.uint8)
        at, self.hashes = word_hashes(_LOWER[whole] if lower else whole)
        self.at = at
        stops = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        self.doc = np.searchsorted(stops, at, "right")
        self.counts = np.bincount(self.doc, minlength=len(ids))
        self.first = np.cumsum(self.counts) - self.counts

    def whole(self, n: int) -> np.ndarray:
        """For each place where n words follow in the slice: whether they are of one document."""
        m = max(0, len(self.doc) - n + 1)
        return self.doc[:m] == self.doc[n - 1 : n - 1 + m]


def slices(batches: Iterator[pa.RecordBatch], lower: bool, extra: tuple[str, ...] = ()):
    """(Slice, columns of `extra`) for documents (_id, text), in bounded portions; words are `[^\\x20\\x09-\\x0D]+`."""
    for b in batches:
        ids, texts = b.column("_id").to_pylist(), b.column("text")
        more = [b.column(c) for c in extra]
        part: list[bytes] = []
        begin = size = 0
        for k in range(b.num_rows):
            t = (texts[k].as_py() or "").encode("utf-8", "surrogatepass")
            if size and size + len(t) > SLICE_BYTES:
                yield Slice(ids[begin:k], part, lower), [c.slice(begin, k - begin) for c in more]
                part, begin, size = [], k, 0
            part.append(t)
            size += len(t) + 1
        if part:
            yield Slice(ids[begin:], part, lower), [c.slice(begin) for c in more]


def pack_longs(a: np.ndarray) -> bytes:
    """Longs with a common base, 4 bytes each where their range allows, else 8."""
    if not len(a):
        return b""
    base = int(a.min())
    if int(a.max()) - base < 2**32:
        return b"4" + base.to_bytes(8, "little", signed=True) + (a - base).astype("<u4").tobytes()
    return b"8" + a.astype("<i8").tobytes()


def unpack_longs(b: bytes) -> np.ndarray:
    if not b:
        return np.empty(0, np.int64)
    if b[:1] == b"4":
        return np.frombuffer(b, "<u4", offset=9).astype(np.int64) + int.from_bytes(b[1:9], "little", signed=True)
    return np.frombuffer(b[1:], "<i8")
