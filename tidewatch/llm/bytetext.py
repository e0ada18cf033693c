"""Words of whole Arrow batches as numpy arrays: byte positions, hashes and owners, without a Python object per word.

Words are the runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19   # bytes worked on at once; a longer text is a chunk of its own

WS = np.zeros(256, bool)
WS[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256).astype(np.uint64)
_powers = {}


def _power(n: int):
    """Powers of an odd number and of its inverse modulo 2^64, up to n."""
    if len(_powers.get("up", ())) < n:
        m = max(n, CHUNK * 2)
        up, down = np.full(m, _ODD), np.full(m, _INV)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"], _powers["down"]


def mix64(h: np.ndarray) -> np.ndarray:
    """Final scrambling of 64-bit values (the splitmix64 steps)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one text after the other, and the n + 1 borders. Null texts are empty."""
    values = pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()), "")
    n = len(values)
    _, at, data = values.buffers()
    borders = np.frombuffer(at, np.int64, n + 1, values.offset * 8) if n else np.zeros(1, np.int64)
    if data is None or not n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[borders[0]:borders[-1]], borders - borders[0]


def chunks(batch: pa.RecordBatch, name: str, limit: int = CHUNK):
    """(first row, bytes, borders) for runs of whole texts of about `limit` bytes."""
    buf, at = column(batch, name)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, buf[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


class Words:
    """start, end: byte positions; doc: owner of each word; per: words of each text; first: border of each text's words."""

    def __init__(self, buf: np.ndarray, at: np.ndarray):
        self.buf, self.at = buf, at
        n, docs = len(buf), len(at) - 1
        if not n:
            self.start = self.end = self.doc = np.zeros(0, np.int64)
            self.per, self.first = np.zeros(docs, np.int64), np.zeros(docs + 1, np.int64)
            return
        ink = ~WS[buf]
        edge = at[:-1][at[:-1] < n]
        b = ink.copy()
        b[1:] &= ~ink[:-1]
        b[edge] = ink[edge]
        self.start = np.flatnonzero(b)
        b = ink.copy()
        b[:-1] &= ~ink[1:]
        last = at[1:][at[1:] > 0] - 1
        b[last] = ink[last]
        self.end = np.flatnonzero(b) + 1
        self.first = np.searchsorted(self.start, at)
        self.per = np.diff(self.first)
        self.doc = np.repeat(np.arange(docs), self.per)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, fold: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word; fold maps bytes first."""
        return span_hashes(self.buf if fold is None else fold[self.buf], self.start, self.end)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of buf[start:end] for each pair: a polynomial over running sums, scrambled."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power(len(buf) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[:len(buf)], out=run[1:])
        return mix64((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k neighbours in h (len(h) - k + 1 of them; those that cross texts are the caller's to drop)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            out = out * _ODD + h[i:len(h) - k + 1 + i]
        return mix64(out)


def doc_sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sum of values[borders[i]:borders[i + 1]] for each i."""
    run = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=run[1:])
    return run[borders[1:]] - run[borders[:-1]]
