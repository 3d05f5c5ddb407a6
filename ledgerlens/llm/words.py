"""Words, hashes and windows of UTF-8 text as numpy arrays.

All functions work on the raw bytes of many texts laid end to end (the layout
of an Arrow string column), so one pass of a few vector operations replaces a
Python loop over words.  Hashes are polynomial over bytes modulo 2**64 with an
odd base, read from prefix sums, then mixed; they depend on the content only,
never on the process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C55
_WBASE = 0xC2B2AE3D27D4EB4F
MAX_U64 = U64(0xFFFFFFFFFFFFFFFF)

SPACE = np.ones(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = False          # words [^\x20\x09-\x0D]+
ALNUM = np.zeros(256, dtype=bool)                  # ASCII letters, digits, all non-ASCII bytes
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class _Powers:
    """base**i and base**-i modulo 2**64 for i < size, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.inverse, k, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE), _Powers(_WBASE)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over the result."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix(values: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of value * base**i (n + 1 of them), and base**-i."""
    up, down = powers.upto(len(values) + 1)
    sums = np.empty(len(values) + 1, dtype=U64)
    sums[0] = 0
    np.cumsum(values.astype(U64) * up[:-1], out=sums[1:])
    return sums, down


def spans(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each span [start, end): equal content, equal hash."""
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64) * U64(_WBASE))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    at = np.frombuffer(offs, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``limit`` text bytes, so the
    working arrays stay small however many rows Spark puts into a batch.
    A single longer text is a run of its own; no text is cut."""
    for batch in batches:
        _, offs = column_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def find(data: np.ndarray, offs: np.ndarray, inside: np.ndarray = SPACE):
    """Start and end of every word (a run of ``inside`` bytes within one
    text), and the index of each text's first word (n + 1 of them)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    is_word = inside[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offs] = True
    start = is_word.copy()
    start[1:] &= ~is_word[:-1] | cut[1:-1]
    end = is_word.copy()
    end[:-1] &= ~is_word[1:] | cut[1:-1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offs)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, step: int = 1 << 22) -> np.ndarray:
    """Hash of every word, in runs of words of about ``step`` bytes: the prefix
    sums of a very long text never stand in memory at once."""
    out = np.empty(len(start), U64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + step, side="right")))
        low = start[a]
        sums, down = prefix(data[low:end[b - 1]], _BYTES)
        out[a:b] = spans(sums, down, start[a:b] - low, end[a:b] - low)
        a = b
    return out


def windows(word_hash: np.ndarray, size: int, sums=None) -> np.ndarray:
    """Hash of the ``size`` words from each word on.  Windows that cross a
    text's end are to be masked by the caller (see ``whole``)."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    total, down = sums or prefix(word_hash, _WORDS)
    return mix((total[size:] - total[:-size]) * down[:n] + U64(size))


def word_sums(word_hash: np.ndarray):
    return prefix(word_hash, _WORDS)


def whole(first: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which of the windows of ``size`` words lie within one text."""
    n = max(0, n_words - size + 1)
    return np.arange(n) + size <= np.repeat(first[1:], np.diff(first))[:n]


def owner(first: np.ndarray) -> np.ndarray:
    """Text index of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
