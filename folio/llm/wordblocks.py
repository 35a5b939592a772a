"""Vectorised word and shingle hashing over whole Arrow batches of text.

Text reaches these helpers as the UTF-8 buffer of an Arrow string column, so a
task never loops over words in Python.  A word's hash is a polynomial over the
bytes (mod 2**64) read off prefix sums, finished with an avalanche mix; it does
not depend on the machine, the batch or the position of the word, which is what
lets hashes meet in a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_GRAM = U(0xD6E8FEB86659FD93 | 1)
CHUNK_BYTES = 2 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche finish of 64-bit words (xor-shift multiply rounds)."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * U(0xA24BAED4963EE407))


#: The longest run of each base's powers yet, up to KEEP of them.
_POWERS: dict[int, np.ndarray] = {}
KEEP = 2 << 20


def powers(base: np.uint64, n: int) -> np.ndarray:
    kept = _POWERS.get(int(base))
    if kept is not None and len(kept) >= n:
        return kept[:n]
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    out = np.multiply.accumulate(out)
    if n <= KEEP:
        out.flags.writeable = False
        _POWERS[int(base)] = out
    return out


@dataclass
class Words:
    """Words of a run of texts: byte ranges, hashes and each text's slice."""

    data: np.ndarray  # uint8, after case folding when asked for
    begin: np.ndarray  # first byte of each word
    end: np.ndarray  # one past its last byte
    first: np.ndarray  # index of each text's first word; one more at the end
    sums: np.ndarray  # prefix sums of the letter polynomial, length bytes + 1
    back: np.ndarray  # inverse powers by position

    def hashes(self, begin=None, end=None) -> np.ndarray:
        begin, end = (self.begin, self.end) if begin is None else (begin, end)
        raw = (self.sums[end] - self.sums[begin]) * self.back[begin]
        return mix(raw + (end - begin).astype(np.uint64) * U(0x9FB21C651E98DF25))

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


#: Bytes that end a word: \x20 and \x09-\x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

#: All ASCII but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def fold_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]] if len(at) else data[:0], at - at[0] if len(at) else np.zeros(1, np.int64)


def split_words(data: np.ndarray, offsets: np.ndarray, fold: bool, separator: np.ndarray = _SPACE) -> Words:
    """Find the words of every text; a text's edge always ends a word."""
    if fold:
        data = fold_ascii(data)
    inside = ~separator[data]
    n = len(data)
    padded = np.zeros(n + 1, dtype=bool)
    padded[:n] = inside
    starts, stops = padded.copy(), np.zeros(n + 1, dtype=bool)
    starts[1:n] &= ~inside[:-1]
    stops[1:] = inside
    stops[:n] &= ~inside
    edge = offsets[(offsets > 0) & (offsets < n)]
    starts[edge] = padded[edge]
    stops[edge] |= padded[edge - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(stops)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_LETTER[data] * powers(_BASE, n), out=sums[1:])
    return Words(data, begin, end, np.searchsorted(begin, offsets), sums, powers(_BASE_INVERSE, n + 1))


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words, and where each text's grams begin.

    Grams that would cross from one text into the next are left out, so a text
    of n words has max(0, n - k + 1) of them.
    """
    count = np.maximum(np.diff(first) - k + 1, 0)
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    out = hashes[: n - k + 1].copy()
    for j in range(1, k):
        out = out * _GRAM + hashes[j : n - k + 1 + j]
    keep = np.ones(n - k + 1, dtype=bool)
    for j in range(1, k):  # the last k - 1 starts of a text; no loop over texts
        late = first[1:] - j
        keep[late[(late >= first[:-1]) & (late < n - k + 1)]] = False
    return mix(out[keep]), np.concatenate(([0], np.cumsum(count)))


def text_chunks(batches, text: str, limit: int = CHUNK_BYTES, at: int | None = None):
    """Cut Arrow batches into runs of rows of about `limit` bytes of text.

    Long texts stay whole: a run holds at least one row.  The text is in the
    column of that name, or where names may repeat, number `at`.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text) if at is None else at)
        size = np.asarray(pa.compute.binary_length(column).fill_null(0).cast(pa.int64()))
        group = (np.cumsum(size) - size) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)
