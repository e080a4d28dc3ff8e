"""Texts of an Arrow batch as flat numpy arrays: words, their hashes, shingles.

A word is a run of bytes other than the ASCII white space ``\\x20 \\x09-\\x0D``; UTF-8
never uses those bytes inside a character, so bytes can be scanned as they are.
Hashes have 64 bits.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NEWLINE = np.arange(256) == 10
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """The first ``n`` values of a fixed pseudo-random sequence."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = stream(256, 11) | np.uint64(1)
_LEAD = stream(SHINGLE, 23) | np.uint64(1)
_place = stream(64, 37) | np.uint64(1)


def places(n: int) -> np.ndarray:
    """Factors by position in a word; grown once to the longest word met."""
    global _place
    if len(_place) < n:
        _place = stream(max(n, 2 * len(_place)), 37) | np.uint64(1)
    return _place


def slices(batches, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of the batches with about ``limit`` bytes of text each.

    A longer text is a part of its own, so memory follows the longest text only.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1, from 0) and the bytes of a string column."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    at = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


class Words:
    """Words of all texts of a slice: ``starts``/``ends`` in bytes, ``first`` word of each text (n + 1).

    With ``apart=NEWLINE`` the "words" are the lines that are not empty.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, apart: np.ndarray = WHITE):
        self.offsets, self.data = offsets, data
        inner = ~apart[data]
        begin, end = inner.copy(), inner.copy()
        begin[1:] &= ~inner[:-1]
        end[:-1] &= ~inner[1:]
        filled = offsets[:-1] < offsets[1:]
        head, tail = offsets[:-1][filled], offsets[1:][filled] - 1
        begin[head] = inner[head]
        end[tail] = inner[tail]
        self.inner, self.begin = inner, begin
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        longest = int((self.ends - self.starts).max())
        factor = places(longest)
        lead = self.starts[0]
        place = np.arange(lead, len(self.data)) - np.repeat(
            self.starts, np.diff(np.append(self.starts, len(self.data)))
        )
        np.minimum(place, longest - 1, out=place)  # white space after a word; its value is 0
        value = _BYTE[self.data[lead:]]
        value *= factor[place]
        value[~self.inner[lead:]] = 0
        return mix(np.add.reduceat(value, self.starts - lead))

    def grams(self, hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
        """Hash of each run of ``width`` words; entry i starts at word i (runs may cross texts)."""
        n = len(hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out += hashes[k : k + n] * _LEAD[k % SHINGLE]
        return mix(out)

    def text_grams(self, hashes: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
        """Per text: the hashes of its word runs in order; fewer words make one run, no word none."""
        all_grams = self.grams(hashes, width)
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= width:
                yield all_grams[a : b - width + 1]
            elif b > a:
                short = (hashes[a:b] * _LEAD[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield mix(np.array([short], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes stay."""
    return LOWER[data]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags in each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]
