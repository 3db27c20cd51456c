"""Words of many texts at once, as numpy arrays: positions in one buffer, their document, a 64-bit hash each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that part words: blank, tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
ODD, STEP = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * ODD)
_power: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """STEP ** i and its inverse for i below n at least, modulo 2 ** 64."""
    if len(_power[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = U(pow(int(STEP), -1, 1 << 64))
        for k, base in enumerate((STEP, inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _power[k] = np.multiply.accumulate(p)
    return _power


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, null as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return data, ends - ends[0]


@dataclass
class Words:
    data: np.ndarray  # the bytes, A-Z lower-cased
    ends: np.ndarray  # offsets of the documents in data
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray  # offsets of the documents in the words
    hash: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.stop[i]].tobytes().decode("utf-8", "replace")


def words_of(column: pa.Array) -> Words:
    data, ends = flat(column)
    data, n = LOWER[data], len(data)
    full = ~BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    gap = np.ones(n + 1, bool)  # before byte i: a blank or a document's start
    gap[1:] = ~full if n else True
    start = np.flatnonzero(full & (gap[:-1] | edge[:-1])) if n else np.zeros(0, np.int64)
    after = np.ones(n, bool)
    if n:
        after[:-1] = ~full[1:]
    stop = np.flatnonzero(full & (after | edge[1:])) + 1 if n else start
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[:n], out=total[1:])
    h = mix64((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64) * ODD)
    return Words(data, ends, start, stop, np.searchsorted(start, ends), h)


SHINGLE = mix64(np.arange(1, 65, dtype=np.uint64) * STEP) | U(1)


def shingles(w: Words, width: int = 5) -> list[np.ndarray]:
    """For each document the ascending distinct hashes of its runs of `width` words; with fewer words, of the whole sequence."""
    n = len(w.hash)
    run = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        run += w.hash[k : n - width + 1 + k] * SHINGLE[k] if n >= width else U(0)
    run = mix64(run)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(run[a : b - width + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])] if len(s) > 1 else s)
        elif b > a:
            out.append(mix64((w.hash[a:b] * SHINGLE[: b - a]).sum(dtype=np.uint64, keepdims=True) + SHINGLE[32 + b - a : 33 + b - a]))
        else:
            out.append(run[:0])
    return out
