"""Vectorised word splitting and hashing over Arrow text columns.

Words are runs of bytes outside a separator table. All separators used here are ASCII, so working on UTF-8
bytes gives the same words as working on code points. A word's hash mixes two polynomials in its bytes, taken from prefix sums: one modulo 2**64 and one
modulo the prime 2**31 - 1, as there are words with one value modulo a power of two for every base (a sequence over two letters and the same with the letters
swapped, where letters alternate by the number of ones in the place's binary digits). A-Z hash as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_U = np.uint64
_P = 0x9E3779B97F4A7C55
_PINV = pow(_P, -1, 1 << 64)
_M = (1 << 31) - 1
_B = 1_103_515_245


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on uint64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lower_table()
#: Words [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text with A-Z lowered
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_CODES = mix(LOWER.astype(np.uint64) + _U(0x1234567))
_EXACT_CODES = mix(np.arange(256, dtype=np.uint64) + _U(0x7654321))
#: The same for the prime modulus.
_SMALL, _EXACT_SMALL = _CODES % _U(_M), _EXACT_CODES % _U(_M)
_powers = {"n": 0}


def _modular_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * _U(pow(base, done, _M)) % _U(_M)
        done += more
    return out


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Powers of both bases and of their inverses: modulo 2**64, then modulo the prime."""
    if _powers["n"] < n:
        m = max(n, CHUNK_BYTES + (1 << 16))
        with np.errstate(over="ignore"):
            for key, base in (("p", _P), ("q", _PINV)):
                a = np.full(m, base, np.uint64)
                a[0] = 1
                _powers[key] = np.multiply.accumulate(a)
        _powers["small"], _powers["inverse"] = _modular_powers(_B, m), _modular_powers(pow(_B, -1, _M), m)
        _powers["n"] = m
    return _powers["p"], _powers["q"], _powers["small"], _powers["inverse"]


@dataclass
class Words:
    """start, end: byte positions in the chunk; doc: row in the chunk; first: for each row the index of its first word, and the total."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray


@dataclass
class Chunk:
    """Consecutive rows of a batch: lo to hi, their bytes and, relative to those, their n+1 offsets."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def words(self, table: np.ndarray = SPACED) -> Words:
        n = len(self.data)
        rows = self.hi - self.lo
        if not n:
            z = np.empty(0, np.int64)
            return Words(z, z, z, np.zeros(rows + 1, np.int64))
        inside = table[self.data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        opens[cuts] = inside[cuts]
        closes[cuts - 1] = inside[cuts - 1]
        start = np.flatnonzero(opens)
        end = np.flatnonzero(closes) + 1
        first = np.searchsorted(start, self.offsets, "left")
        doc = np.repeat(np.arange(rows), np.diff(first))
        return Words(start, end, doc, first)

    def hashes(self, w: Words, fold: bool = True, prefix: int | None = None) -> np.ndarray:
        """One uint64 a word, or of the first ``prefix`` bytes of each word."""
        if not len(w.start):
            return np.empty(0, np.uint64)
        end = w.end if prefix is None else np.minimum(w.end, w.start + prefix)
        with np.errstate(over="ignore"):
            n, size = len(self.data), (end - w.start).astype(np.uint64)
            p, q, small, inverse = _power_tables(n + 1)
            s = np.zeros(n + 1, np.uint64)
            np.cumsum((_CODES if fold else _EXACT_CODES)[self.data] * p[:n], out=s[1:])
            h = mix((s[end] - s[w.start]) * q[w.start] + size)
            x = (_SMALL if fold else _EXACT_SMALL)[self.data] * small[:n]
            np.cumsum((x & _U(_M)) + (x >> _U(31)), out=s[1:])  # below 2**32 each, so no sum of a text passes 64 bits
            return mix(h ^ ((s[end] - s[w.start]) % _U(_M) * inverse[w.start] % _U(_M) + (size << _U(31))))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cuts a string column into runs of rows of about ``limit`` bytes; a longer text is a run of its own. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield Chunk(lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def windows(h: np.ndarray, w: Words, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row, and the row of each."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        acc = np.zeros(n, np.uint64)
        for j in range(size):
            acc += h[j : j + n] * _U((2 * mix(np.array([seed * 1000 + j + 1], np.uint64))[0] + _U(1)) & _U(0xFFFFFFFFFFFFFFFF))
        ok = w.doc[:n] == w.doc[size - 1 :]
        return mix(acc[ok] + _U(size)), w.doc[:n][ok]
