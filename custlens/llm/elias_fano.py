"""Elias-Fano coding of non-decreasing integers, over buffers that may be memory-mapped.

Each value keeps its low bits in a packed array; the high bits are a unary bit
vector in which the i-th one stands at (value >> l) + i.  A directory of the ones
before every 512 bits serves select and successor queries, which take arrays of
arguments.  Space is about 2 + log2(universe / n) bits a value.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQBxxxxxxxQQ")
_BLOCK = 512


def encode(values: np.ndarray, universe: int | None = None) -> bytes:
    """Bytes of the sequence.  ``values`` are non-decreasing, 0 or more."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    universe = max(int(v[-1]) + 1 if n else 1, universe or 1)
    width = max(0, min(56, (universe // max(1, n)).bit_length() - 1))
    high = (v >> np.uint64(width)).astype(np.int64) + np.arange(n, dtype=np.int64)
    n_bits = n + (universe >> width) + 1
    bits = np.zeros(-(-n_bits // _BLOCK) * _BLOCK, bool)
    bits[high] = True
    low = b""
    if width:
        shifts = np.arange(width, dtype=np.uint64)
        step = max(8, (1 << 22) // width // 8 * 8)
        low = b"".join(np.packbits(((v[i:i + step, None] >> shifts) & np.uint64(1)).astype(bool),
                                   bitorder="little").tobytes() for i in range(0, n, step))
    low += bytes(8 + -len(low) % 8)
    high = np.packbits(bits, bitorder="little").tobytes()
    ones = np.concatenate([[0], np.cumsum(bits.reshape(-1, _BLOCK).sum(1))])
    return b"".join([_HEAD.pack(n, universe, width, len(low), len(high)), low, high,
                     ones.astype("<u8").tobytes()])


class EliasFano:
    """A coded sequence, read in place from ``buffer`` at ``at``."""

    def __init__(self, buffer, at: int = 0):
        self.n, self.universe, width, n_low, n_high = _HEAD.unpack_from(buffer, at)
        self.width = np.uint64(width)
        self._mask = np.uint64((1 << width) - 1)
        at += _HEAD.size
        # Eight bytes from any byte on, for packed values that cross word borders.
        self._low = np.ndarray((n_low - 7,), "<u8", buffer, at, (1,))
        at += n_low
        self._high = np.frombuffer(buffer, "<u8", n_high // 8, at)
        at += n_high
        self._ones = np.frombuffer(buffer, "<u8", n_high * 8 // _BLOCK + 1, at).astype(np.int64)
        self._zeros = np.arange(len(self._ones), dtype=np.int64) * _BLOCK - self._ones
        self.end = at + len(self._ones) * 8

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self._mask:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * self.width
        word = self._low[(bit >> np.uint64(3)).astype(np.int64)]
        return (word >> (bit & np.uint64(7))) & self._mask

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Places of the k-th (from 0) ones or zeros of the high bits."""
        before = self._ones if ones else self._zeros
        block = np.searchsorted(before, k, side="right") - 1
        rest = (k - before[block]).astype(np.int64)
        word = block * (_BLOCK // 64)
        for _ in range(_BLOCK // 64 - 1):
            here = self._high[word] if ones else ~self._high[word]
            count = np.bitwise_count(here).astype(np.int64)
            past = rest >= count
            if not past.any():
                break
            rest = np.where(past, rest - count, rest)
            word = word + past
        bits = self._high[word] if ones else ~self._high[word]
        place = np.zeros(len(k), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            low = bits & np.uint64((1 << half) - 1)
            count = np.bitwise_count(low).astype(np.int64)
            up = rest >= count
            rest = np.where(up, rest - count, rest)
            bits = np.where(up, bits >> np.uint64(half), low)
            place = np.where(up, place + np.uint64(half), place)
        return word.astype(np.int64) * 64 + place.astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << self.width) | self._lows(i)

    def all(self) -> np.ndarray:
        """The whole sequence."""
        bits = np.unpackbits(self._high.view(np.uint8), bitorder="little")
        at = np.flatnonzero(bits)[:self.n]
        i = np.arange(self.n, dtype=np.int64)
        return ((at - i).astype(np.uint64) << self.width) | self._lows(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is ``x`` or more (``n``: none)."""
        return self._search(np.asarray(x, np.uint64))[0]

    def index(self, x: np.ndarray) -> np.ndarray:
        """Place of ``x``, -1 where the sequence lacks it."""
        at, there = self._search(np.asarray(x, np.uint64))
        return np.where(there, at, -1)

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(x) or not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        if len(x) * 8 >= self.n:
            # So many arguments are searched faster in the decoded sequence.
            values = self.all()
            at = np.searchsorted(values, x)
            return at, values[np.minimum(at, self.n - 1)] == x
        inside = x < np.uint64(self.universe)
        x_in = np.where(inside, x, np.uint64(0))
        high = (x_in >> self.width).astype(np.int64)
        lo = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - high + 1, 0)
        end = hi = self._select(high, False) - high
        low = x_in & self._mask
        # All values between lo and hi share x's high bits; search their low bits.
        while True:
            open_ = lo < hi
            if not open_.any():
                break
            mid = (lo + hi) >> 1
            less = open_ & (self._lows(np.where(open_, mid, 0)) < low)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        there = inside & (lo < end)
        there &= self._lows(np.where(there, lo, 0)) == low
        return np.where(inside, lo, self.n), there
