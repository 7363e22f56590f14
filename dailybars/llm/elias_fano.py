"""Elias-Fano code of a non-decreasing sequence, with select.

A value is cut into `low` bits, kept as they are, and its high part, kept in unary: bit (high + i) is set for
value i. That is about 2 + log2(universe / n) bits a value. Every 64th set bit's place is kept in 32 bits, so
select reads a bounded stretch of the bit vector.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 64
HEAD = struct.Struct("<QQBQQ")  # n, universe, low bits, bytes of the low part, bytes of the high part


def encode(values: np.ndarray, universe: int) -> bytes:
    """values: non-decreasing, from 0 to universe (included)."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    low = max(0, (universe // n).bit_length() - 1) if n else 0
    shifts = np.arange(low, dtype=np.uint64)
    low_bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    low_part = np.packbits(low_bits.ravel(), bitorder="little").tobytes()
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high_bits = np.zeros((universe >> low) + n + 1, dtype=np.uint8)
    high_bits[places] = 1
    high_part = np.packbits(high_bits, bitorder="little").tobytes()
    samples = places[::STEP].astype("<u4").tobytes()
    return HEAD.pack(n, universe, low, len(low_part), len(high_part)) + low_part + high_part + samples


class EliasFano:
    """Reads an encoded sequence in place."""

    def __init__(self, data: bytes | memoryview):
        self.n, self.universe, self.low, n_low, n_high = HEAD.unpack_from(data)
        at = HEAD.size
        self.low_part = np.frombuffer(data, np.uint8, n_low, at)
        self.high_part = np.frombuffer(data, np.uint8, n_high, at + n_low)
        self.samples = np.frombuffer(data, "<u4", -(-self.n // STEP), at + n_low + n_high)
        self.size = at + n_low + n_high + 4 * len(self.samples)

    def _low(self, i: int) -> int:
        if not self.low:
            return 0
        first = i * self.low
        window = self.low_part[first >> 3 : (first + self.low + 7) >> 3].tobytes()
        return (int.from_bytes(window, "little") >> (first & 7)) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """Value i."""
        place, rest = int(self.samples[i // STEP]), i % STEP
        at = place >> 3
        seen = -int(np.unpackbits(self.high_part[at : at + 1], bitorder="little")[: place & 7].sum())
        while True:
            bits = np.flatnonzero(np.unpackbits(self.high_part[at : at + 32], bitorder="little"))
            if seen + len(bits) > rest:
                place = 8 * at + int(bits[rest - seen])
                return ((place - i) << self.low) | self._low(i)
            seen += len(bits)
            at += 32

    def all(self) -> np.ndarray:
        """All values at once."""
        places = np.flatnonzero(np.unpackbits(self.high_part, bitorder="little"))[: self.n]
        values = (places - np.arange(self.n)) << self.low
        if self.low:
            bits = np.unpackbits(self.low_part, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
            values = values | (bits.astype(np.int64) << np.arange(self.low)).sum(axis=1)
        return values.astype(np.int64)
