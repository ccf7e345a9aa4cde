"""Elias-Fano code of an ascending list of whole numbers, with select."""

from __future__ import annotations

import struct

import numpy as np

EVERY = 256  # the place of each so-manieth one-bit is stored
_HEAD = "<QQBQ"


class EliasFano:
    """n numbers below a limit u in about n * (2 + log2(u / n)) bits.

    The lower bits of each number are stored as they are; the upper ones as a bit vector in which
    the i-th one-bit stands at place upper(i) + i. Sampled places of one-bits, 32 bits each, are
    all the table that select needs; they are stored with the rest.
    """

    def __init__(
        self, n: int, limit: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray
    ):
        self.n, self.limit, self.low_bits = n, limit, low_bits
        self.low, self.high, self.sample = low, high, sample

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        limit = int(values[-1]) + 1 if n else 0
        low_bits = max(0, (limit // n).bit_length() - 1) if n else 0
        shift = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(
            ((values[:, None] >> shift) & np.uint64(1)).astype(np.uint8), bitorder="little"
        )
        bits = np.zeros(n + (limit >> low_bits) + 1, np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits[ones] = 1
        sample = ones[::EVERY].astype("<u4")
        return cls(n, limit, low_bits, low, np.packbits(bits, bitorder="little"), sample)

    def to_bytes(self) -> bytes:
        parts = [p.tobytes() for p in (self.low, self.high, self.sample)]
        head = struct.pack(_HEAD, self.n, self.limit, self.low_bits, len(parts[1]))
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple["EliasFano", int]:
        """The list that begins at a place, and the place behind it."""
        n, limit, low_bits, high_size = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        low_size = -(-n * low_bits // 8)
        low = np.frombuffer(data, np.uint8, low_size, at)
        high = np.frombuffer(data, np.uint8, high_size, at + low_size)
        at += low_size + high_size
        sample = np.frombuffer(data, "<u4", -(-n // EVERY), at)
        return cls(n, limit, low_bits, low, high, sample), at + sample.nbytes

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        chunk = self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes()
        return (int.from_bytes(chunk, "little") >> (first % 8)) & ((1 << self.low_bits) - 1)

    def _eight(self, byte: int) -> int:
        """Eight bytes of the upper bits as one number."""
        return int.from_bytes(self.high[byte : byte + 8].tobytes(), "little")

    def select(self, i: int) -> int:
        """The i-th number, found from the nearest sampled one-bit."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, rest = int(self.sample[i // EVERY]), i % EVERY
        byte = place // 8
        value = self._eight(byte) >> (place % 8) << (place % 8)
        while rest >= (ones := value.bit_count()):
            rest -= ones
            byte += 8
            value = self._eight(byte)
        for _ in range(rest):
            value &= value - 1
        place = byte * 8 + (value & -value).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        """All numbers."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little")
        bits = bits.reshape(self.n, self.low_bits).astype(np.uint64)
        low = (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return high | low
