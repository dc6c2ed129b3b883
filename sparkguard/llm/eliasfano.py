"""Elias-Fano coding of a non-decreasing sequence, with a select structure (numpy, one segment at a time)."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: One position in this many is stored, so that select() counts at most so many ones.
SELECT_EVERY = 64


@dataclass
class EliasFano:
    """``n`` values; ``l`` low bits of each packed in ``low``, the high parts as a unary bit string in ``high``.

    About 2 + log2(universe / n) bits a value; ``samples`` adds 32 / SELECT_EVERY bits (the bit position of every
    SELECT_EVERY-th value).
    """

    n: int
    l: int  # noqa: E741
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        low = b""
        if low_bits:
            bits = (v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        at = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(at[-1]) + 1, np.uint8)
        unary[at] = 1
        return cls(n, low_bits, low, np.packbits(unary, bitorder="little").tobytes(),
                   at[::SELECT_EVERY].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        first, last = i * self.l, (i + 1) * self.l
        word = int.from_bytes(self.low[first // 8:(last + 7) // 8], "little")
        return (word >> (first % 8)) & ((1 << self.l) - 1)

    def select(self, i: int) -> int:
        """The i-th value, read from the samples and the bits that follow; nothing is expanded."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(np.frombuffer(self.samples, "<u4")[i // SELECT_EVERY])
        left = i % SELECT_EVERY
        byte, skip = divmod(at, 8)
        word = self.high[byte] >> skip << skip
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        at = byte * 8 + (word & -word).bit_length() - 1
        return (at - i << self.l) | (self._low(i) if self.l else 0)

    def select_range(self, first: int, last: int) -> np.ndarray:
        """The values first..last-1: only the bits between their two samples are looked at."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last))
        if first == last:
            return np.empty(0, np.uint64)
        samples = np.frombuffer(self.samples, "<u4")
        run, after = first // SELECT_EVERY, -(-last // SELECT_EVERY)
        begin = int(samples[run])
        end = int(samples[after]) if after < len(samples) else 8 * len(self.high)
        bits = np.unpackbits(np.frombuffer(self.high[begin // 8:(end + 7) // 8], np.uint8), bitorder="little")
        ones = np.flatnonzero(bits) + begin // 8 * 8
        ones = ones[ones >= begin][first - run * SELECT_EVERY:last - run * SELECT_EVERY]
        v = (ones - np.arange(first, last)).astype(np.uint64) << np.uint64(self.l)
        if self.l:
            at, n = first * self.l, (last - first) * self.l
            bits = np.unpackbits(np.frombuffer(self.low[at // 8:(at + n + 7) // 8], np.uint8), bitorder="little")[at % 8:at % 8 + n]
            v |= bits.reshape(-1, self.l).astype(np.uint64) @ (np.uint64(1) << np.arange(self.l, dtype=np.uint64))
        return v

    def decode(self) -> np.ndarray:
        """All values."""
        if not self.n:
            return np.empty(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        v = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.l)
        if self.l:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.l)
            v |= bits.reshape(self.n, self.l).astype(np.uint64) @ (np.uint64(1) << np.arange(self.l, dtype=np.uint64))
        return v
