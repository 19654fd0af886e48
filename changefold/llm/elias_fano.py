"""Elias-Fano sequences and a two-level trie over them, read in place from one buffer."""

from __future__ import annotations

import numpy as np

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: Place of the k-th set bit of a byte.
_IN_BYTE = np.argsort(-_ONES.astype(np.int8), axis=1, kind="stable").astype(np.uint8)


class _Bits:
    """Select over a bit vector of 64-bit words, with running counts as its directory."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th set bit, from 0."""
        word = np.searchsorted(self.before, k, "right") - 1
        left = k - self.before[word]
        parts = self.words[word][:, None].view(np.uint8).reshape(len(k), 8)
        counts = np.cumsum(np.bitwise_count(parts), axis=1, dtype=np.int64)
        byte = (counts <= left[:, None]).sum(1)
        rows = np.arange(len(k))
        left = left - np.where(byte > 0, counts[rows, byte - 1], 0)
        return word * 64 + byte * 8 + _IN_BYTE[parts[rows, byte], left]


class EliasFano:
    """A monotone sequence of whole numbers: low bits packed, high parts as a unary bit vector."""

    def __init__(self, buffer: bytes | memoryview):
        head = np.frombuffer(buffer, np.int64, 4)
        self.n, self.low_bits, n_low, n_high = (int(x) for x in head)
        self.low = np.frombuffer(buffer, np.uint8, n_low, 32)
        ones = np.frombuffer(buffer, np.uint64, n_high, 32 + n_low)
        self.ones, self.zeros = _Bits(ones), _Bits(~ones)
        self.size = 32 + n_low + 8 * n_high

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, int(np.log2(max(1, top // max(1, n)))))
        low = ((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8).ravel()
        packed = np.packbits(low, bitorder="little")
        packed = np.concatenate((packed, np.zeros(8 + -len(packed) % 8, np.uint8)))  # a read takes 8 bytes
        high = np.zeros(-(-((top >> bits) + n + 2) // 64) * 64, np.uint8)
        high[(values >> bits) + np.arange(n)] = 1
        words = np.packbits(high, bitorder="little")
        return np.array([n, bits, len(packed), len(words) // 8], np.int64).tobytes() + packed.tobytes() + words.tobytes()

    def _low(self, at: np.ndarray) -> np.ndarray:
        first = at * self.low_bits
        byte, value = first >> 3, np.zeros(len(at), np.uint64)
        for k in range(8):
            value |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        value >>= (first & 7).astype(np.uint64)
        return (value & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.ones.select(at) - at) << self.low_bits) | self._low(at)

    def find(self, values: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None) -> np.ndarray:
        """The place of each value within [begin, end), or -1: successor search among those of its high part."""
        out = np.full(len(values), -1, np.int64)
        high = values >> self.low_bits
        known = (values >= 0) & (high < int(self.zeros.before[-1]))
        if not self.n or not known.any():
            return out
        high, rows = high[known], np.flatnonzero(known)
        at = np.where(high > 0, self.zeros.select(np.maximum(high - 1, 0)) - (high - 1), 0)
        stop = np.minimum(self.zeros.select(high) - high, self.n)
        at = np.maximum(at, np.broadcast_to(begin, len(values))[rows])
        stop = stop if end is None else np.minimum(stop, np.broadcast_to(end, len(values))[rows])
        low = values[rows] & ((1 << self.low_bits) - 1)
        while len(rows := rows[(live := at < stop)]):
            at, stop, low = at[live], stop[live], low[live]
            here = self._low(at)
            out[rows[here == low]] = at[here == low]
            more = here < low
            rows, at, stop, low = rows[more], at[more] + 1, stop[more], low[more]
        return out


class Trie:
    """Pairs (context, successor) with a code of one byte each: contexts, pointers to their ranges of successors, successors
    made monotone by their context's rank, and codes, one after the other in a buffer."""

    def __init__(self, buffer: bytes):
        view = memoryview(buffer)
        self.span = int(np.frombuffer(view, np.int64, 1)[0])
        at, self.levels = 8, []
        for _ in range(3):
            self.levels.append(EliasFano(view[at:]))
            at += self.levels[-1].size
        self.codes = np.frombuffer(view, np.uint8, offset=at)

    @staticmethod
    def encode(context: np.ndarray, successor: np.ndarray, codes: np.ndarray) -> bytes:
        """From pairs sorted by context, then successor."""
        contexts, first = np.unique(context, return_index=True)
        span = int(successor.max()) + 1 if len(successor) else 1
        rank = np.repeat(np.arange(len(contexts)), np.diff(np.append(first, len(context))))
        levels = (contexts, np.append(first, len(context)), rank * span + successor)
        return np.array([span], np.int64).tobytes() + b"".join(map(EliasFano.encode, levels)) + codes.astype(np.uint8).tobytes()

    def find(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The code of each pair, or 0."""
        contexts, pointers, successors = self.levels
        out = np.zeros(len(context), np.uint8)
        if not len(context):
            return out
        head = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))  # a run of one context is looked up once
        rank, sizes = contexts.find(context[head]), np.diff(np.append(head, len(context)))
        some = np.maximum(rank, 0)
        begin, end = (pointers.get(np.minimum(some + i, pointers.n - 1)) for i in (0, 1))
        rank, begin, end = (np.repeat(x, sizes) for x in (rank, begin, end))
        rows = np.flatnonzero((rank >= 0) & (successor < self.span))
        if len(rows):
            at = successors.find(rank[rows] * self.span + successor[rows], begin[rows], end[rows])
            out[rows[at >= 0]] = self.codes[at[at >= 0]]
        return out
