"""CRC-32 of many byte spans at once, from a table of byte contributions.

A CRC is linear over XOR: the checksum of a span is the XOR, over its bytes, of
a contribution that depends only on the byte and its distance from the span's
end, and of a constant for the span's length. The contributions of BLOCK
distances are a table; ``bitwise_xor.reduceat`` folds those of every span in
one call. A longer span is cut into blocks counted from its end: each block is
folded by the same table, and the running value is carried over the next block
by four more tables (what BLOCK zero bytes do to a register).
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 256
#: Span bytes that are looked up at a time.
CHUNK_BYTES = 1 << 14
_ALL = 0xFFFFFFFF


def _byte_table() -> np.ndarray:
    """Contribution of every byte at distance 0."""
    zero = zlib.crc32(b"\0")
    return np.array([zlib.crc32(bytes([b])) ^ zero for b in range(256)], np.uint32)


def _distance_table(first: np.ndarray) -> np.ndarray:
    """table[distance * 256 + byte]: each distance adds one zero byte behind."""
    rows = [first]
    for _ in range(BLOCK - 1):
        last = rows[-1]
        rows.append((last >> np.uint32(8)) ^ first[last & np.uint32(255)])
    return np.concatenate(rows)


def _carry_tables() -> np.ndarray:
    """carry[j, v]: register v << 8 j after BLOCK zero bytes."""
    zeros = bytes(BLOCK)
    return np.array([[zlib.crc32(zeros, (v << 8 * j) ^ _ALL) ^ _ALL for v in range(256)] for j in range(4)], np.uint32)


class SpanCrc:
    """Tables, built once per worker."""

    def __init__(self):
        self.table = _distance_table(_byte_table())
        self.carry = _carry_tables()
        self.constants = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], np.uint32)

    def _fold(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """XOR of the contributions of spans of 1 to BLOCK bytes."""
        lengths = ends - starts
        stops = np.cumsum(lengths)
        offsets = stops - lengths
        # A byte at distance d from its span's end is entry 256 d + byte of the table.
        at = np.arange(stops[-1])
        far = np.repeat(stops - 1, lengths)
        far -= at
        at -= np.repeat(offsets - starts, lengths)
        far <<= 8
        far += data.take(at)
        return np.bitwise_xor.reduceat(self.table.take(far), offsets)

    def _short(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.uint32)
        edges = np.cumsum(ends - starts) // CHUNK_BYTES
        cuts = np.flatnonzero(np.diff(edges)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)]):
            if i < j:
                out[i:j] = self._fold(data, starts[i:j], ends[i:j])
        return out

    def _shift(self, register: np.ndarray) -> np.ndarray:
        out = np.zeros_like(register)
        for j in range(4):
            out ^= self.carry[j][(register >> np.uint32(8 * j)) & np.uint32(255)]
        return out

    def _long(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Spans of more than BLOCK bytes: the odd block comes first, full blocks follow."""
        out = np.zeros(len(starts), np.uint32)
        for k, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
            first = start + ((end - start - 1) % BLOCK) + 1
            bounds = np.arange(first, end + 1, BLOCK, dtype=np.int64)
            folded = self._short(data, np.concatenate([[start], bounds[:-1]]), bounds)
            out[k] = self._join(folded) ^ np.uint32(zlib.crc32(bytes(end - start)))
        return out

    def _join(self, folded: np.ndarray) -> np.uint32:
        register = folded[:1]
        for value in folded[1:]:
            register = self._shift(register) ^ value
        return register[0]

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Unsigned CRC-32 of ``data[start:end]`` for every span (none empty)."""
        lengths = ends - starts
        small = lengths <= BLOCK
        if small.all():
            return self._short(data, starts, ends) ^ self.constants[lengths]
        out = np.zeros(len(starts), np.uint32)
        out[small] = self._short(data, starts[small], ends[small]) ^ self.constants[lengths[small]]
        out[~small] = self._long(data, starts[~small], ends[~small])
        return out
