"""Array helpers that run inside tasks: words and byte strings of many texts as hashes.

A chunk is a run of whole texts of an Arrow batch, at most ``CHUNK_BYTES`` long unless a
single text is longer, so that memory is bounded by the longest text and not by a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def random_words(name: str, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers for a name, the same on every machine."""
    seed = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def byte_table(name: str, fold_case: bool) -> np.ndarray:
    """A random number for each byte value; A-Z as a-z when folding."""
    table = random_words(name, 256)
    if fold_case:
        table[65:91] = table[97:123]
    return table


def space_table() -> np.ndarray:
    """True for the bytes 0x20 and 0x09-0x0D."""
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def binary_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of whole texts."""
    data, offsets = binary_parts(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last
    pa.default_memory_pool().release_unused()  # a worker that waits holds no more than it must


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    base = 0xD6E8FEB86659FD93
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Rolling:
    """Prefix sums from which the hash of any substring of a chunk follows at once."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, length: int) -> np.ndarray:
        """Hash of the ``length`` units from each position that has as many."""
        if len(self.sums) <= length:
            return np.zeros(0, np.uint64)
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n])


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray | None = None):
    """(start, end, row) of the words of a chunk; words never cross texts."""
    inside = ~(space_table() if separators is None else separators)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    return Rolling(table[data]).span(starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` neighbours."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def runs_within(rows: np.ndarray, length: int) -> np.ndarray:
    """True where the ``length`` units from a position belong to one text."""
    if len(rows) < length:
        return np.zeros(0, bool)
    return rows[: len(rows) - length + 1] == rows[length - 1 :]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """True for the positions below ``n`` within ``length`` of a start."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.subtract.at(edges, np.minimum(starts + length, n), 1)
    return np.cumsum(edges[:n]) > 0


def pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()
