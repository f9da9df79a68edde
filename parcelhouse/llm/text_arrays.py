"""Texts of an Arrow batch as one byte array, with word spans and hashes of any span.

A rolling sum of ``table[byte] * base ** position`` modulo 2**64 gives the hash of every span
in constant time: the difference of two sums times the inverse power of its start. All later
steps are numpy operations over whole blocks; a block holds whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Blank bytes: space and 0x09 to 0x0D.
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BLOCK_BYTES = 2 << 20
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all 64 bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Roller:
    """Hashes of spans. Powers are kept and grow with the longest block seen."""

    def __init__(self, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(1, 1 << 64, 256, dtype=np.uint64)
        self.base = int(rng.integers(1 << 62, 1 << 63)) | 5
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grown(self, base: int, n: int) -> np.ndarray:
        out = np.full(n, base & _MASK, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Rolling sums of a block; entry i is the sum before byte i."""
        n = len(data) + 1
        if n > len(self.powers):
            size = max(n, _BLOCK_BYTES + 1)
            self.powers = self._grown(self.base, size)
            self.inverses = self._grown(pow(self.base, -1, 1 << 64), size)
        out = np.zeros(n, np.uint64)
        np.cumsum(self.table[data] * self.powers[: n - 1], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.inverses[starts])


class Block:
    """Some rows of a batch and the bytes of their texts (null counts as empty)."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets

    def __len__(self):
        return len(self.offsets) - 1

    def column(self, name: str) -> pa.Array:
        return self.rows.column(self.rows.schema.get_field_index(name))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text numbers of the words."""
        solid = ~IS_BLANK[self.data]
        n = len(solid)
        if not n:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate(([True], ~solid[:-1])) | edge[:-1]
        after = np.concatenate((~solid[1:], [True])) | edge[1:]
        starts = np.flatnonzero(solid & before)
        ends = np.flatnonzero(solid & after) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1


def blocks(batches, text: str = "text", size: int = _BLOCK_BYTES):
    """Cut batches into blocks of at most ``size`` text bytes, a longer text alone in its block."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        if not len(column):
            continue
        _, where, raw = column.buffers()
        offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
        first = 0
        while first < len(column):
            last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
            last = min(max(last, first + 1), len(column))
            at = offsets[first : last + 1]
            yield Block(batch.slice(first, last - first), data[at[0] : at[-1]], at - at[0])
            first = last


def spans_as_list(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
