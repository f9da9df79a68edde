"""SentencePiece encoding and decoding of whole texts (see ``pieces``).

Ids have the greatest sum of scores, by Viterbi: the scores of a unigram model, or ``scores`` that
``unigram`` has estimated for the pieces of any model. With ``merges`` they follow the merge order of
a BPE model instead, as the library's do (but for word marks in the text).

Decoding an encoding gives the text back, byte for byte, whatever it holds: a word mark that
a text itself contains is written as bytes, unlike spaces. Ids are packed as little-endian
unsigned 16-bit numbers (32-bit for lexicons beyond 65,536).

Defined results: null and empty texts have no ids and decode to an empty text; other columns
pass through (none may be called like the output column, which is replaced).
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelhouse.llm.memory import Memory
from parcelhouse.llm.pieces import Lexicon, marked, merges, stretches, viterbi
from parcelhouse.llm.text_arrays import blocks


def id_type(lexicon: Lexicon) -> str:
    return "<u2" if lexicon.size <= 1 << 16 else "<u4"


class Coder:
    """Encodes blocks and decodes packed ids."""

    def __init__(self, path: str, by_merges: bool = False, scores: bytes | None = None):
        self.lexicon = Lexicon(path, scores)
        self.search = merges if by_merges else viterbi
        self.memory = Memory()
        self.type = id_type(self.lexicon)
        ends = np.cumsum([len(b) for b in self.lexicon.bytes])
        self.raw = np.frombuffer(b"".join(self.lexicon.bytes), np.uint8)
        self.size = np.array([len(b) for b in self.lexicon.bytes])
        self.first = ends - self.size

    def encode(self, block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block and how many each text has."""
        text = marked(block)
        if not len(text.data):
            return np.zeros(0, self.type), np.zeros(len(block), np.int64)
        start = stretches(text)
        ids, count = self.memory.numbers_of(
            text, start, lambda a, b: self.search(self.lexicon, text.data, a, b))
        which = np.searchsorted(text.offsets, start, "right") - 1
        return ids.astype(self.type), np.bincount(
            which, weights=count, minlength=len(block)).astype(np.int64)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and the number of bytes of each; the space put first is taken off."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = self.raw[np.repeat(self.first[ids] - (ends - size), size) + np.arange(total)]
        which = np.repeat(np.arange(len(count)), count)
        sizes = np.bincount(which, weights=size, minlength=len(count)).astype(np.int64)
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        return np.delete(data, first), sizes - (sizes > 0)


# One at a time: what a coder remembers is most of a worker's memory.
@functools.lru_cache(maxsize=1)
def coder(path: str, by_merges: bool = False, scores: bytes | None = None) -> Coder:
    """The worker's coder for ``path``, with what it remembers from earlier tasks."""
    return Coder(path, by_merges, scores)


def _column(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes * values.itemsize)))
    return pa.Array.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()),
                                        pa.py_buffer(values.tobytes())]).cast(kind)


def _with(rows: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in rows.schema.names if n != name]
    return pa.RecordBatch.from_arrays(
        [rows.column(rows.schema.get_field_index(n)) for n in names] + [column], names=[*names, name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids",
           merges: bool = False, scores: bytes | None = None) -> DataFrame:
    """``docs`` with the packed ids of ``text``."""

    def run(batches):
        both = coder(path, merges, scores)
        for block in blocks(batches, text):
            values, count = both.encode(block)
            yield _with(block.rows, ids, _column(values, count, pa.binary()))

    return docs.mapInArrow(run, _schema(docs, ids, T.BinaryType()))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the text of the packed ids."""

    def run(batches):
        both = coder(path)
        for block in blocks(batches, ids):
            values = np.frombuffer(block.data.tobytes(), both.type)
            count = np.diff(block.offsets) // values.itemsize
            yield _with(block.rows, text, _column(*both.decode(values, count), pa.string()))

    return docs.mapInArrow(run, _schema(docs, text, T.StringType()))


def encoded(docs: DataFrame, path: str, text: str = "text", merges: bool = False,
            scores: bytes | None = None) -> DataFrame:
    """``docs`` without ``text``, with ``ids``, ``n_pieces`` and ``round_trip``: whether the ids,
    decoded, are the text. Both directions run over a block while it is at hand."""
    out = ("ids", "n_pieces", "round_trip")
    names = [c for c in docs.columns if c not in (text, *out)]

    def run(batches):
        both = coder(path, merges, scores)
        for block in blocks(batches, text):
            values, count = both.encode(block)
            data, sizes = both.decode(values, count)
            same = sizes == np.diff(block.offsets)
            if same.all():
                differs = np.flatnonzero(data != block.data)
                same[np.searchsorted(block.offsets, differs, "right") - 1] = False
            else:
                ends = np.cumsum(sizes)
                for i in np.flatnonzero(same):
                    same[i] = np.array_equal(
                        data[ends[i] - sizes[i] : ends[i]],
                        block.data[block.offsets[i] : block.offsets[i + 1]])
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in names]
                + [_column(values, count, pa.binary()), pa.array(count), pa.array(same)],
                names=[*names, *out])

    kinds = (T.BinaryType(), T.LongType(), T.BooleanType())
    schema = T.StructType(
        [docs.schema[c] for c in names] + [T.StructField(c, k) for c, k in zip(out, kinds)])
    return docs.select(*names, text).mapInArrow(run, schema)
