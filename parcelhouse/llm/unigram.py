"""Log probabilities of pieces, estimated from all texts of a corpus.

A BPE model's file holds ranks of merges, not probabilities, so a best sum over them means
nothing. The pieces are kept and their probabilities estimated: pieces are counted over all texts,
first as the merges cut them, then as Viterbi cuts them by the probabilities so far. Tasks send one
count for each piece they met; what reaches the driver has the size of the vocabulary.

Defined results: null and empty texts count nothing; each piece counts one more than it was met, so
none is impossible, and without any text all are equally likely. Repeated rows count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.pieces import Lexicon
from parcelhouse.llm.sentencepiece_text import coder
from parcelhouse.llm.text_arrays import blocks

#: Counts by Viterbi after the one by merges.
ROUNDS = 1


def piece_counts(docs: DataFrame, path: str, scores: bytes | None = None, text: str = "text") -> np.ndarray:
    """How often each piece occurs, cut by ``scores`` or, without them, by merges."""

    def run(batches):
        both = coder(path, scores is None, scores)
        total = np.zeros(both.lexicon.size, np.int64)
        for block in blocks(batches, text):
            total += np.bincount(both.encode(block)[0], minlength=len(total))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["piece", "n"])

    counts = docs.select(text).mapInArrow(run, "piece bigint, n bigint")
    rows = counts.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(Lexicon(path).size, np.int64)
    out[rows.column("piece").to_numpy()] = rows.column("n").to_numpy()
    return out


def estimated_scores(docs: DataFrame, path: str, rounds: int = ROUNDS, text: str = "text") -> bytes:
    """Log probabilities of all pieces as the bytes of doubles, as ``encoded`` and ``token_counts`` take them."""
    pieces = Lexicon(path).ids
    scores = None
    for _ in range(rounds + 1):
        counts = piece_counts(docs, path, scores, text)
        value = np.full(len(counts), -np.inf)
        value[pieces] = np.log((counts[pieces] + 1) / (counts[pieces] + 1).sum())
        scores = value.tobytes()
    return scores
