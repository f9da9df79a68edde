"""Token counts of texts, each distinct pre-token counted once in a worker.

Counts come from unigram forward scores over a trie of the pre-tokens, without encoding
(``pieces.trie_counts``); the scores are those of a unigram model, or ``scores`` that ``unigram`` has
estimated. With ``merges`` tokens follow the merge order of a BPE model instead. Defined results: null and empty texts have no tokens; a table
without rows gives none; other columns pass through.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelhouse.llm.memory import Memory
from parcelhouse.llm.pieces import Lexicon, marked, stretches, trie_counts
from parcelhouse.llm.pieces import merges as merged
from parcelhouse.llm.sentencepiece_text import coder
from parcelhouse.llm.text_arrays import blocks


@functools.lru_cache(maxsize=1)
def counter(path: str, merges: bool, scores: bytes | None):
    """The worker's lexicon for ``path`` and the counts it remembers from earlier tasks."""
    coder.cache_clear()  # what an earlier pass has left in this worker
    return Lexicon(path, scores), Memory()


def token_counts(docs: DataFrame, path: str, text: str = "text", merges: bool = False,
                 scores: bytes | None = None) -> DataFrame:
    """``docs`` without ``text``, with ``n_pretokens`` and ``n_tokens``."""
    out = ("n_pretokens", "n_tokens")
    names = [c for c in docs.columns if c not in (text, *out)]

    def count(batches):
        lexicon, memory = counter(path, merges, scores)

        def learn(data):
            def one(a, b):
                many = merged(lexicon, data, a, b)[1] if merges else trie_counts(lexicon, data, a, b)
                return many, np.ones(len(a), np.int64)

            return one

        for block in blocks(batches, text):
            whole, n = marked(block), len(block)
            if len(whole.data):
                start = stretches(whole)
                tokens, _ = memory.numbers_of(whole, start, learn(whole.data))
                which = np.searchsorted(whole.offsets, start, "right") - 1
                many = np.bincount(which, minlength=n), np.bincount(which, weights=tokens, minlength=n)
            else:
                many = np.zeros(n), np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in names] + [pa.array(m.astype(np.int64)) for m in many],
                names=[*names, *out])

    schema = T.StructType(
        [docs.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in out])
    return docs.select(*names, text).mapInArrow(count, schema)
