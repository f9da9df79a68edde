"""Byte-level BPE ids of whole texts, each distinct stretch between safe cuts encoded once.

The tokenizer's pattern never joins a non-blank with a following blank, nor a letter with a
following punctuation mark, and looks only forward. Cutting there leaves the ids unchanged,
so a stretch's ids can be reused wherever it occurs. Where a cut isn't certain (marks beyond two
bytes, control characters) none is made. A text that holds a special token is encoded whole.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
from tokenizers import Tokenizer

from parcelhouse.llm.memory import Memory
from parcelhouse.llm.text_arrays import Block, spans_as_list

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
#: Stretches given to the tokenizer at once; its results are large.
_AT_ONCE = 4096


def cuts(block: Block) -> np.ndarray:
    """Where stretches begin, text starts included."""
    data, n = block.data, len(block.data)
    before = np.concatenate((data[:1] * 0, data[:-1]))
    lead = np.concatenate((data[:2] * 0, data[:-2]))[:n]
    accented = (before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead < 0xE0)
    letter = _LETTER[before] | (accented & (lead == 0xC3) & (before != 0x97) & (before != 0xB7))
    cut = (_BLANK[data] & (_PRINTED[before] | accented)) | (_MARK[data] & letter)
    starts = block.offsets[:-1][np.diff(block.offsets) > 0]
    cut[starts] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of the texts of blocks; remembers stretches by hash and length."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory()
        self.size = self.tokenizer.get_vocab_size()

    def _ids(self, texts: list[str]):
        parts, count = [np.zeros(0, np.uint32)], []
        for a in range(0, len(texts), _AT_ONCE):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(
                texts[a : a + _AT_ONCE], add_special_tokens=False)]
            count += map(len, ids)
            parts.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32))
        return np.concatenate(parts), np.array(count, np.int64)

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, text after text, and how many each text has."""
        n = len(block)
        if not len(block.data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        if any(s in block.data.tobytes() for s in self.specials):
            whole = block.data.tobytes()
            at = block.offsets.tolist()
            return self._ids([whole[a:b].decode() for a, b in zip(at, at[1:])])
        start = cuts(block)
        ids, count = self.memory.numbers_of(block, start, lambda a, b: self._ids(
            [s.decode() for s in spans_as_list(block.data, a, b)]))
        text = np.searchsorted(block.offsets, start, "right") - 1
        return ids, np.bincount(text, weights=count, minlength=n).astype(np.int64)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for ``path``, with what it remembers from earlier tasks."""
    return Encoder(path)
