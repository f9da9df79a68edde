"""What a worker remembers of stretches of text: number runs found by 64-bit hash."""

from __future__ import annotations

import numpy as np

from parcelhouse.llm.text_arrays import Block, Roller

#: Stretches remembered; beyond them the memory starts anew, which changes no result.
_REMEMBERED = 3_000_000


class Memory:
    """``learn(starts, stops)`` gives the numbers of new stretches of a block and how many each has."""

    def __init__(self, seed: int = 7):
        self.roller = Roller(seed)
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.numbers = np.zeros(0, np.uint32)

    def numbers_of(self, block: Block, start: np.ndarray, learn):
        """The numbers of all stretches in order and how many each stretch has; stretches
        begin at ``start`` and end where the next one begins."""
        stop = np.concatenate((start[1:], [len(block.data)]))
        hashes = self.roller.spans(self.roller.sums(block.data), start, stop)
        hashes += (stop - start).astype(np.uint64)
        keys, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > _REMEMBERED:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = sample[~known]
            numbers, count = learn(start[new], stop[new])
            where, held = at[~known], len(self.first)
            self.first = np.concatenate((self.first, len(self.numbers) + np.cumsum(count) - count))
            self.count = np.concatenate((self.count, count))
            self.numbers = np.concatenate((self.numbers, numbers.astype(np.uint32)))
            self.keys = np.insert(self.keys, where, keys[~known])
            self.slots = np.insert(self.slots, where, np.arange(held, held + len(new)))
        slot = self.slots[np.searchsorted(self.keys, keys)][which]
        count = self.count[slot]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.numbers[np.repeat(self.first[slot] - (ends - count), count) + np.arange(total)], count
