"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is a sequence of words and one end. Each is coded in binary decisions:

* if the word before it occurred earlier in the text, whether the same word follows again;
* else the path to it in a Huffman tree of the most frequent words, the end, and two leaves for
  known rarer words (drawn by their exact training counts) and for new words;
* a new word is spelled, byte by byte, in eight decisions each.

Four predictors answer every decision from the counts of hashed contexts (the decision alone,
the last frequent word, the last word, the last two words; in spelling up to three bytes).
Their log-odds are mixed with weights gated by the kind of decision; the weights go on learning
within each text, segment by segment, and a table of observed frequencies refines the mixture.
Every decision has a probability for both answers, so the product is a probability of the text.

Everything is counted over all training texts: word counts meet by hash in parts that grow with the
corpus, and come back as a dictionary for each bucket of texts; decision counts are summed over
tables of fixed size (a parameter), which alone are sent to all tasks. A word that occurs once
in training counts as new while the decisions are counted, so that new words are expected as
often as they come. Words are told apart by 64-bit hashes. Starting weights and refinement are learned from
all training texts too, each decision judged without its own count: in a bucket weights follow the texts
block by block, and buckets are averaged, each gate by the curvature of its loss.

Defined results: null and empty texts are one end; rows that share an id are scored each; a
missing id is trained on. Without any training text all words are new and predictors know nothing.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.prefix_free import pack, unpack
from parcelhouse.llm.scratch_tables import written
from parcelhouse.llm.text_arrays import Roller, blocks, mix

#: Words of the tree; slots of a context's table as a power of two; words that steer the second context.
TREE_WORDS, TABLE_BITS, STEERING = 1024, 20, 128
#: Tokens after which weights learn; how fast.
SEGMENT, RATE = 64, 0.004
#: Weights before any text, how many decisions' curvature they are worth, and rounds over a bucket's first block.
_START, _WORTH, _ROUNDS = 0.35, 5.0, 8
_BUCKET_BYTES, _CHUNK = 16 << 20, 1 << 20
_CONTEXTS, _GATES, _DEPTHS = 4, 18, 8
_RANGE = 16
_BINS, _SPAN = 32, 8.0
_RARE, _NEW, _END = -1, -2, -3
_END_HASH = 0x5EEDED0F0A7E57
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


class Tokens:
    """Words and ends of some texts in order: hash, text number, place of the spelling."""

    def __init__(self, block, roller: Roller):
        data = _LOWER[block.data]
        start, stop, text = block.words()
        n = len(block)
        count = np.bincount(text, minlength=n)
        at = np.arange(len(start)) + text
        size = len(start) + n
        self.data, self.n_texts, self.count = data, n, count + 1
        self.hash = np.full(size, _END_HASH, np.uint64)
        self.hash[at] = roller.spans(roller.sums(data), start, stop)
        self.start, self.stop = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.start[at], self.stop[at] = start, stop
        self.text = np.repeat(np.arange(n), self.count)
        self.end = np.ones(size, bool)
        self.end[at] = False
        self.inside = np.arange(size) - np.repeat(np.cumsum(self.count) - self.count, self.count)


def texts_of(table: pa.Table, size: int = _CHUNK):
    yield from blocks(table.combine_chunks().to_batches(), size=size)


# Counting words ---------------------------------------------------------------------------

_WORDS = "kind int, part int, n bigint, hash bigint, body binary"


def _rows(kind, part, n, hashes, body):
    return pa.table({
        "kind": pa.array(kind, pa.int32()), "part": pa.array(part, pa.int32()),
        "n": pa.array(n, pa.int64()), "hash": pa.array(hashes, pa.int64()),
        "body": pa.array(body, pa.binary())})


def _asked(bits: int):
    shift = np.uint64(64 - bits)

    def asked(key, table):
        """The distinct words of a bucket, with their training counts, for each part."""
        roller, held = Roller(23), []
        for block in texts_of(table):
            tokens = Tokens(block, roller)
            out = block.column("held_out").to_numpy(zero_copy_only=False)[tokens.text]
            hashes, count = np.unique(tokens.hash[~out], return_counts=True)
            held.append((hashes, count))
            hashes = np.unique(tokens.hash[out])
            held.append((hashes, np.zeros(len(hashes), np.int64)))
        hashes, which = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        count = np.bincount(which, weights=np.concatenate([c for _, c in held])).astype(np.uint64)
        part = (hashes >> shift).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        bucket = key[0].as_py()
        return _rows([bucket] * (len(cuts) - 1), part[cuts[:-1]], np.diff(cuts), [None] * (len(cuts) - 1),
                     [pack(hashes[a:b], count[a:b]) for a, b in zip(cuts, cuts[1:])])

    return asked


def _totalled(key, table):
    """Counts of a part's words: back to each bucket; and the most frequent ones, one row each."""
    buckets, sizes, bodies = (table.column(c).to_pylist() for c in ("kind", "n", "body"))
    got = [unpack(b, 2, n) for b, n in zip(bodies, sizes)]
    hashes, which = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate([g[1] for g in got])).astype(np.uint64)
    ends = np.cumsum(sizes)
    back = [pack(g[0], total[which[e - n : e]]) for g, e, n in zip(got, ends, sizes)]
    top = np.argsort(-total.astype(np.int64), kind="stable")[:TREE_WORDS]
    top = top[total[top] > 1]
    known = total[total > 0]
    stats = pack(np.array([known.sum()], np.uint64), np.array([len(known)], np.uint64),
                 np.array([(known == 1).sum()], np.uint64))
    return _rows([0] * len(back) + [1] * len(top) + [2],
                 buckets + [0] * (len(top) + 1),
                 [*sizes, *total[top].tolist(), 1],
                 [None] * len(back) + hashes[top].view(np.int64).tolist() + [None],
                 back + [None] * len(top) + [stats])


class Dictionary:
    """The words of a bucket: training counts, symbols, and which of them steer."""

    def __init__(self, table: pa.Table, code: Code):
        got = [unpack(b, 2, n) for b, n in
               zip(table.column("body").to_pylist(), table.column("n").to_pylist())]
        hashes = np.concatenate([g[0] for g in got]) if got else np.zeros(0, np.uint64)
        counts = np.concatenate([g[1] for g in got]) if got else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order].astype(np.int64)
        self.symbols = code.symbols(self.hashes)
        self.steers = self.symbols > 2
        self.steers[self.steers] = code.rank[self.symbols[self.steers] - 3] < STEERING
        bits = len(hashes).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where words of the bucket stand: from the first with the same leading bits onwards."""
        at = self.first[(hashes >> self.shift).view(np.int64)]
        left = np.flatnonzero(self.hashes[at] != hashes)
        while len(left):
            at[left] += 1
            left = left[self.hashes[at[left]] != hashes[left]]
        return at


# The decisions ----------------------------------------------------------------------------


def _spread(node):
    """Nodes as they go into the slots of each context."""
    return [node * odd for odd in _ODD[::-1]]


class Code:
    """The Huffman tree: for each symbol its decisions (inner node and answer)."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, rare: int, new: int, ends: int):
        #: Symbols: rare, new, end, then words by hash.
        order = np.argsort(hashes)
        self.hashes, self.rank = hashes[order], np.empty(len(hashes), np.int64)
        self.rank = order  # place by frequency
        weight = [max(1, rare), max(1, new), max(1, ends), *counts[order].tolist()]
        heap = [(w, i) for i, w in enumerate(weight)]
        heapq.heapify(heap)
        up, n = {}, len(weight)
        while len(heap) > 1:
            (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
            up[a], up[b] = (n, 0), (n, 1)
            heapq.heappush(heap, (wa + wb, n))
            n += 1
        paths = []
        for symbol in range(len(weight)):
            path = []
            while symbol in up:
                path.append(up[symbol])
                symbol = up[symbol][0]
            paths.append(path[::-1])
        self.length = np.array([len(p) for p in paths])
        self.first = np.cumsum(self.length) - self.length
        self.node = np.array([x for p in paths for x, _ in p], np.uint64)
        self.nodes = _spread(self.node)
        self.answer = np.array([x for p in paths for _, x in p], np.int8)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol number of each word; 0 (rare) for words outside the tree."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + 3, 0)


class Decisions:
    """All decisions of some tokens, gate by gate: token, answer and the four hashed contexts.

    ``size`` counts the decisions of each gate. Those of a gate and a token stand together and,
    within a gate, in the order of the tokens.
    """

    def __init__(self, tokens: Tokens, code: Code, known: Dictionary, place: np.ndarray, new: np.ndarray):
        n = len(tokens.hash)
        at = np.arange(n)
        head = np.cumsum(tokens.count) - tokens.count
        symbol = known.symbols[place]
        symbol[tokens.end] = 2
        symbol[(symbol == 0) & new] = 1
        self.rare = symbol == 0
        previous = np.concatenate(([np.uint64(0)], tokens.hash[:-1]))
        previous[head] = 1
        before = np.concatenate(([np.uint64(0)], previous[:-1]))
        before[head] = 1
        last = np.maximum.accumulate(np.where(known.steers[place], at, -1))
        last = np.concatenate(([-1], last[:-1]))
        same = last >= at - tokens.inside
        steer = np.where(same & (last >= 0), tokens.hash[last], np.uint64(2))
        contexts = [mix(steer), mix(previous + np.uint64(3)), mix(mix(before + np.uint64(5)) + previous)]

        #: The word that followed the last earlier occurrence of the word before.
        bits = n.bit_length()
        order = np.sort((place << bits) | at)
        again = (order[1:] >> bits) == (order[:-1] >> bits)
        order &= (1 << bits) - 1
        again &= tokens.text[order[1:]] == tokens.text[order[:-1]]
        source = np.full(n + 1, -1)
        source[order[1:][again] + 1] = order[:-1][again]
        source = source[:-1]
        source[head] = -1
        asked = np.flatnonzero(source >= 0)
        guess = source[asked] + 1
        hit = np.zeros(n, bool)
        hit[asked] = place[guess] == place[asked]
        miss_at = np.maximum.accumulate(np.where(hit, -1, at))
        streak = np.concatenate(([0], (at - miss_at)[:-1]))
        streak[head] = 0
        streak = np.minimum(streak[asked], 15).astype(np.uint64)
        self.coded = ~hit

        rest = np.flatnonzero(self.coded)
        length, first = code.length[symbol[rest]], code.first[symbol[rest]]
        spelled = np.flatnonzero(self.coded & (symbol == 1))
        letters = int((tokens.stop[spelled] - tokens.start[spelled] + 1).sum())
        total = len(asked) + int(length.sum()) + 8 * letters
        self.size = np.zeros(_GATES, np.int64)
        self.token, self.answer = np.empty(total, np.int64), np.empty(total, np.int8)
        self.slots = np.empty((_CONTEXTS, total), np.int64)

        wide = symbol[guess].astype(np.uint64)
        self._put(0, asked, hit[asked], [
            mix(streak + np.uint64(11)), mix(wide * np.uint64(16) + streak + np.uint64(1 << 20)),
            mix(contexts[1][asked] + streak), mix(contexts[2][asked] + np.uint64(13))],
            _spread(np.array([1 << 40], np.uint64)))
        self._paths(code, rest, length, first, [c[rest] for c in contexts])
        self._spelled(tokens, spelled)

    def _put(self, gate, token, answer, contexts, nodes):
        a = int(self.size.sum())
        b = a + len(token)
        self.size[gate] += len(token)
        self.token[a:b], self.answer[a:b] = token, answer
        for row, context, node in zip(self.slots.view(np.uint64)[:, a:b], contexts, nodes):
            np.bitwise_xor(context, node, out=row)
            row *= _ODD[0]
            row >>= np.uint64(64 - TABLE_BITS)

    def _paths(self, code: Code, token, length, first, contexts):
        """The paths of the given tokens, depth by depth; those of the last gate token by token."""
        for depth in range(_DEPTHS):
            on = length > depth
            if not on.all():
                token, length, first = token[on], length[on], first[on]
                contexts = [c[on] for c in contexts]
            at = first + depth
            if depth == _DEPTHS - 1:
                times = length - depth
                which = np.repeat(np.arange(len(token)), times)
                at = np.arange(len(which)) + np.repeat(at - (np.cumsum(times) - times), times)
                token, contexts = token[which], [c[which] for c in contexts]
            self._put(1 + depth, token, code.answer[at], [np.uint64(0), *contexts], [x[at] for x in code.nodes])

    def _spelled(self, tokens: Tokens, which: np.ndarray):
        """Eight decisions for each byte of the given words and for the zero byte after them."""
        size = tokens.stop[which] - tokens.start[which] + 1
        token = np.repeat(which, size)
        inside = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
        at = tokens.start[token] + inside
        last = inside == np.repeat(size, size) - 1
        data = np.concatenate((tokens.data, np.zeros(1, np.uint8)))
        byte = np.where(last, 0, data[np.minimum(at, len(data) - 1)]).astype(np.int64)

        def back(k):
            return np.where(inside >= k, data[np.maximum(at - k, 0)], 0).astype(np.uint64)

        one, two, three = back(1), back(2), back(3)
        contexts = [mix(np.minimum(inside, 3).astype(np.uint64) + np.uint64(101)), mix(one + np.uint64(1 << 9)),
                    mix(one + two * np.uint64(256) + np.uint64(1 << 18)),
                    mix(one + two * np.uint64(256) + three * np.uint64(65536) + np.uint64(1 << 27))]
        nodes = _spread(np.arange(256, dtype=np.uint64) + np.uint64(1 << 41))
        for bit in range(8):
            sofar = (1 << bit) | (byte >> (8 - bit))
            self._put(1 + _DEPTHS + bit, token, (byte >> (7 - bit)) & 1, contexts, [x[sofar] for x in nodes])

    def gates(self) -> np.ndarray:
        return np.repeat(np.arange(_GATES, dtype=np.int8), self.size)

    def cells(self, context: int) -> np.ndarray:
        """Slots of a context and the answers in one number."""
        out = self.slots[context] << 1
        out += self.answer
        return out


# Counting decisions -----------------------------------------------------------------------

_TABLE = "part int, n int, body binary"


def _counted(code: Code):
    def counted(key, table, dictionary):
        """Counts of the decisions of a bucket's training texts, for each range of slots."""
        if not table.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), "n": pa.array([], pa.int32()),
                             "body": pa.array([], pa.binary())})
        roller, known = Roller(23), Dictionary(dictionary, code)
        counts = np.zeros((_CONTEXTS, 2 << TABLE_BITS), np.uint32)
        for block in texts_of(table):
            tokens = Tokens(block, roller)
            place = known.places(tokens.hash)
            decisions = Decisions(tokens, code, known, place, known.counts[place] <= 1)
            for i in range(_CONTEXTS):
                np.add.at(counts[i], decisions.cells(i), np.uint32(1))
        flat = counts.ravel()
        at = np.flatnonzero(flat)
        part = at >> _RANGE
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        return pa.table({
            "part": pa.array(part[cuts[:-1]], pa.int32()), "n": pa.array(np.diff(cuts), pa.int32()),
            "body": pa.array([pack((at[a:b] & ((1 << _RANGE) - 1)).astype(np.uint64), flat[at[a:b]])
                              for a, b in zip(cuts, cuts[1:])], pa.binary())})

    return counted


def _summed(key, table):
    total = np.zeros(1 << _RANGE, np.float64)
    for n, body in zip(table.column("n").to_pylist(), table.column("body").to_pylist()):
        slot, count = unpack(body, 2, n)
        total[slot.astype(np.int64)] += count
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                     "n": pa.array([len(total)], pa.int32()),
                     "body": pa.array([total.astype("<f4").tobytes()], pa.binary())})


# Mixing -----------------------------------------------------------------------------------


def _stretched(zero, one):
    return np.log((one + 0.4) / (zero + 0.4))


def _squashed(x):
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


def _place(dot):
    return np.clip((dot / _SPAN + 1) / 2, 0, 1) * _BINS


def _without_own(counts: np.ndarray) -> np.ndarray:
    """Log-odds of each context as its decisions see them, by slot and answer: without their own count."""
    zero, one = counts[:, 0::2], counts[:, 1::2]
    out = np.empty(counts.shape, np.float32)
    out[:, 0::2] = _stretched(np.maximum(zero - 1, 0), one)
    out[:, 1::2] = _stretched(zero, np.maximum(one - 1, 0))
    return out


class Fit:
    """Starting weights and refinement learned block by block, each decision once after the first block."""

    def __init__(self):
        self.weights = np.full((_GATES, _CONTEXTS + 1), _START)
        self.weights[:, -1] = 0
        self.curve = np.zeros((_GATES, _CONTEXTS + 1, _CONTEXTS + 1))
        self.met = np.zeros((2, _GATES, _BINS + 1))

    def learn(self, x: np.ndarray, gate: np.ndarray, answer: np.ndarray):
        if (np.diff(gate) < 0).any():
            order = np.argsort(gate, kind="stable")
            x, gate, answer = x[order], gate[order], answer[order]
        cuts = np.searchsorted(gate, np.arange(_GATES + 1, dtype=gate.dtype))
        for g in range(_GATES):
            mine = slice(cuts[g], cuts[g + 1])
            a, y, curve = x[mine].T, answer[mine].astype(np.float32), 0
            if not len(y):
                continue
            before, first = self.weights[g].copy(), not self.curve[g].any()
            held = self.curve[g] + _WORTH * np.eye(_CONTEXTS + 1)
            for _ in range(_ROUNDS if first else 1):
                dot = self.weights[g].astype(np.float32) @ a
                p = _squashed(dot)
                curve = ((a * (p * (1 - p))) @ a.T).astype(float)
                slope = (a @ (p - y)).astype(float) + held @ (self.weights[g] - before)
                self.weights[g] -= np.linalg.solve(held + curve, slope)
            self.curve[g] += curve
            bin_ = np.rint(_place(dot)).astype(np.int64)
            met = np.bincount(bin_ * 2 + answer[mine], minlength=2 * _BINS + 2).reshape(-1, 2)
            self.met[0, g] += met.sum(axis=1)
            self.met[1, g] += met[:, 1]

    def sums(self) -> np.ndarray:
        """What buckets add up: curvatures, weights times them, decisions and ones by bin."""
        weighed = np.einsum("gij,gj->gi", self.curve, self.weights)
        return np.concatenate([self.curve.ravel(), weighed.ravel(), self.met.ravel()])


_FITTED = "bucket int, place int, value double"


def _fitted(shared):
    def fitted(key, table, dictionary):
        """The sums of a bucket's training texts, in the order of their hashes."""
        if not table.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "place": pa.array([], pa.int32()),
                             "value": pa.array([], pa.float64())})
        code, odds = shared.value
        roller, known, fit = Roller(23), Dictionary(dictionary, code), Fit()
        for block in texts_of(table.sort_by("hash")):
            tokens = Tokens(block, roller)
            place = known.places(tokens.hash)
            decisions = Decisions(tokens, code, known, place, known.counts[place] <= 1)
            x = np.ones((_CONTEXTS + 1, len(decisions.answer)), np.float32)
            for i in range(_CONTEXTS):
                x[i] = odds[i][decisions.cells(i)]
            fit.learn(x.T, decisions.gates(), decisions.answer)
        sums = fit.sums()
        return pa.table({"bucket": pa.array(np.full(len(sums), key[0].as_py()), pa.int32()),
                         "place": pa.array(np.arange(len(sums)), pa.int32()), "value": pa.array(sums)})

    return fitted


class Mixer:
    """Tables of log-odds, starting weights of each gate, and the table that refines."""

    def __init__(self, counts: np.ndarray):
        self.table = _stretched(counts[:, 0::2], counts[:, 1::2]).astype(np.float32)
        self.weights = np.full((_GATES, _CONTEXTS + 1), _START, np.float32)
        self.weights[:, -1] = 0
        centre = (np.arange(_BINS + 1) / _BINS * 2 - 1) * _SPAN
        self.refined = np.tile(_squashed(centre), (_GATES, 1))

    def inputs(self, slots) -> np.ndarray:
        out = np.ones((_CONTEXTS + 1, len(slots[0])), np.float32)
        for i, s in enumerate(slots):
            out[i] = self.table[i][s]
        return out.T

    def fit(self, sums: np.ndarray):
        """Weights and refinement from the sums of all buckets."""
        n = _CONTEXTS + 1
        curve, weighed, met = np.split(sums, np.cumsum([_GATES * n * n, _GATES * n]))
        held = curve.reshape(_GATES, n, n) + _WORTH * np.eye(n)
        weighed = weighed.reshape(_GATES, n) + _WORTH * self.weights
        self.weights = np.linalg.solve(held, weighed[:, :, None])[:, :, 0].astype(np.float32)
        count, ones = met.reshape(2, _GATES, _BINS + 1)
        self.refined = (ones + 20 * self.refined) / (count + 20)

    def probability(self, gate, dot):
        """Of answer 1: the mixture and its refinement in equal shares."""
        place = _place(dot)
        low = np.minimum(place.astype(np.int64), _BINS - 1)
        part = place - low
        low += gate * np.int64(_BINS + 1)
        refined = self.refined.ravel()[low]
        refined += (self.refined.ravel()[low + 1] - refined) * part
        return np.clip((_squashed(dot) + refined) / 2, 1e-6, 1 - 1e-6)

    def cost(self, tokens: Tokens, decisions: Decisions) -> np.ndarray:
        """Log2 probability of each text's decisions; weights learn after every segment."""
        n = tokens.n_texts
        segment = tokens.inside // SEGMENT
        if segment.max() < 1 << 16:
            segment = segment.astype(np.uint16)
        segment = segment[decisions.token]
        order = np.argsort(segment, kind="stable")
        segment = segment[order]
        cuts = np.flatnonzero(np.diff(segment, prepend=segment[:1] + 1, append=segment[-1:] + 1))
        gate, text = decisions.gates()[order], tokens.text[decisions.token[order]]
        answer = decisions.answer[order]
        x = self.inputs([s[order] for s in decisions.slots]).T
        # Within a segment a gate's decisions of a text are one run.
        set_ = gate * np.int64(n) + text
        edge = np.diff(set_, prepend=-1) != 0
        edge[cuts[:-1]] = True
        runs = np.flatnonzero(edge)
        size = np.diff(runs, append=len(order))
        weights = np.repeat(self.weights.T, n, axis=1)
        dots = np.empty(len(order), np.float32)
        for a, b, c, d in zip(cuts[:-1], cuts[1:], *np.searchsorted(runs, [cuts[:-1], cuts[1:]])):
            sets, inputs = set_[runs[c:d]], x[:, a:b]
            own = weights[:, sets]
            dot = dots[a:b] = np.einsum("ij,ij->j", inputs, np.repeat(own, size[c:d], axis=1))
            if b < len(order):
                wrong = answer[a:b] - _squashed(dot)
                weights[:, sets] = own + np.float32(RATE) * np.add.reduceat(inputs * wrong, runs[c:d] - a, axis=1)
        p = self.probability(gate, dots)
        return np.bincount(text, weights=np.log2(np.where(answer == 1, p, 1 - p)), minlength=n)


# Scores -----------------------------------------------------------------------------------

_SCORES = ("held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double, bits_per_byte double")


def _scoring(shared, total: int, types: int, rare: int):
    def score(key, table, dictionary):
        code, mixer = shared.value
        roller, known = Roller(23), Dictionary(dictionary, code)
        out = []
        for block in texts_of(table) if table.num_rows else ():
            tokens = Tokens(block, roller)
            n = tokens.n_texts
            place = known.places(tokens.hash)
            count = known.counts[place]
            base = np.bincount(tokens.text, weights=np.log10((count + 1) / (total + types + 1)), minlength=n)
            decisions = Decisions(tokens, code, known, place, count == 0)
            bits = mixer.cost(tokens, decisions)
            drawn = decisions.rare & decisions.coded
            bits += np.bincount(tokens.text[drawn], minlength=n,
                                weights=np.log2(np.maximum(count[drawn], 1) / max(rare, 1)))
            size = np.maximum(np.diff(block.offsets), 1)
            out.append(pa.RecordBatch.from_arrays([
                block.column("doc_id"), block.column("held_out"), pa.array(tokens.count.astype(np.int64)),
                pa.array(np.bincount(tokens.text, weights=count > 0, minlength=n).astype(np.int64)),
                pa.array(np.full(n, total, np.int64)), pa.array(base),
                pa.array(bits * np.log10(2)), pa.array(-bits / size),
            ], names=["doc_id", *(f.split()[0] for f in _SCORES.split(", "))]))
        if not out:
            names = ["doc_id", *(f.split()[0] for f in _SCORES.split(", "))]
            kinds = [table.schema.field("doc_id").type, pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 3]
            return pa.table({c: pa.array([], k) for c, k in zip(names, kinds)})
        return pa.Table.from_batches(out)

    return score


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(size // _BUCKET_BYTES + 1)
    bits = max(1, (size // (4 << 20)).bit_length())
    placed = texts.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int"))
    training = placed.where("NOT held_out")
    asked = placed.groupBy("bucket").applyInArrow(_asked(bits), _WORDS)
    counts = written(asked.groupBy("part").applyInArrow(_totalled, _WORDS), "word-counts")

    total = types = single = 0
    for row in counts.where("kind = 2").select("body").toLocalIterator():
        more = [int(x[0]) for x in unpack(bytes(row[0]), 3, 1)]
        total, types, single = total + more[0], types + more[1], single + more[2]
    top = counts.where(F.col("kind") == 1).where(F.col("hash") != _END_HASH).orderBy(
        F.desc("n"), "hash").limit(TREE_WORDS).select("hash", "n").toPandas()
    ends = texts.where("NOT held_out").count()
    rare = total - ends - int(top["n"].sum())
    code = Code(top["hash"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64),
                rare - single, single, ends)

    dictionary = counts.where("kind = 0").select(F.col("part").alias("bucket"), "n", "body")
    partial = training.groupBy("bucket").cogroup(dictionary.groupBy("bucket")).applyInArrow(
        _counted(code), _TABLE)
    summed = written(partial.groupBy("part").applyInArrow(_summed, _TABLE), "decisions")
    flat = np.zeros(_CONTEXTS * (2 << TABLE_BITS), np.float32)
    for row in summed.toLocalIterator():
        flat[row["part"] << _RANGE : (row["part"] + 1) << _RANGE] = np.frombuffer(bytes(row["body"]), "<f4")
    flat = flat.reshape(_CONTEXTS, -1)

    mixer = Mixer(flat)
    odds = spark.sparkContext.broadcast((code, _without_own(flat)))
    fitted = training.withColumn("hash", F.xxhash64("doc_id", "text")).groupBy("bucket").cogroup(
        dictionary.groupBy("bucket")).applyInArrow(_fitted(odds), _FITTED)
    # Added in the order of buckets, so that a repeated run gives the same sums.
    parts = F.array_sort(F.collect_list(F.struct("bucket", "value")))
    sums = fitted.groupBy("place").agg(
        F.aggregate(parts, F.lit(0.0), lambda a, b: a + b["value"]).alias("value")).orderBy("place").toPandas()
    if len(sums):
        mixer.fit(sums["value"].to_numpy())
    odds.destroy()
    shared = spark.sparkContext.broadcast((code, mixer))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.groupBy("bucket").cogroup(dictionary.groupBy("bucket")).applyInArrow(
        _scoring(shared, total, types, rare), f"doc_id {kind}, {_SCORES}")
