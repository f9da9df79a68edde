"""A lexicon of scored pieces, and two searches over it in batches of numpy operations.

Pieces and scores come from a SentencePiece model file. Scores of a BPE model are ranks: ``merges``
joins the neighbours that make the piece of the best score (of equal scores the leftmost), again
and again, as the library does. Scores of a unigram model are log probabilities, or are estimated for
the pieces of any model (``unigram``): ``viterbi`` finds the pieces
with the greatest sum of scores (of equal sums, the one whose last piece is longest, and so on
backwards). A character that no piece covers is written as its bytes; in a sum it costs more than any piece.
Spaces stand for the word mark, and one is put before every text that isn't empty.

No piece goes on with a space after another character, and none holds a line feed, so a text
can be cut there without changing its best segmentation; each distinct stretch is
segmented once in a worker.
"""

from __future__ import annotations

import heapq

import numpy as np
import sentencepiece

from parcelhouse.llm.text_arrays import Block, Roller

_MARK = "▁"
_SPACE, _LINE = 0x20, 0x0A
_BATCH_BYTES = 1 << 18
_FILTER_BITS = 20
#: Characters of a run that is merged on its own, in steps that don't grow with its length.
_LONG_RUN = 256


class Lexicon:
    def __init__(self, path: str, scores: bytes | None = None):
        """``scores``: doubles that replace the scores of the file, one for each piece."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.size = size
        self.bytes = [b""] * size
        self.byte_id = np.full(256, -1, np.int64)
        self.score = np.full(size + 2, -np.inf)
        ids, keys = [], []
        for i in range(size):
            if model.is_byte(i):
                self.byte_id[int(model.id_to_piece(i)[3:5], 16)] = i
                self.bytes[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes[i] = model.id_to_piece(i).replace(_MARK, " ").encode()
                self.score[i] = model.get_score(i)
                ids.append(i)
                keys.append(self.bytes[i])
        inner = [k for k in keys if b" " in k.lstrip(b" ") or b"\n" in k]
        if inner or (self.byte_id < 0).any():
            raise ValueError("pieces with inner marks, or without all bytes, can't be cut safely")
        if scores is not None:
            self.score[ids] = np.frombuffer(scores, np.float64)[ids]
        #: Piece ``size`` is an uncovered character; the last entry is no piece at all.
        self.score[size] = self.score[ids].min() - 10
        self.longest = max(map(len, keys))
        self.roller = Roller(11)
        whole = np.frombuffer(b"".join(keys), np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        hashes = self.roller.spans(
            self.roller.sums(whole), ends - [len(k) for k in keys], ends)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(ids)[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.keys & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        self.best = {self.bytes[i]: float(self.score[i]) for i in ids}
        #: Characters that stand side by side in some piece; no merge crosses any other two.
        two = sorted({a + b for k in keys for a, b in zip(k.decode(), k.decode()[1:])})
        two = [x.encode() for x in two]
        ends = np.cumsum([len(x) for x in two])
        self.neighbours = np.sort(self.roller.spans(
            self.roller.sums(np.frombuffer(b"".join(two), np.uint8)), ends - [len(x) for x in two], ends))

    def adjoin(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the two characters of each hash stand side by side in some piece."""
        at = np.minimum(np.searchsorted(self.neighbours, hashes), len(self.neighbours) - 1)
        return self.neighbours[at] == hashes

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash; ``size + 1`` where there is none."""
        out = np.full(len(hashes), self.size + 1, np.int32)
        may = np.flatnonzero(
            self.filter[(hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[may]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[may]
        out[may[hit]] = self.ids[at[hit]]
        return out

    def characters(self, data: np.ndarray) -> np.ndarray:
        """Bytes of the character that begins at each byte (0 inside a character)."""
        size = np.ones(len(data), np.int8)
        size[data >= 0xC0] = 2
        size[data >= 0xE0] = 3
        size[data >= 0xF0] = 4
        size[(data >= 0x80) & (data < 0xC0)] = 0
        return size


def marked(block: Block) -> Block:
    """The block with a space before every text that isn't empty."""
    sizes = np.diff(block.offsets)
    data = np.insert(block.data, block.offsets[:-1][sizes > 0], _SPACE)
    offsets = np.concatenate(([0], np.cumsum(sizes + (sizes > 0))))
    return Block(block.rows, data, offsets)


def stretches(block: Block) -> np.ndarray:
    """Where the stretches of a marked block begin: at runs of spaces and around line feeds."""
    data = block.data
    before = np.concatenate((data[:1] * 0, data[:-1]))
    cut = ((data == _SPACE) & (before != _SPACE)) | (data == _LINE) | (before == _LINE)
    cut[block.offsets[:-1][np.diff(block.offsets) > 0]] = True
    return np.flatnonzero(cut)


def batches_of(start: np.ndarray, stop: np.ndarray, alike):
    """Row numbers of spans in batches of some bytes; spans of a batch have equal ``alike``."""
    order = np.argsort(alike, kind="stable")
    size = (stop - start)[order]
    kind = alike[order]
    done = np.cumsum(size) // _BATCH_BYTES
    new = np.flatnonzero(np.concatenate(
        ([True], (kind[1:] != kind[:-1]) | (done[1:] != done[:-1]), [True])))
    for a, b in zip(new[:-1], new[1:]):
        yield order[a:b]


def viterbi(lexicon: Lexicon, data: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Best piece ids of every span, one span after the other, and how many each has.

    Spans of equal length advance together, one end position at a time.
    """
    sums = lexicon.roller.sums(data)
    character = lexicon.characters(data)
    none, unknown = lexicon.size + 1, lexicon.size
    spans, froms, pieces, lengths = [], [], [], []
    for rows in batches_of(start, stop, stop - start):
        base, size = start[rows], int(stop[rows[0]] - start[rows[0]])
        reach = min(size, lexicon.longest)
        n = len(rows)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, size + 1), np.int8 if lexicon.longest < 128 else np.int16)
        taken = np.zeros((n, size + 1), np.int32)
        line = np.arange(n)
        for end in range(1, size + 1):
            near = min(end, reach)
            begin = base[:, None] + np.arange(end - near, end)[None, :]
            piece = lexicon.find(lexicon.roller.spans(
                sums, begin.ravel(), np.repeat(base + end, near))).reshape(n, near)
            alone = (piece == none) & (character[begin] == np.arange(near, 0, -1)[None, :])
            piece[alone] = unknown
            value = best[:, end - near : end] + lexicon.score[piece]
            pick = np.argmax(value, axis=1)
            best[:, end] = value[line, pick]
            back[:, end] = near - pick
            taken[:, end] = piece[line, pick]
        at = np.full(n, size)
        open_ = line
        while len(open_):
            step = back[open_, at[open_]].astype(np.int64)
            pieces.append(taken[open_, at[open_]])
            at[open_] -= step
            spans.append(rows[open_])
            froms.append(base[open_] + at[open_])
            lengths.append(step)
            open_ = open_[at[open_] > 0]
    if not spans:
        return np.zeros(0, np.int64), np.zeros(len(start), np.int64)
    span, begin, piece, length = (np.concatenate(c) for c in (spans, froms, pieces, lengths))
    order = np.lexsort((begin, span))
    span, begin, piece, length = span[order], begin[order], piece[order], length[order]
    times = np.where(piece == unknown, length, 1)
    ends = np.cumsum(times)
    inner = np.arange(int(ends[-1])) - np.repeat(ends - times, times)
    wide = np.repeat(piece, times).astype(np.int64)
    raw = np.repeat(begin, times) + inner
    wide[wide == unknown] = lexicon.byte_id[data[raw[wide == unknown]]]
    return wide, np.bincount(span, weights=times, minlength=len(start)).astype(np.int64)


def _merged_run(lexicon: Lexicon, data: bytes, heads: list[int]) -> list[int]:
    """The inner heads of a long run that merges take away, by a heap."""
    n = len(heads)
    end = [*heads[1:], len(data)]
    left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    heap, gone = [], []

    def offer(a: int, b: int):
        if a >= 0 and b >= 0:
            score = lexicon.best.get(data[heads[a] : end[b]])
            if score is not None:
                heapq.heappush(heap, (-score, a, b, end[b]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, a, b, stop = heapq.heappop(heap)
        if not (alive[a] and alive[b] and right[a] == b and end[b] == stop):
            continue
        gone.append(heads[b])
        alive[b], end[a], right[a] = False, stop, right[b]
        if right[b] >= 0:
            left[right[b]] = a
        offer(left[a], a)
        offer(a, right[a])
    return gone


def merges(lexicon: Lexicon, data: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Piece ids of every span by the order of merges, one span after the other, and how many each has.

    Spans are cut between characters that no piece holds side by side. Runs of as many characters
    advance together, each by its own best merge.
    """
    size = stop - start
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return np.zeros(0, np.int64), np.zeros(len(start), np.int64)
    data = data[np.repeat(start - (ends - size), size) + np.arange(total)]
    sums = lexicon.roller.sums(data)

    def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return lexicon.score[lexicon.find(lexicon.roller.spans(sums, a.ravel(), b.ravel()))].reshape(a.shape)

    edge = np.append(lexicon.characters(data) > 0, True)
    first = np.zeros(total + 1, bool)
    first[ends - size] = first[total] = True
    edge |= first
    heads = np.flatnonzero(edge)
    new = first[heads]
    new[1:-1] |= ~lexicon.adjoin(lexicon.roller.spans(sums, heads[:-2], heads[2:]))
    run = np.flatnonzero(new)
    many = np.diff(run)
    run = run[:-1]
    for i in np.flatnonzero(many > _LONG_RUN):
        at = heads[run[i] : run[i] + many[i] + 1]
        gone = _merged_run(lexicon, data[at[0] : at[-1]].tobytes(), (at[:-1] - at[0]).tolist())
        edge[at[0] + np.array(gone, np.int64)] = False
    some = np.flatnonzero((many > 1) & (many <= _LONG_RUN))
    for rows in batches_of(heads[run[some]], heads[run[some] + many[some]], many[some]) if len(some) else ():
        rows = some[rows]
        bound = heads[run[rows][:, None] + np.arange(many[rows[0]] + 1)[None, :]]
        value = scores(bound[:, :-2], bound[:, 2:])
        while True:
            pick = np.argmax(value, axis=1)
            on = value[np.arange(len(pick)), pick] > -np.inf
            if not on.all():
                bound, value, pick = bound[on], value[on], pick[on]
            n, wide = bound.shape
            if not n:
                break
            line = np.arange(n)
            edge[bound[line, pick + 1]] = False
            if wide == 3:
                break
            keep = np.ones((n, wide), bool)
            keep[line, pick + 1] = False
            bound = bound[keep].reshape(n, wide - 1)
            keep = np.ones((n, wide - 2), bool)
            keep[line, pick] = False
            value = value[keep].reshape(n, wide - 3)
            for rows_, pair in ((line[pick > 0], pick[pick > 0] - 1),
                                (line[pick < wide - 3], pick[pick < wide - 3])):
                value[rows_, pair] = scores(bound[rows_, pair], bound[rows_, pair + 2])
    begin = np.flatnonzero(edge)
    length = np.diff(begin)
    begin = begin[:-1]
    piece = lexicon.find(lexicon.roller.spans(sums, begin, begin + length)).astype(np.int64)
    raw = piece == lexicon.size + 1
    times = np.where(raw, length, 1)
    last = np.cumsum(times)
    at = np.repeat(begin, times) + np.arange(int(last[-1])) - np.repeat(last - times, times)
    out, raw = np.repeat(piece, times), np.repeat(raw, times)
    out[raw] = lexicon.byte_id[data[at[raw]]]
    span = np.searchsorted(ends, begin, "right")
    return out, np.bincount(span, weights=times, minlength=len(start)).astype(np.int64)


def trie_counts(lexicon: Lexicon, data: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Number of pieces of every span, by a trie of the spans.

    Spans are sorted, so that a span shares the nodes of its common prefix with the one before.
    Every node, whatever the number of spans through it, gets its forward score once, from its
    ancestors; the count at the node that ends a span is the span's count.
    """
    sums = lexicon.roller.sums(data)
    character = lexicon.characters(data)
    none, unknown = lexicon.size + 1, lexicon.size
    out = np.zeros(len(start), np.int64)
    sizes = stop - start
    classes = np.ceil(np.log2(np.maximum(sizes, 8))).astype(np.int64)
    whole = data.tobytes()
    sort = np.array(sorted(range(len(start)), key=lambda i: whole[start[i] : stop[i]]), np.int64)
    for rows in batches_of(start[sort], stop[sort], classes[sort]):
        rows = sort[rows]
        base, size = start[rows], sizes[rows]
        n, deep = len(rows), int(size.max())
        shared = np.zeros(n, np.int64)
        on = np.arange(1, n)
        for depth in range(deep):
            on = on[(size[on] > depth) & (size[on - 1] > depth)]
            on = on[data[base[on] + depth] == data[base[on - 1] + depth]]
            if not len(on):
                break
            shared[on] = depth + 1
        best, count = np.full((n, deep + 1), -np.inf), np.zeros((n, deep + 1), np.int32)
        best[:, 0] = 0
        #: The row whose entries hold a row's node at a depth: its own, or the first that shares it.
        owner = np.zeros((n, deep + 1), np.int32)
        line = np.arange(n)
        for depth in range(1, deep + 1):
            owner[:, depth] = np.maximum.accumulate(np.where(shared < depth, line, 0))
            node = line[(shared < depth) & (size >= depth)]
            near = min(depth, lexicon.longest)
            if not len(node):
                continue
            begin = np.arange(depth - near, depth)
            where = base[node][:, None] + begin[None, :]
            piece = lexicon.find(lexicon.roller.spans(
                sums, where.ravel(), np.repeat(base[node] + depth, near))).reshape(len(node), near)
            alone = (piece == none) & (character[where] == np.arange(near, 0, -1)[None, :])
            piece[alone] = unknown
            holder = owner[node][:, depth - near : depth]
            value = best[holder, begin[None, :]] + lexicon.score[piece]
            pick = np.argmax(value, axis=1)
            each = np.arange(len(node))
            best[node, depth] = value[each, pick]
            more = np.where(piece[each, pick] == unknown, near - pick, 1)
            count[node, depth] = count[holder[each, pick], begin[pick]] + more
        out[rows] = count[owner[line, size], size]
    return out
