"""Toxicity of whole texts by a gated recurrent network over all overlapping windows of words.

A window of ``WINDOW`` words starts at every word of a text. Stretches of ``STRETCH`` words are read once,
in both directions, and all windows within a stretch are pooled from its states by running sums (see
``gated_network``), so each window of a text is scored exactly once, with the words around it as context.

The network is trained on a bounded sample of the labelled documents outside the held-out part: up to
``SAMPLE`` toxic and as many others, the first by a hash of their id, none longer than ``TEXT_BYTES``
and at most ``SAMPLE_BYTES`` together. A label belongs to a text, not to a window: a text's most suspicious window stands for it,
at first by the words' log-odds, later by the network itself; other texts add random
windows. A text's logit is that of its highest window, brought to a probability on the sample,
weighted to the true shares of the labels.

Defined results: null and empty texts have no window and get the score of a window far below all
others; a text shorter than a window is one window; a text of any length is scored whole, a block of its own;
equal windows give equal logits, so ties don't matter; labels given twice count as toxic if one says so;
labels of unknown documents are not used; rows that share an id are scored each, and the least of their texts is
trained on; an empty table gives no rows. Without both labels the score is the share of toxic ones
(0 if there is no label at all). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.llm.gated_network import GRAMS, WORDS, Network, Vocabulary
from parcelhouse.llm.text_arrays import Block, Roller, blocks, mix

SAMPLE = 1500
#: Words of a window, of which one starts at every word; words that are read at once.
WINDOW, STRETCH = 24, 60
#: Training texts together, and the longest of them.
SAMPLE_BYTES, TEXT_BYTES = 64 << 20, 1 << 20
#: The least trust in a toxic label, as a root.
LEAST_TRUST = 0.03
_EPOCHS, _BATCH, _STEPS, _RATE = 10, 256, 15, 0.01
_AT_ONCE = 1024
_FAR_BELOW = -12.0
_BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SIGN = np.ones(256, bool)
_SIGN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Reader:
    """Words of a block as numbers of its distinct words; signs around a word don't count."""

    def __init__(self):
        self.roller = Roller(17)

    def read(self, block: Block):
        """Word numbers, texts they are in, and the vocabulary."""
        data = _LOWER[block.data]
        start, end, text = block.words()
        for _ in range(3):
            start = start + ((end - start > 1) & _SIGN[data[start]] if len(start) else 0)
            end = end - ((end - start > 1) & _SIGN[data[end - 1]] if len(start) else 0)
        sums = self.roller.sums(data)
        key, first, which = np.unique(
            self.roller.spans(sums, start, end), return_index=True, return_inverse=True)
        a, b = start[first], end[first]
        many = np.maximum(b - a - 2, 1)
        word = np.repeat(np.arange(len(key)), many)
        at = np.repeat(a - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        gram = self.roller.spans(sums, at, np.minimum(at + 3, b[word]))
        vocabulary = Vocabulary(
            (key % np.uint64(WORDS)).astype(np.int64), (gram % np.uint64(GRAMS)).astype(np.int64), word)
        return which, text, vocabulary


def stretches_of(text: np.ndarray, n_texts: int):
    """First words, sizes and texts of the stretches that are read at once.

    Consecutive stretches share a window's length less one word, so each window lies in exactly one.
    """
    count = np.bincount(text, minlength=n_texts)
    first = np.cumsum(count) - count
    step = STRETCH - WINDOW + 1
    many = np.where(count > 0, np.maximum(-(-(count - WINDOW + 1) // step), 1), 0)
    owner = np.repeat(np.arange(n_texts), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    return first[owner] + nth * step, np.minimum(count[owner] - nth * step, STRETCH), owner


def _matrix(which: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.minimum(np.arange(size.max())[None, :], size[:, None] - 1)
    return which[at]


def search(value, which, start, size):
    """The highest window of each stretch and its first place, by ``value(words, sizes)``."""
    best, low = np.full(len(start), -np.inf), np.zeros(len(start), np.int64)
    order = np.argsort(size, kind="stable")
    for a in range(0, len(order), _AT_ONCE):
        part = order[a : a + _AT_ONCE]
        values = value(_matrix(which, start[part], size[part]), size[part])
        low[part], best[part] = values.argmax(axis=0), values.max(axis=0)
    return best, low


def _by_network(network: Network, vocabulary: Vocabulary):
    x = network.inputs(vocabulary)
    return lambda words, size: network.over(x, words, size, WINDOW)


def _by_words(odds: np.ndarray, rng):
    """The highest log-odds of a window's words; equal windows in random order."""
    def value(words, size):
        of = np.where(np.arange(words.shape[1])[None, :] < size[:, None], odds[words], -np.inf)
        width = min(WINDOW, words.shape[1])
        top = np.lib.stride_tricks.sliding_window_view(of, width, axis=1).max(axis=2).T
        exists = np.arange(len(top))[:, None] + WINDOW <= np.maximum(size, WINDOW)
        return np.where(exists, top + 1e-6 * rng.random(top.shape), -np.inf)

    return value


def _highest(value: np.ndarray, owner: np.ndarray, n: int):
    """The highest value of each owner, and its row (-1 for none)."""
    best, row = np.full(n, _FAR_BELOW, np.float64), np.full(n, -1)
    order = np.lexsort((value, owner))
    last = np.flatnonzero(np.diff(owner[order], append=-1))
    row[owner[order][last]] = order[last]
    best[owner[order][last]] = value[order][last]
    return best, row


class Model:
    """A network with the line that turns a text's highest logit into a probability."""

    def __init__(self, network: Network | None, slope: float, offset: float):
        self.network, self.slope, self.offset = network, slope, offset

    def scores(self, reader: Reader, block: Block) -> np.ndarray:
        n = len(block)
        best = np.full(n, _FAR_BELOW)
        if self.network and len(block.data):
            which, text, vocabulary = reader.read(block)
            start, size, owner = stretches_of(text, n)
            found, _ = search(_by_network(self.network, vocabulary), which, start, size)
            best, _ = _highest(found, owner, n)
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.offset, -60, 60)))


def _line(value: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """Weighted logistic regression of the label on the highest logit, by Newton steps."""
    x = np.stack((value, np.ones_like(value)), axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(h, x.T @ (weight * (p - label)) + 1e-3 * w)
    return float(max(w[0], 1e-3)), float(w[1])


def train(texts: pa.Array, label: np.ndarray, shares: tuple[float, float], seed: int = 9) -> Model:
    """Fit on sample texts; ``shares`` are the numbers of other and toxic rows they stand for."""
    rng = np.random.Generator(np.random.PCG64(seed))
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    block = next(blocks([batch], size=1 << 62))
    n = len(block)
    which, text, vocabulary = Reader().read(block)
    start, size, owner = stretches_of(text, n)
    held = np.unique(text * np.int64(len(vocabulary.word)) + which)
    in_text, word = held // len(vocabulary.word), held % len(vocabulary.word)
    with_label = [np.bincount(word[label[in_text] == k], minlength=len(vocabulary.word)) for k in (0, 1)]
    odds = np.log((with_label[1] + 1) / (label.sum() + 2)) - np.log(
        (with_label[0] + 1) / (n - label.sum() + 2))
    network = Network()
    #: Drawn to zero for rare words; embeddings start from these log-odds.
    seen = with_label[0] + with_label[1]
    odds *= seen / (seen + 4)
    np.add.at(network.p["words"][:, 0], vocabulary.word, (odds / 2).astype(np.float32))
    suspicion, low = search(_by_words(odds, rng), which, start, size)
    network.begin()
    #: Labels are noisy: a toxic text without a suspicious word says little about its windows.
    trust = np.ones(n)
    found, _ = _highest(suspicion, owner, n)
    usual = max(float(np.quantile(found[label == 1], 0.9)), 1e-3)
    trust[label == 1] = np.clip(found[label == 1] / usual, LEAST_TRUST, 1) ** 2
    weight = np.array(shares)[label] / np.bincount(label, minlength=2)[label]
    for epoch in range(_EPOCHS):
        if epoch in (_EPOCHS // 2, _EPOCHS - 2):
            suspicion, low = search(_by_network(network, vocabulary), which, start, size)
        _, row = _highest(suspicion, owner, n)
        row = row[row >= 0]
        others = np.flatnonzero(label[owner] == 0)
        drawn = rng.choice(others, min(len(others), n))
        rows = np.concatenate((row, drawn))
        lows = np.concatenate((low[row], rng.integers(0, np.maximum(size[drawn] - WINDOW, 0) + 1)))
        mixed = rng.permutation(len(rows))
        step = min(_BATCH, len(rows) // _STEPS + 1)
        for a in range(0, len(rows), step):
            part, place = rows[mixed[a : a + step]], lows[mixed[a : a + step]]
            words = _matrix(which, start[part], size[part])
            used, inner = np.unique(words, return_inverse=True)
            grams = np.isin(vocabulary.gram_word, used)
            small = Vocabulary(vocabulary.word[used], vocabulary.gram[grams],
                               np.searchsorted(used, vocabulary.gram_word[grams]))
            goal = label[owner[part]].astype(np.float32)
            network.train(small, inner.reshape(words.shape), size[part], place,
                          np.minimum(place + WINDOW, size[part]), goal,
                          trust[owner[part]].astype(np.float32), _RATE * (1 - epoch / _EPOCHS))
    found, _ = search(_by_network(network, vocabulary), which, start, size)
    best, _ = _highest(found, owner, n)
    network.moments, network.start = None, {}
    return Model(network, *_line(best, label, weight / weight.mean()))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on labelled documents outside the held-out part."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(~held_out())
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect() if r["toxic"] in (0, 1)}
    drawn = None
    for k in (0, 1):
        part = known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        drawn = part if drawn is None else drawn.union(part)
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(
        F.octet_length("text") <= TEXT_BYTES).join(F.broadcast(drawn), "doc_id")
    #: At most 2 * sample rows of bounded length come to the window.
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sofar = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    chosen = chosen.withColumn("bytes", F.sum(F.octet_length("text")).over(sofar)).where(
        F.col("bytes") <= SAMPLE_BYTES).select("doc_id", "text", "toxic")
    rows = chosen.toArrow().sort_by([("doc_id", "ascending")])
    label = rows.column("toxic").to_numpy().astype(np.int64)
    texts = rows.column("text").combine_chunks().cast(pa.string())
    if len(set(label.tolist())) < 2:
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return Model(None, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    return train(texts, label, (float(counts[0]), float(counts[1])))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        reader = Reader()
        for block in blocks(batches, size=_BLOCK):
            score = shared.value.scores(reader, block)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(score),
                 pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")
