"""Near-duplicate classes by ProbMinHash, banding and exact verification.

Every distinct shingle of five words is an element; its weight is one plus the logarithm of its
count in the text. An element emits a Poisson process at the rate of its weight; each arrival falls on one of 80
registers, and a register keeps the element of its earliest arrival. Arrivals later than the
latest register of a text can't change it, so elements stop early. Two texts agree in a
register with the probability Jaccard similarity of their weighted shingles.

Twenty bands of four registers make buckets; texts with similarity 0.8 miss all of them
with probability 3e-5. A text whose counts differ adds twenty bands drawn with equal weights, whose
registers agree with the Jaccard similarity of the sets, so neither similarity loses links to the other; for other texts
both signatures are the same. Candidates are compared exactly: texts are linked if the probability Jaccard similarity
or that of the shingle sets is at least the threshold. First each bucket's members are compared with its
smallest id, and classes are formed; a group of thousands of copies takes as many comparisons
as it has members. Where a bucket still holds several classes, the texts outside its largest class
are compared with all others, through the bucket's lists of shingles and in blocks of bounded size; only
links come out, at most one for each text and class. So no link inside a bucket is lost.

Defined results: texts are compared word by word (case counts); null is an empty text; texts
of fewer than five words are linked to equal texts only; a text of any length is compared whole, as a block of its own;
rows that share an id are one document;
a row without an id gets the class of its equal texts, else null; an empty table gives no rows. The class id is the
smallest id of the class. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.components import components
from parcelhouse.llm.scratch_tables import written
from parcelhouse.llm.text_arrays import Roller, blocks, mix
from parcelhouse.plans.scratch import materialize

SHINGLE_WORDS, BANDS, ROWS, THRESHOLD = 5, 20, 4, 0.8
REGISTERS = BANDS * ROWS
#: Texts of a block, where a bucket with several classes is compared block by block.
_BLOCK_TEXTS = 2048
#: Members of one smallest id are spread over as many tasks.
_SALTS = 256
#: Weights travel as 32-bit floats between classes; a similarity this far below the threshold counts.
_ROUNDING = 1e-6
_STEP = 0x9E3779B97F4A7C15
_SKETCH = "doc_id bigint, digest binary, n_shingles bigint, bands array<bigint>"


def shingles(block, roller: Roller, words: int = SHINGLE_WORDS):
    """Text number and hash of every shingle of a block, repeats included."""
    starts, ends, text = block.words()
    if len(starts) < words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = roller.spans(roller.sums(block.data), starts, ends)
    n = len(hashes) - words + 1
    joined = hashes[:n].copy()
    for i in range(1, words):
        joined = mix(joined * np.uint64(3) + hashes[i : i + n])
    whole = text[:n] == text[words - 1 :]
    return text[:n][whole], joined[whole]


def weighted(text: np.ndarray, hashes: np.ndarray):
    """Distinct elements of each text: text number, hash and count."""
    _, first, count = np.unique(
        mix(hashes + mix(text.astype(np.uint64))), return_index=True, return_counts=True)
    return text[first], hashes[first], count


def signatures(text, element, weight, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The winning elements (32 bits of their hash) of every register of every text."""
    latest = np.uint64((1 << 64) - 1)
    state = np.full(n_texts * registers, latest, np.uint64)
    time = np.zeros(len(element), np.float32)
    who = element >> np.uint64(32)
    rate = weight.astype(np.float32)
    turn = 0
    while len(element):
        turn += 1
        x = mix(element + np.uint64(_STEP * turn % (1 << 64)))
        u = ((x >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24)
        time = time - np.log(u) / rate
        register = ((x & np.uint64(0xFFFFFF)) * np.uint64(registers) >> np.uint64(24)).astype(np.int64)
        packed = (time.view(np.uint32).astype(np.uint64) << np.uint64(32)) | who
        np.minimum.at(state, text * registers + register, packed)
        bound = (state.reshape(n_texts, registers).max(axis=1) >> np.uint64(32)).astype(np.uint32)
        on = time.view(np.uint32) < bound[text]
        text, element, who, rate, time = text[on], element[on], who[on], rate[on], time[on]
    return (state & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(n_texts, registers)


def _weights(count: np.ndarray) -> np.ndarray:
    return 1 + np.log(count)


def _bands(register: np.ndarray) -> np.ndarray:
    register = register.astype(np.uint64).reshape(len(register), BANDS, ROWS)
    band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), register.shape[:2])
    for i in range(ROWS):
        band = mix(band * np.uint64(5) + register[:, :, i])
    return band


def _sketches(batches):
    roller = Roller()
    for block in blocks(batches):
        n = len(block)
        text, element, count = weighted(*shingles(block, roller))
        size = np.bincount(text, minlength=n)
        equal = _bands(signatures(text, element, np.ones(len(element)), n))
        low, high = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        np.minimum.at(low, text, count)
        np.maximum.at(high, text, count)
        uneven = low < high
        mine = uneven[text]
        drawn = _bands(signatures(
            (np.cumsum(uneven) - 1)[text[mine]], element[mine], _weights(count[mine]), int(uneven.sum())))
        many = BANDS * ((size > 0) + uneven.astype(np.int64))
        ends = np.cumsum(many)
        band = np.empty(ends[-1], np.uint64)
        band[(ends - many)[size > 0, None] + np.arange(BANDS)] = equal[size > 0]
        band[(ends - BANDS)[uneven, None] + np.arange(BANDS)] = drawn
        whole = block.data.tobytes()
        at = block.offsets.tolist()
        digest = [hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([
            block.column("doc_id"),
            pa.array(digest, pa.binary()),
            pa.array(size.astype(np.int64)),
            pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(band.view(np.int64))),
        ], names=["doc_id", "digest", "n_shingles", "bands"])


def sketches(docs: DataFrame) -> DataFrame:
    """Digest, number of shingles and band hashes of every text."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(_sketches, _SKETCH)


def probability_jaccard(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> float:
    """Of the weights of two texts, which share the elements at ``i`` and ``j``.

    The sum over shared elements of 1 / (sum over all elements of max(x / x[i], y / y[j]));
    in order of x / y the inner sums are running sums.
    """
    a, b = x[i], y[j]
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    from_here = x.sum() - np.cumsum(a) + a
    before = y.sum() - b.sum() + np.cumsum(b) - b
    return float((a / (from_here + a / b * before)).sum())


def _lists(block, roller: Roller):
    """Sorted elements and weights of each text."""
    text, element, count = weighted(*shingles(block, roller))
    order = np.lexsort((element, text))
    element, weight = element[order], _weights(count[order])
    at = np.searchsorted(text[order], np.arange(len(block) + 1)).tolist()
    return [(element[a:b], weight[a:b]) for a, b in zip(at, at[1:])]


def similar(one, other, threshold: float) -> bool:
    """Whether two texts, given as of ``_lists``, are similar by their sets or by their weights."""
    (x, p), (y, q) = one, other
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(both):
        return False
    if len(both) >= threshold * (len(x) + len(y) - len(both)):
        return True
    return probability_jaccard(p, q, i, j) >= threshold - _ROUNDING


def _links(threshold: float):
    def linked(batches):
        """Rows of (pivot, salt) come together, the pivot's text first."""
        roller, key, sets = Roller(), None, []
        for block in blocks(batches):
            a, b = [], []
            rows = zip(*(block.column(c).to_pylist() for c in ("pivot", "salt", "member")))
            for mine, (pivot, salt, member) in zip(_lists(block, roller), rows):
                if (pivot, salt) != key:
                    key, sets = (pivot, salt), []
                if member is None:
                    sets.append(mine)
                elif any(similar(mine, other, threshold) for other in sets):
                    a.append(pivot)
                    b.append(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return linked


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(pivot, member)`` whose texts are similar; members of a pivot are salted."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(_SALTS)))
    wanted = pairs.select(
        F.col("member").alias("doc_id"), "pivot", "salt", F.col("member")
    ).union(
        pairs.select("pivot", "salt").distinct().select(
            F.col("pivot").alias("doc_id"), "pivot", "salt", F.lit(None).cast("bigint")))
    rows = texts.join(wanted, "doc_id").select("pivot", "salt", "member", "text")
    rows = rows.repartition("pivot", "salt").sortWithinPartitions(
        "pivot", "salt", F.col("member").asc_nulls_first())
    return rows.mapInArrow(_links(threshold), "a bigint, b bigint")


def _listed(batches):
    """Sorted shingle hashes and weights of every text, each as one binary value."""
    roller = Roller()
    for block in blocks(batches):
        lists = _lists(block, roller)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array([x.tobytes() for x, _ in lists], pa.binary()),
             pa.array([w.astype(np.float32).tobytes() for _, w in lists], pa.binary())],
            names=["rep", "shingles", "weights"])


def _across(threshold: float):
    def across(key, table):
        """Links between different classes: of each text that asks with the others."""
        rep, label, asks, outside = (
            table.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "label", "asks", "outside"))
        lists = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]
        weights = [np.frombuffer(x.as_py(), np.float32).astype(float) for x in table.column("weights")]
        size = np.array([len(x) for x in lists])
        share = np.concatenate([w / w.sum() for w in weights])
        _, place = np.unique(np.concatenate(lists), return_inverse=True)
        owner = np.repeat(np.arange(len(rep)), size)
        order = np.argsort(place, kind="stable")
        held, held_share = owner[order], share[order]
        start = np.searchsorted(place[order], np.arange(place.max() + 2))
        mine = np.cumsum(size) - size
        a, b = [], []
        for x in np.flatnonzero(asks):
            span = slice(mine[x], mine[x] + size[x])
            runs = place[span]
            count = start[runs + 1] - start[runs]
            at = np.repeat(start[runs] - np.cumsum(count) + count, count) + np.arange(count.sum())
            both = np.bincount(held[at], minlength=len(rep))
            #: Two texts outside the largest class ask for each other; once is enough.
            other = (label != label[x]) & ~asks & ~(outside & (rep < rep[x]))
            linked = other & (both >= threshold * (size[x] + size - both))
            #: The probability Jaccard similarity is at most the shared part of the shares.
            most = np.bincount(held[at], minlength=len(rep), weights=np.minimum(
                np.repeat(share[span], count), held_share[at]))
            for y in np.flatnonzero(other & ~linked & (most >= threshold - 2 * _ROUNDING)):
                linked[y] = similar((lists[x], weights[x]), (lists[y], weights[y]), threshold)
            _, first = np.unique(label[linked], return_index=True)
            partner = np.flatnonzero(linked)[first]
            a += [rep[x]] * len(partner)
            b += rep[partner].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return across


def _between_classes(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between texts that share a bucket and are of different classes.

    Texts outside the bucket's largest class ask, in blocks; each block of them meets each block of all
    members. The largest class is sent once for each block that asks, mostly one.
    """
    stats = members.groupBy("bucket", "label").agg(F.count("rep").alias("n")).groupBy("bucket").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"))
    stats = stats.where("top.n < size").select(
        "bucket", F.col("top.label").alias("largest"),
        F.ceil((F.col("size") - F.col("top.n")) / _BLOCK_TEXTS).cast("int").alias("asking"),
        F.ceil(F.col("size") / _BLOCK_TEXTS).cast("int").alias("blocks"))
    mixed = materialize(members.join(stats, "bucket").withColumn(
        "outside", F.col("label") != F.col("largest")), "mixed")
    listed = texts.join(mixed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    listed = listed.select("doc_id", "text").mapInArrow(
        _listed, "rep bigint, shingles binary, weights binary")

    def place(asks: bool):
        own, every = ("asking", "blocks") if asks else ("blocks", "asking")
        own = F.pmod(F.xxhash64("rep"), F.col(own)).cast("int").alias("own")
        return mixed.where("outside" if asks else "true").select(
            "bucket", "rep", "label", "outside", F.lit(asks).alias("asks"), own,
            F.explode(F.sequence(F.lit(0), F.col(every) - 1)).alias("each")).select(
            "bucket", "rep", "label", "outside", "asks",
            F.struct(*(("own", "each") if asks else ("each", "own"))).cast("struct<a:int,b:int>").alias("cell"))

    return place(True).union(place(False)).join(listed, "rep").groupBy("bucket", "cell").applyInArrow(
        _across(threshold), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, class_id)`` of every row; see the module's docstring."""
    sketch = materialize(sketches(docs), "sketches")
    nodes = materialize(
        sketch.groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands")), "texts")
    bucketed = nodes.where("rep IS NOT NULL AND n > 0").select(
        "rep", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = bucketed.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top"))
    shared = shared.where("pivot < top").select("bucket", "pivot")
    members = materialize(bucketed.join(shared, "bucket"), "buckets")

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    needed = members.select(F.explode(F.array("rep", "pivot")).alias("doc_id")).distinct()
    texts = written(docs.join(needed, "doc_id"), "candidates")

    first = materialize(
        members.where("rep <> pivot").select("pivot", F.col("rep").alias("member")).distinct(), "pairs")
    links = written(_verified(first, texts, threshold), "verified")
    labels = components(links)

    marked = materialize(
        members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            "bucket", "rep", F.coalesce("label", "rep").alias("label")), "marked")
    more = written(_between_classes(marked, texts, threshold).distinct(), "more")
    if not more.isEmpty():
        labels = components(links.union(more))
    classes = nodes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("label", "rep").alias("class_id"))
    return sketch.select("doc_id", "digest").join(classes, "digest").select("doc_id", "class_id")
