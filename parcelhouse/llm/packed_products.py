"""Hard negatives by Kronecker-packed products.

Components become integers. Several candidates are packed into one: their components, biased
above zero, stand in separate fields of a wide integer, wide enough that the sum over all
components of one product never runs into the next field. One multiplication of an anchor's
component with that integer so serves all candidates in it, and the fields of the sum, less what
the biases added, are the exact inner products. The integers stay below 2**53, where doubles
hold every integer, so that the sums of products are a matrix product; components too large for
a field are split into digits, each packed for itself, and put together again modulo 2**64.

Anchors meet candidates in cells of a grid, a group of anchors against a chunk of candidates,
whose sizes are bounded in bytes. Two passes run over the grid: the first keeps each cell's best
rows of the anchor's label, the second, once all positives are known, each cell's best rows of
other labels inside the window that a positive opens. Only those few rows are shuffled again.

Defined results: rows without an id or label, and vectors that are null, of another length than
most (the longer of two equally frequent lengths), or that hold null or non-finite components take
no part, nor do vectors with a component so large that a score might not fit a long. Of rows that share an id only
the one with the smallest label, then vector, counts. Zero vectors and vectors without components score 0. Equal
scores are ordered by id. An anchor without positives, or a positive without negatives in its
window, has no rows; so has an empty table. Only the three named columns are read, whatever others there are.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.llm.scratch_tables import written

#: Doubles hold all integers up to this many bits.
_WIDE = 53
_CELL_BYTES = 32 << 20
#: Least number of chunks, so that small tables are dealt out too; anchors and candidates at a time.
_CHUNKS, _ANCHORS, _BLOCK = 16, 256, 4096
_NONE = np.iinfo(np.int64).min


class Packed:
    """Candidates packed for products with anchors; both have components within ``bound``."""

    def __init__(self, candidates: np.ndarray, bound: int):
        self.count, self.size = candidates.shape
        self.bound = bound
        top = 2 * bound
        if self.size * top * top < 1 << _WIDE:
            self.digit = max(1, top.bit_length())
            most = self.size * top * top
        else:
            self.digit = (_WIDE - self.size.bit_length()) // 2
            most = self.size * ((1 << self.digit) - 1) ** 2
        self.digits = -(-max(1, top.bit_length()) // self.digit)
        self.field = max(1, most.bit_length())
        self.fields = _WIDE // self.field
        self.sums = candidates.sum(axis=1).astype(np.uint64)
        biased = np.zeros((-(-self.count // self.fields) * self.fields, self.size), np.int64)
        biased[: self.count] = candidates + bound
        self.wide = []
        for d in self._digits_of(biased):
            parts = d.reshape(-1, self.fields, self.size)
            shifts = (np.arange(self.fields, dtype=np.int64) * self.field)[None, :, None]
            self.wide.append((parts << shifts).sum(axis=1).astype(np.float64).T.copy())

    def _digits_of(self, biased: np.ndarray) -> list[np.ndarray]:
        mask = (1 << self.digit) - 1
        return [(biased >> (self.digit * i)) & mask for i in range(self.digits)]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """The exact inner product of every anchor with every candidate."""
        biased = anchors + self.bound
        total = np.zeros((len(anchors), self.wide[0].shape[1], self.fields), np.uint64)
        low = np.uint64((1 << self.field) - 1)
        for i, a in enumerate(self._digits_of(biased)):
            left = a.astype(np.float64)
            for j, wide in enumerate(self.wide):
                sums = (left @ wide).astype(np.uint64)
                up = np.uint64(self.digit * (i + j) % 64)
                if self.digit * (i + j) >= 64:
                    continue  # such digits only add multiples of 2**64
                for f in range(self.fields):
                    total[:, :, f] += ((sums >> np.uint64(f * self.field)) & low) << up
        scores = total.reshape(len(anchors), -1)[:, : self.count]
        bias = np.uint64(self.bound)
        scores -= bias * anchors.sum(axis=1).astype(np.uint64)[:, None]
        scores -= bias * self.sums[None, :] + np.uint64(self.size * self.bound**2 % (1 << 64))
        return scores.view(np.int64)


def _integers(table: pa.Table, column: str, scale: float) -> np.ndarray:
    values = table.column(column).combine_chunks()
    if not len(values):
        return np.zeros((0, 0), np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(len(values), -1).astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, many: int):
    """Places of the ``many`` greatest scores of each row, ties to smaller ids; ``_NONE`` is no score."""
    if scores.shape[1] > many:
        bound = np.partition(scores, scores.shape[1] - many, axis=1)[:, scores.shape[1] - many, None]
        i, j = np.nonzero((scores >= bound) & (scores > _NONE))
    else:
        i, j = np.nonzero(scores > _NONE)
    order = np.lexsort((ids[j], -scores[i, j], i))
    i, j = i[order], j[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < many
    return i[keep], j[keep]


def _cells(anchors, candidates, scale: float):
    """Blocks of a cell: (places of anchors, ids and labels of candidates, scores)."""
    a, c = _integers(anchors, "vector", scale), _integers(candidates, "vector", scale)
    if not len(a) or not len(c):
        return
    bound = max(int(np.abs(a).max(initial=0)), int(np.abs(c).max(initial=0)), 1)
    ids, labels = (candidates.column(n).to_numpy() for n in ("vec_id", "label"))
    for at in range(0, len(c), _BLOCK):
        packed = Packed(c[at : at + _BLOCK], bound)
        for first in range(0, len(a), _ANCHORS):
            rows = np.arange(first, min(first + _ANCHORS, len(a)))
            yield rows, ids[at : at + _BLOCK], labels[at : at + _BLOCK], packed.scores(a[rows])


def _joined(parts: list, kinds) -> list:
    return [np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, k) for n, k in enumerate(kinds)]


def _same_label(many: int, scale: float):
    def best(key, anchors, candidates):
        aid, alabel = (anchors.column(n).to_numpy() for n in ("vec_id", "label"))
        # In order of labels a block holds few of them, and only equal ones need products.
        order = np.argsort(candidates.column("label").to_numpy(), kind="stable")
        candidates = candidates.take(pa.array(order))
        parts = []
        clabel = candidates.column("label").to_numpy()
        for label in np.unique(alabel):
            mine = np.flatnonzero(alabel == label)
            low, high = np.searchsorted(clabel, [label, label + 1])
            cells = _cells(anchors.take(pa.array(mine)), candidates.slice(low, high - low), scale)
            for rows, ids, _, scores in cells:
                scores[aid[mine[rows], None] == ids[None, :]] = _NONE
                i, j = _first(scores, ids, many)
                parts.append((aid[mine[rows[i]]], ids[j], scores[i, j]))
        anchor, other, score = _joined(parts, (np.int64,) * 3)
        return pa.table({"anchor_id": anchor, "positive_id": other, "positive_score": score})

    return best


def _share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``percent`` hundredths of a score, rounded up or down, without leaving 64 bits."""
    whole, rest = score // 100, score % 100
    return percent * whole + (-((-percent * rest) // 100) if up else percent * rest // 100)


def _other_labels(many: int, low: int, high: int, scale: float):
    def best(key, anchors, candidates):
        aid, alabel = (anchors.column(n).to_numpy() for n in ("vec_id", "label"))
        listed = anchors.column("positives").combine_chunks()
        count = np.diff(listed.offsets.to_numpy())
        first = np.cumsum(count) - count
        flat = listed.flatten()
        pid, pscore = (flat.field(n).to_numpy() for n in ("positive_id", "positive_score"))
        parts = []
        for rows, ids, labels, scores in _cells(anchors, candidates, scale):
            scores[alabel[rows, None] == labels[None, :]] = _NONE
            for nth in range(int(count[rows].max(initial=0))):
                has = count[rows] > nth
                p = first[rows[has]] + nth
                mine = scores[has]
                inside = (mine >= _share(pscore[p], low, True)[:, None]) & (
                    mine <= _share(pscore[p], high, False)[:, None])
                i, j = _first(np.where(inside, mine, _NONE), ids, many)
                parts.append((aid[rows[has][i]], pid[p[i]], pscore[p[i]], ids[j], mine[i, j]))
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table(dict(zip(names, _joined(parts, (np.int64,) * 5))))

    return best


def usable(df: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
           scale: int = 256) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that take part, one for each id."""
    df = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
                   F.col(vector).alias("vector")).dropna()
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    df = df.where(finite)
    sizes = df.groupBy(F.size("vector").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    n = common["n"] if common else 0
    most = float(isqrt(((1 << 63) - 1) // max(n, 1)))
    scaled = lambda x: x.cast("double") * scale
    fits = F.forall("vector", lambda x: (scaled(x) >= -most) & (scaled(x) < most))
    one = F.min(F.struct("label", "vector")).alias("one")
    return df.where((F.size("vector") == n) & fits).groupBy("vec_id").agg(one).select("vec_id", "one.*")


def _series(n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))


def _dealt(column: str, n: int):
    return F.pmod(F.xxhash64(column), F.lit(int(n))).cast("int")


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """For each anchor its ``positives`` best rows of its label, and for each of these the
    ``negatives`` best rows of other labels that score ``low`` to ``high`` percent of it.

    Both inputs are as ``usable`` gives them; anchors are found among ``rows`` by their id only.
    """
    rows, anchors = written(rows, "rows"), written(anchors, "anchors")
    size = rows.select(F.max(F.size("vector"))).first()[0] or 0
    a_cell = max(_ANCHORS, _CELL_BYTES // (8 * max(size, 1)))
    chunks = max(_CHUNKS, -(-rows.count() // a_cell))
    groups = max(1, -(-anchors.count() // a_cell))
    chunk, group = _dealt("vec_id", chunks).alias("chunk"), _dealt("vec_id", groups).alias("group")
    keys = ("group", "chunk")
    candidates = rows.select("*", chunk).withColumn("group", _series(groups))

    def over_grid(df, fn, schema):
        asking = df.select("*", group).withColumn("chunk", _series(chunks))
        return asking.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(fn, schema)

    def ranked(df, by, score, vec_id, many):
        order = Window.partitionBy(*by).orderBy(F.desc(score), vec_id)
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many)

    found = over_grid(anchors, _same_label(positives, scale),
                      "anchor_id bigint, positive_id bigint, positive_score bigint")
    best = ranked(found, ["anchor_id"], "positive_score", "positive_id", positives)
    # At most ``positives`` entries an anchor.
    listed = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asking = written(anchors.join(listed, "vec_id"), "positives")
    found = over_grid(asking, _other_labels(negatives, low, high, scale),
                      "anchor_id bigint, positive_id bigint, positive_score bigint, "
                      "negative_id bigint, negative_score bigint")
    return ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
