"""Nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample: each node projects on the difference of two sample
points and splits at the sample's median. Every vector is routed down every tree. A query puts the leaves of all
trees into one queue, the most promising first: a leaf's priority is the smallest margin by which
its path agrees with the query. It visits a fixed share of all leaves in that order, and the
candidates found there are ranked by their exact distance in double precision.

Leaves are dealt in blocks: by tree, leaf, a salt of the candidates and one of the queries, so that
neither a full leaf nor a flood of queries meets in one task. Of equal vectors in a batch only
the smallest ids are sent on, as many as could ever be among the nearest; the rest can't change a result.

Defined results: vectors that are null, of another length than most, zero, or that hold null or
non-finite components take no part, nor do rows without an id. Rows that share an id count as
one candidate at the smallest distance. A query has no row if there is no other vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.llm.scratch_tables import written

#: Sample size, trees, largest depth, smallest leaf in the sample, share of leaves visited.
SAMPLE, TREES, DEPTH, LEAF, SHARE = 8192, 4, 8, 8, 0.35
_BLOCK = 4096


@dataclass
class Forest:
    """For each tree and inner node (heap order): direction and threshold."""

    directions: np.ndarray
    thresholds: np.ndarray
    depth: int

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(vectors), len(self.directions)), np.int32)
        for t, (w, b) in enumerate(zip(self.directions, self.thresholds)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, w[node]) > b[node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2**self.depth - 1)
        return out

    def visits(self, vectors: np.ndarray, share: float) -> np.ndarray:
        """The leaves (numbered through all trees) that each query takes from the shared queue."""
        inner, trees = 2**self.depth - 1, len(self.directions)
        queue = np.empty((len(vectors), trees, inner + 1))
        for t, (w, b) in enumerate(zip(self.directions, self.thresholds)):
            margin = vectors @ w.T - b
            priority = np.full((len(vectors), 2 * inner + 1), np.inf)
            for node in range(inner):
                priority[:, 2 * node + 1] = np.minimum(priority[:, node], -margin[:, node])
                priority[:, 2 * node + 2] = np.minimum(priority[:, node], margin[:, node])
            queue[:, t] = priority[:, inner:]
        queue = queue.reshape(len(vectors), -1)
        taken = max(trees, int(np.ceil(share * queue.shape[1])))
        return np.argsort(-queue, axis=1, kind="stable")[:, :taken].astype(np.int32)


def fit(sample: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> Forest:
    n, size = sample.shape if len(sample) else (0, 1)
    while depth and n < LEAF << depth:
        depth -= 1
    rng = np.random.Generator(np.random.PCG64(seed))
    directions = np.zeros((trees, max(1, 2**depth - 1), size))
    thresholds = np.zeros(directions.shape[:2])
    for t in range(trees):
        node = np.zeros(n, np.int64)
        for k in range(2**depth - 1):
            mine = np.flatnonzero(node == k)
            if not len(mine):
                continue
            a, b = sample[rng.choice(mine, 2)]
            w = a - b if (a != b).any() else rng.standard_normal(size)
            directions[t, k] = w / np.linalg.norm(w)
            value = sample[mine] @ directions[t, k]
            thresholds[t, k] = np.median(value)
            node[mine] = 2 * k + 1 + (value > thresholds[t, k])
    return Forest(directions, thresholds, depth)


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _smallest_of_equals(ids: np.ndarray, vectors: np.ndarray, many: int) -> np.ndarray:
    """Rows that are among the ``many`` smallest ids of their vector."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    ordered = vectors[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    rank = np.arange(len(order)) - first[np.cumsum(new) - 1]
    return np.sort(order[rank < many])


def _routing(forest: Forest, nearest: int):
    def route(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            vectors = _matrix(batch.column(1))
            if not len(ids):
                continue
            rows = _smallest_of_equals(ids, vectors, nearest + 1)
            leaf = forest.leaves(vectors[rows])
            wide = leaf + (np.arange(leaf.shape[1], dtype=np.int32) << forest.depth)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                 pa.array(list(wide), pa.list_(pa.int32()))], names=["vec_id", "vector", "leaves"])

    return route


def _queueing(forest: Forest, share: float):
    def queue(batches):
        for batch in batches:
            vectors = _matrix(batch.column(1))
            if not len(vectors):
                continue
            for a in range(0, len(vectors), 256):
                part = batch.slice(a, 256)
                taken = forest.visits(vectors[a : a + 256], share)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(taken), pa.list_(pa.int32()))],
                    names=["query_id", "query", "leaves"])

    return queue


def _ranking(nearest: int):
    def rank(key, queries, candidates):
        out = [[], [], []]
        if queries.num_rows and candidates.num_rows:
            qid, cid = (t.column(c).to_numpy() for t, c in ((queries, "query_id"), (candidates, "vec_id")))
            q = _matrix(queries.column("query").combine_chunks())
            c = _matrix(candidates.column("vector").combine_chunks())
            squares = (c * c).sum(axis=1)
            for a in range(0, len(q), 256):
                near = (q[a : a + 256] ** 2).sum(axis=1)[:, None] + squares - 2 * q[a : a + 256] @ c.T
                near[qid[a : a + 256, None] == cid[None, :]] = np.inf
                if len(c) > nearest:
                    bound = np.partition(near, nearest - 1, axis=1)[:, nearest - 1 : nearest]
                else:
                    bound = np.full((len(near), 1), np.finfo(float).max)
                i, j = np.nonzero((near <= bound + 1e-9 * (1 + np.abs(bound))) & np.isfinite(near))
                exact = np.sqrt(((q[a + i] - c[j]) ** 2).sum(axis=1))
                order = np.lexsort((cid[j], exact, i))
                i, j, exact = i[order], j[order], exact[order]
                first = np.searchsorted(i, np.arange(len(near)))
                keep = np.arange(len(i)) - first[i] < nearest
                out[0].append(qid[a + i[keep]])
                out[1].append(cid[j[keep]])
                out[2].append(exact[keep])
        ids, found, score = (np.concatenate(x) if x else np.zeros(0) for x in out)
        return pa.table({"query_id": pa.array(ids.astype(np.int64)),
                         "vec_id": pa.array(found.astype(np.int64)),
                         "score": pa.array(score.astype(np.float64))})

    return rank


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part."""
    df = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    df = df.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite
                  & F.exists("vector", lambda x: x != 0))
    common = df.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return df.where(F.size("vector") == (common["n"] if common else 0))


def nearest(df: DataFrame, queries: DataFrame, k: int = 10, share: float = SHARE,
            sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``df`` found for each query.

    Both inputs have ``vec_id`` and ``vector``, as ``usable`` gives them.
    """
    drawn = df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    forest = fit(_matrix(drawn.column("vector").combine_chunks()) if drawn.num_rows else np.zeros((0, 1)))
    kind = df.schema["vector"].dataType.simpleString()
    routed = written(df.mapInArrow(
        _routing(forest, k), f"vec_id bigint, vector {kind}, leaves array<int>"), "routed")
    leaves = 1 << forest.depth
    salts = routed.count() // (_BLOCK * leaves) + 1
    asked = written(queries.mapInArrow(
        _queueing(forest, share), f"query_id bigint, query {kind}, leaves array<int>"), "queue")
    groups = asked.count() * share // _BLOCK + 1

    def series(n):
        return F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))

    candidates = routed.select(
        "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int").alias("salt"),
        F.explode("leaves").alias("leaf")).withColumn("part", series(groups))
    asking = asked.select(
        "query_id", "query", F.pmod(F.xxhash64("query_id"), F.lit(int(groups))).cast("int").alias("part"),
        F.explode("leaves").alias("leaf")).withColumn("salt", series(salts))
    keys = ("leaf", "salt", "part")
    found = asking.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        _ranking(k), "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
