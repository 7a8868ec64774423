"""Approximate nearest neighbours by stable projections (operator 10).

Method: vectors are projected to ``DIMS`` dimensions by a Gaussian (2-stable)
matrix and indexed by a kd-tree. For a query the leaves are opened in order
of their projected distance and their vectors verified on the original
components; the ratio of squared projected to squared true distance follows
a chi-square distribution of ``DIMS`` degrees of freedom, so the search stops
once a vector as near as the k-th best would have shown up already with
probability ``CONFIDENCE``.

Scale: equal vectors are one point that carries its ids. Points are dealt by
hash into shards of about ``SHARD`` rows, one tree each; queries meet every
shard in blocks of at most ``BLOCK``, and each shard passes on its k best for
each query. No group holds more than a shard and a block.

Cases: vectors that are null, empty, zero, of another length than the most
common one, or that hold a null or non-finite component take no part, as
query or candidate; fewer candidates than k give all; ties go to the smaller
id; rows of one id but different vectors are different candidates, equal ones
are one; a null id takes no part.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import stage

DIMS = 8            # projected dimensions, even
CONFIDENCE = 0.97   # of the stopping test
LEAF = 256          # points of a kd-tree leaf
SHARD = 8_192       # points of one tree
BLOCK = 2_048       # queries that meet a shard at a time
SEED = 20_111


def chi_square_cdf(x: float, dims: int = DIMS) -> float:
    """Of an even number of degrees of freedom, in closed form."""
    half, term, total = x / 2, 1.0, 1.0
    if half > 700:
        return 1.0
    for i in range(1, dims // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def stop_ratio(confidence: float = CONFIDENCE, dims: int = DIMS) -> float:
    """The ratio at which the stopping test holds."""
    low, high = 0.0, 1e3
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < confidence else (low, mid)
    return high


class KdTree:
    """Over projected points: boxes of a balanced tree, leaves of few points."""

    def __init__(self, points: np.ndarray):
        self.low, self.high, self.below, self.rows = [], [], [], []
        self.points = points
        self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        own, node = self.points[rows], len(self.low)
        self.low.append(own.min(axis=0))
        self.high.append(own.max(axis=0))
        self.below.append(None)
        self.rows.append(rows)
        if len(rows) > LEAF:
            axis = int((self.high[node] - self.low[node]).argmax())
            order = np.argsort(own[:, axis], kind="stable")
            half = len(rows) // 2
            self.below[node] = (self._build(rows[order[:half]]), self._build(rows[order[half:]]))
            self.rows[node] = None
        return node

    def leaves(self, query: np.ndarray):
        """(squared projected distance of the box, rows), nearest first."""
        heap = [(0.0, 0)]
        while heap:
            d, node = heapq.heappop(heap)
            if self.below[node] is None:
                yield d, self.rows[node]
                continue
            for c in self.below[node]:
                gap = np.maximum(np.maximum(self.low[c] - query, query - self.high[c]), 0)
                heapq.heappush(heap, (float(gap @ gap), c))


def search(points: np.ndarray, queries: np.ndarray, k: int, confidence: float = CONFIDENCE) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, squared distances) of the verified points that may be among the
    k nearest of each query; ties with the k-th are all kept."""
    project = np.random.default_rng(SEED).standard_normal((points.shape[1], DIMS))
    tree, ratio, out = KdTree(points @ project), stop_ratio(confidence), []
    for query, shadow in zip(queries, queries @ project):
        rows, dist, kth = [], [], math.inf
        best = np.zeros(0)
        for box, own in tree.leaves(shadow):
            if box > ratio * kth:
                break
            d = points[own] - query
            d = np.einsum("ij,ij->i", d, d)
            near = d <= kth
            if near.any():
                rows.append(own[near])
                dist.append(d[near])
                best = np.partition(np.concatenate([best, d[near]]), min(k, len(best) + near.sum()) - 1)[:k]
                if len(best) == k:
                    kth = best.max()
        rows, dist = np.concatenate(rows), np.concatenate(dist)
        out.append((rows[dist <= kth], dist[dist <= kth]))
    return out


def _usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0)


def nearest(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, ``vec_id``, score (Euclidean distance): the k nearest
    found of each row of ``queries``, the query's own id left out."""

    def clean(d: DataFrame) -> DataFrame:
        vec = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # -0.0 becomes 0.0
        return d.select(F.col(id_col).cast("long").alias("id"), vec.alias("v")).where(F.col("id").isNotNull() & _usable(F.col("v")))

    rows = stage(clean(df).distinct(), "vectors")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == size["n"])
    asked = clean(queries).where(F.size("v") == size["n"]).distinct()
    shards = max(1, -(-rows.count() // SHARD))
    blocks = max(1, -(-asked.count() // BLOCK))
    # Of equal vectors only the k + 1 smallest ids can be among the nearest
    # (one may be the query's own); the window drops the others map-side.
    point = Window.partitionBy("v").orderBy("id")
    points = (rows.withColumn("r", F.row_number().over(point)).where(F.col("r") <= k + 1)
              .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    left = points.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def found(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(p) and len(q):
            vecs, asks, ids = np.stack(p["v"].to_numpy()), np.stack(q["v"].to_numpy()), p["ids"].tolist()
            # one more than k: the query itself may be among them
            for own, (at, d) in zip(q["id"].tolist(), search(vecs, asks, k + 1, confidence)):
                best = sorted((math.sqrt(x), i) for j, x in zip(at.tolist(), d.tolist()) for i in ids[j] if i != own)[:k]
                out += [(own, i, s) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    some = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
            .applyInPandas(found, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = some.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order).cast("int"))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
