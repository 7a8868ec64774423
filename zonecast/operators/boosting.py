"""Gradient-boosted trees by histograms (M3, M9).

Squared loss, second-order gain. The features are cut into bins once and the
rows kept as packed blocks of bins. Every level of a tree is one job: each
partition adds up gradients and rows by (node, feature, bin), the arrays of a
feature are shuffled to one task, which sums them and reads off the feature's
best split of every node, and the driver picks among these; what it gets is
bounded by nodes x features, whatever the number of rows, partitions and bins.
Rows and features are drawn per tree. Gradients are summed as integers
of a fixed scale, so the trees do not depend on the order of the partitions or
on a task that runs twice. The running predictions are written to the shared
folder every ``STAGE_TREES`` trees, which also cuts the lineage.

Equal gains go to the feature that comes first and to its lowest bin. A node
is split if its gain is over ``MIN_GAIN`` and both sides have a row.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import materialize

MIN_GAIN = 1e-6
REG_LAMBDA = 1.0     # of the leaf weights
EQUAL = 1e-9         # gains that differ by less, relative to the larger, are equal
STAGE_TREES = 10
FLAT_PARTITIONS = 16   # up to as many tasks add up the features of a level,
MERGED_PARTITIONS = 4  # one for so many partitions


# ---- trees -----------------------------------------------------------------

@dataclass(frozen=True)
class Tree:
    """Heap order: the children of node i are 2i + 1 (not above the
    threshold) and 2i + 2. ``feature`` is -1 at leaves."""

    feature: np.ndarray
    cut: np.ndarray        # last bin that goes left
    threshold: np.ndarray  # its largest value
    value: np.ndarray
    gain: np.ndarray

    def leaves(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``x``, compared with ``at`` (bins or values)."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(int(math.log2(len(self.feature) + 1)) - 1):
            f = self.feature[node]
            on = f >= 0
            node = np.where(on, 2 * node + 1 + (x[rows, np.maximum(f, 0)] > at[node]), node)
        return node


@dataclass(frozen=True)
class BoostedTrees:
    features: tuple[str, ...]
    base: float
    trees: tuple[Tree, ...]

    def transform(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        """Batch scoring (M11), Arrow batches; missing features count as 0."""
        base, trees = self.base, self.trees

        @F.pandas_udf("double")
        def predict(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for cols in parts:
                x = np.column_stack([c.to_numpy() for c in cols])
                total = np.full(len(x), base)
                for t in trees:
                    total += t.value[t.leaves(x, t.threshold)]
                yield pd.Series(total)

        zero = F.lit(0.0)
        # an iterator of one column would come without its tuple
        cols = [*self.features, self.features[0]] if len(self.features) == 1 else self.features
        return df.withColumn(out, predict(*[F.coalesce(F.nanvl(F.col(f).cast("double"), zero), zero) for f in cols]))

    def importance(self) -> dict[str, float]:
        """Mean gain of the splits on each feature, as shares of 1 (M9)."""
        gain, n = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in self.trees:
            on = t.feature >= 0
            np.add.at(gain, t.feature[on], t.gain[on])
            np.add.at(n, t.feature[on], 1)
        mean = np.divide(gain, n, out=np.zeros_like(gain), where=n > 0)
        return dict(zip(self.features, (mean / mean.sum() if mean.sum() else mean).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of parquet for each node (K3)."""
        rows = [(list(self.features), self.base, k, i, int(t.feature[i]), int(t.cut[i]), float(t.threshold[i]), float(t.value[i]), float(t.gain[i]))
                for k, t in enumerate(self.trees) for i in range(len(t.feature))]
        schema = "features array<string>, base double, tree int, node int, feature int, cut int, threshold double, value double, gain double"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        rows = spark.read.parquet(path).orderBy("tree", "node").toPandas()  # a bounded table of nodes
        trees = tuple(Tree(*[g[c].to_numpy() for c in ("feature", "cut", "threshold", "value", "gain")]) for _, g in rows.groupby("tree"))
        return BoostedTrees(tuple(rows["features"].iloc[0]), float(rows["base"].iloc[0]), trees)


# ---- bins ------------------------------------------------------------------

def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """The largest value of each bin but the last, feature by feature: all
    values where there are (about) at most ``bins`` of them, else quantiles (relative
    rank error 1 / (20 bins))."""
    counts = df.agg(*[F.approx_count_distinct(f).alias(f"c{i}") for i, f in enumerate(features)]).first()
    probs = [k / bins for k in range(1, bins)]
    few = [counts[i] <= bins for i in range(len(features))]
    got = df.agg(*[(F.sort_array(F.collect_set(f)) if f_ else F.percentile_approx(f, probs, 20 * bins)).alias(f"e{i}")
                   for i, (f, f_) in enumerate(zip(features, few))]).first()
    # a set holds its largest value, which needs no edge
    return [np.unique(np.array(got[i] or [0.0], float))[:-1 if few[i] else None] for i in range(len(features))]


_BLOCK = "n int, x binary, y binary, h binary, margin binary"


def _blocks(df: DataFrame, features: Sequence[str], target: str, edges: list[np.ndarray], base: float) -> DataFrame:
    """Rows of ``df`` packed: bins, targets, a hash to draw by, predictions."""
    kind = np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16 if max(map(len, edges)) < 65536 else np.uint32
    k = len(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            x = np.column_stack([np.searchsorted(e, c).astype(kind) for e, c in zip(edges, cols[:k])])
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int32()), **{name: pa.array([v.tobytes()], pa.binary()) for name, v in (
                ("x", x), ("y", cols[k].astype(float)), ("h", cols[k + 1].astype(np.int64)), ("margin", np.full(len(x), base)))}})

    row = F.xxhash64(*[F.col(c) for c in df.columns if c != "features"])
    return df.select(*features, F.col(target), row.alias("__h")).mapInArrow(pack, _BLOCK)


def _arrays(block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    size = len(block["x"]) // max(1, block["n"] * k)
    x = np.frombuffer(bytes(block["x"]), f"u{size}" if size else "u1").reshape(block["n"], k)
    return x, *(np.frombuffer(bytes(block[c]), kind) for c, kind in (("y", float), ("h", np.int64), ("margin", float)))


def _drawn(h: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Which rows a tree is grown on: a 64-bit mix of the row's hash."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (tree + 1 + 1000003 * seed)) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z < np.uint64(min(2**64 - 1, int(share * 2**64)))


def _add_trees(x: np.ndarray, margin: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    out = margin.copy()
    for t in trees:
        out += t.value[t.leaves(x, t.cut)]
    return out


# ---- growing ---------------------------------------------------------------

def histograms(blocks: RDD, k: int, tree: Tree, active: Sequence[int], columns: Sequence[int], edges: list[np.ndarray], scale: float,
               pending: Sequence[Tree], number: int, seed: int, share: float) -> RDD:
    """Of each column (its place in ``columns``) the sums by (node, bin) of
    gradients (as integers) and rows; they stay with the tasks."""
    slot = np.full(len(tree.feature), -1)
    slot[list(active)] = range(len(active))
    bins = [len(edges[f]) + 1 for f in columns]

    def partial(part: Iterator) -> Iterator[tuple[int, np.ndarray]]:
        total = [np.zeros((len(active), b, 2), np.int64) for b in bins]
        for block in part:
            x, y, h, margin = _arrays(block, k)
            keep = np.flatnonzero(_drawn(h, number, seed, share)) if share < 1 else np.arange(len(x))
            x, y, margin = x[keep], y[keep], margin[keep]
            at = slot[tree.leaves(x, tree.cut)]
            on = np.flatnonzero(at >= 0)
            x, at = x[on], at[on]
            g = np.rint((_add_trees(x, margin[on], pending) - y[on]) * scale)
            for f, b, sums in zip(columns, bins, total):
                key = at * b + x[:, f]
                sums[:, :, 0] += np.bincount(key, g, len(active) * b).astype(np.int64).reshape(-1, b)
                sums[:, :, 1] += np.bincount(key, minlength=len(active) * b).reshape(-1, b)
        yield from enumerate(total)

    tasks = min(len(columns), FLAT_PARTITIONS, 1 + blocks.getNumPartitions() // MERGED_PARTITIONS)
    return blocks.mapPartitions(partial).reduceByKey(np.add, tasks)


def column_splits(sums: np.ndarray, scale: float, reg: float = REG_LAMBDA) -> np.ndarray:
    """The best splits of one column, rows of (node, gain, last left bin, G
    and H of the left side, of the node): per node the best one after those of
    lower bins that are equal to it. A node without a split that has rows on
    both sides has one row of gain -inf."""
    out = []
    for at, node in enumerate(sums):
        left = np.cumsum(node, axis=0).astype(float)
        left[:, 0] /= scale
        whole = left[-1]
        right = whole - left
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = left[:, 0] ** 2 / (left[:, 1] + reg) + right[:, 0] ** 2 / (right[:, 1] + reg) - whole[0] ** 2 / (whole[1] + reg)
        gain = np.where((left[:, 1] >= 1) & (right[:, 1] >= 1), gain, -np.inf)
        # one of a lower gain than another before it is first under no bound
        before = np.maximum.accumulate(np.append(-np.inf, gain[:-1]))
        found = np.flatnonzero((gain >= gain.max() - EQUAL * abs(gain.max())) & (gain > before))
        out += [(at, gain[b], b, *left[b], *whole) for b in (found if len(found) else [len(gain) - 1])]
    return np.array(out)


def best_splits(found: Sequence[tuple[int, np.ndarray]], nodes: int) -> list[tuple[float, int, int, tuple[float, float], tuple[float, float]]]:
    """Of each node (gain, column, last left bin, (G, H) of the left side, of
    the node), from the rows of all columns; the gain is -inf where no split
    has rows on both sides."""
    rows = np.concatenate([np.column_stack([np.full(len(r), c), r]) for c, r in sorted(found, key=lambda cr: cr[0])])
    out = []
    for node in range(nodes):
        own = rows[rows[:, 1] == node]
        # equal up to rounding: the first
        c, _, gain, b, *sides = own[int(np.argmax(own[:, 2] >= own[:, 2].max() - EQUAL * abs(own[:, 2].max())))].tolist()
        out.append((gain, int(c), int(b), tuple(sides[:2]), tuple(sides[2:])))
    return out


def grow(blocks: RDD, k: int, edges: list[np.ndarray], depth: int, rate: float, columns: Sequence[int], scale: float,
         pending: Sequence[Tree], number: int, seed: int, share: float) -> Tree:
    """One tree, level by level."""
    size = 2 ** (depth + 1) - 1
    tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size), np.zeros(size))
    active = [0]
    for level in range(depth):
        sums = histograms(blocks, k, tree, active, columns, edges, scale, pending, number, seed, share)
        found = sums.mapValues(lambda s: column_splits(s, scale)).collect()  # a row or so for each node and column
        nodes, active = active, []
        for node, (gain, c, b, left, whole) in zip(nodes, best_splits(found, len(nodes))):
            if gain <= MIN_GAIN:
                if level == 0:  # a tree of one leaf
                    tree.value[0] = -rate * whole[0] / (whole[1] + REG_LAMBDA)
                continue
            f = columns[c]
            tree.feature[node], tree.cut[node], tree.threshold[node], tree.gain[node] = f, b, edges[f][b], gain
            right = (whole[0] - left[0], whole[1] - left[1])
            for child, (g, h) in ((2 * node + 1, left), (2 * node + 2, right)):
                tree.value[child] = -rate * g / (h + REG_LAMBDA)
                active.append(child)
        if not active:
            break
    return tree


def fit(df: DataFrame, features: Sequence[str], target: str, trees: int = 100, depth: int = 6, rate: float = 0.1,
        rows: float = 0.8, cols: float = 0.8, seed: int = 42, bins: int = 256) -> BoostedTrees:
    """Boosted trees on ``df``, whose features are numbers without gaps. An
    empty table gives a model that predicts 0."""
    stats = df.agg(F.avg(F.col(target).cast("double")).alias("mean"), F.count(target).alias("n"),
                   F.max(F.abs(F.col(target).cast("double"))).alias("most")).first()
    if not stats["n"]:
        return BoostedTrees(tuple(features), 0.0, ())
    base, k, grown = float(stats["mean"]), len(features), []
    # sums of n gradients of up to 4 * most stay below 2^62
    scale = 2.0 ** min(30, 60 - math.ceil(math.log2(stats["n"] * 4 * max(1.0, stats["most"]))))
    edges = bin_edges(df, features, bins)
    table = materialize(_blocks(df, features, target, edges, base), "blocks")
    pending: list[Tree] = []
    blocks = table.rdd.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for number in range(trees):
            if len(pending) == STAGE_TREES:
                table = materialize(_advanced(table, k, pending), "blocks")
                blocks.unpersist()
                blocks, pending = table.rdd.persist(StorageLevel.MEMORY_AND_DISK), []
            drawn = sorted(random.Random(1_000_003 * seed + number).sample(range(k), max(1, int(cols * k))))
            grown.append(grow(blocks, k, edges, depth, rate, drawn, scale, pending, number, seed, rows))
            pending.append(grown[-1])
    finally:
        blocks.unpersist()
    return BoostedTrees(tuple(features), base, tuple(grown))


def _advanced(table: DataFrame, k: int, trees: Sequence[Tree]) -> DataFrame:
    """The blocks with the predictions of some more trees added."""
    trees = list(trees)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.to_pylist():
                x, _, _, margin = _arrays(block, k)
                block["margin"] = _add_trees(x, margin, trees).tobytes()
                yield pa.RecordBatch.from_pylist([block], b.schema)

    return table.mapInArrow(add, _BLOCK)
