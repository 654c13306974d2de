"""Random forest on cells: the rows whose columns fall into the same bins, counted by label.

No tree tells the rows of a cell apart, so what a level costs depends on the
number of cells, not of rows.  The bootstrap is that of rows: a row is in a
tree's sample Poisson(1) times, so the n rows of a cell and label are in it
Poisson(n) times, drawn by a seed of the tree and the cells' bytes.

Trees grow level by level, all at once.  Every task adds up the weight and
the sampled rows by (tree, node, column, bin) of its block of cells, for the
columns drawn at each node; partial sums meet by tree, and only the best split
of each node comes back to the driver, which holds the trees (bounded by their
number and depth) and never rows.  A split is the one of largest fall of Gini
impurity; children that would predict the same class as leaves are one leaf, as
in MLlib.  A score is the mean of the trees' class shares.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import boosting as B

NODES = 1 << 12     # nodes of one tree that a job looks at, times columns


@dataclass
class Forest:
    features: list[str]
    edges: list[np.ndarray]
    trees: list[B.Tree]

    def share(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees of the share of class 1 in the row's leaf."""
        out = np.zeros(len(x))
        for t in self.trees:
            out += t.value[t.place(x)]
        return out / max(len(self.trees), 1)


class _Tree:
    """A tree while it grows: per node its children, split and weight by class."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right, self.sums = [-1], [0], [0], [0], [(0.0, 0.0)]
        self.frontier = [0]

    def arrays(self) -> B.Tree:
        return B.Tree(np.array(self.feature, np.int32), np.array(self.cut, np.int32), np.array(self.left, np.int32),
                      np.array(self.right, np.int32), np.array([s[1] / max(s[0] + s[1], 1e-300) for s in self.sums]))

    def split(self, node: int, found: tuple) -> list[int]:
        """The children of a node; none if nothing splits it."""
        total, gain, column, cut, left, right = found
        self.sums[node] = total
        if gain <= 0:
            return []
        kids = [len(self.feature), len(self.feature) + 1]
        self.feature[node], self.cut[node], self.left[node], self.right[node] = column, cut, *kids
        for s in (left, right):
            for name, v in (("feature", -1), ("cut", 0), ("left", 0), ("right", 0), ("sums", s)):
                getattr(self, name).append(v)
        return kids

    def prune(self):
        """Leaves of one parent that predict the same class become one."""
        for k in range(len(self.feature) - 1, -1, -1):          # children come after their parent
            if self.feature[k] >= 0:
                kids = self.left[k], self.right[k]
                if all(self.feature[c] < 0 for c in kids) and len({self.sums[c][1] > self.sums[c][0] for c in kids}) == 1:
                    self.feature[k] = -1


def _drawn_columns(seed: int, tree: int, depth: int, nodes: int, width: int, k: int) -> np.ndarray:
    """``k`` different columns for each node of a level."""
    order = np.random.default_rng([seed, tree, depth]).random((nodes, width)).argsort(axis=1)
    return np.sort(order[:, :k], axis=1)


def _sampled(n: np.ndarray, x: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often the rows of each cell and label are in a tree's sample."""
    return np.random.default_rng([seed, tree, zlib.crc32(x.tobytes())]).poisson(n).astype(float)


def _node_sums(x, rows, at, n_nodes: int, nodes: Sequence[int], columns: np.ndarray, n_bins: int) -> np.ndarray:
    """[class; node; drawn column; bin]: sampled rows of the cells in ``nodes``."""
    local = np.full(n_nodes, -1)
    local[list(nodes)] = np.arange(len(nodes))
    node = local[at]
    some = np.flatnonzero(node >= 0)
    x, node, rows = x[some], node[some], rows[some]
    out = np.zeros((2, *columns.shape, n_bins))
    for c in range(columns.shape[1]):
        cell = node * n_bins + x[np.arange(len(x)), columns[node, c]]
        for y in (0, 1):
            out[y, :, c] = np.bincount(cell, rows[:, y], len(nodes) * n_bins).reshape(len(nodes), n_bins)
    return out


def best_splits(rows: np.ndarray, columns: np.ndarray, weights: tuple[float, float]) -> list[tuple]:
    """Per node its weight by class, the fall of impurity, the column, the last bin to the left and the weight there."""
    sums = rows * np.array(weights)[:, None, None, None]
    left = np.cumsum(sums, axis=3)[..., :-1]
    total = sums[:, :, 0, :].sum(axis=2)
    right = np.flip(np.cumsum(np.flip(sums, 3), axis=3), 3)[..., 1:]

    def impurity(s):        # Gini impurity times weight
        return 2 * s[0] * s[1] / np.maximum(s[0] + s[1], 1e-300)
    gain = impurity(total)[:, None, None] - impurity(left) - impurity(right)
    scale = 1e-12 * (total[0] + total[1])[:, None, None]       # what rounding leaves is no gain
    flat = np.where((left.sum(0) > 0) & (right.sum(0) > 0) & (gain > scale), gain, 0.0).reshape(len(columns), -1)
    out = []
    for k, j in enumerate(flat.argmax(axis=1)):
        c, b = divmod(int(j), left.shape[3])
        out.append((tuple(total[:, k].tolist()), float(flat[k, j]), int(columns[k, c]), b, tuple(left[:, k, c, b].tolist()), tuple(right[:, k, c, b].tolist())))
    return out


def fit(df: DataFrame, features: Sequence[str], label: str, weights: tuple[float, float], trees: int = 100, depth: int = 10,
        bins: int = 32, seed: int = 42, block_cells: int = 1 << 18) -> Forest:
    """``trees`` trees of ``depth`` levels on the rows with a label (0, 1) and, at each
    node, the square root of the number of columns; ``weights`` are those of the classes."""
    sc = df.sparkSession.sparkContext
    features = list(features)
    df = df.filter(F.col(label).isNotNull())
    edges = B.bin_edges(df, features, bins)
    n_bins = max((len(e) for e in edges), default=0) + 2
    width, kinds = len(features), [(-1, 0), (-1, 1)]
    drawn = max(1, math.ceil(math.sqrt(width)))
    table, n_blocks, n_cells = B._blocks(df, features, label, None, label, edges, kinds, False, block_cells, 1)
    grown = [_Tree() for _ in range(trees)]
    if not n_cells:
        return Forest(features, edges, [])
    chunks = max(1, min(trees, -(-sc.defaultParallelism // n_blocks)))
    n_parts = n_blocks * chunks
    state = (table.rdd.zipWithIndex().flatMap(lambda r: [(r[1] * chunks + c, (c, r[0])) for c in range(chunks)])
             .partitionBy(n_parts, lambda k: k).values().persist(StorageLevel.MEMORY_AND_DISK))

    def level(work):
        def run(part):
            for chunk, r in part:
                block = B._Block(r, width, kinds)
                for t in range(chunk, trees, chunks):
                    if t in work.value:
                        tree, nodes, columns = work.value[t]
                        rows = _sampled(block.n, block.x, seed, t)
                        yield t, _node_sums(block.x, rows, tree.place(block.x), len(tree.feature), nodes, columns, n_bins)
        return run
    step = max(1, NODES // drawn)
    for d in range(depth):
        waiting = {t: (g.frontier, _drawn_columns(seed, t, d, len(g.frontier), width, drawn)) for t, g in enumerate(grown) if g.frontier}
        found = {t: [] for t in waiting}
        while waiting:
            shared = sc.broadcast({t: (grown[t].arrays(), nodes[:step], columns[:step]) for t, (nodes, columns) in waiting.items()})
            sums = state.mapPartitions(level(shared))
            if n_blocks > 1:
                sums = sums.reduceByKey(lambda a, b: a + b, n_parts)
            for t, splits in sums.map(lambda kv: (kv[0], best_splits(kv[1], shared.value[kv[0]][2], weights))).collect():
                found[t] += splits
            shared.destroy()
            waiting = {t: (nodes[step:], columns[step:]) for t, (nodes, columns) in waiting.items() if len(nodes) > step}
        for t, splits in found.items():
            g = grown[t]
            kids = [c for k, s in zip(g.frontier, splits) for c in g.split(k, s)]
            g.frontier = [c for c in kids if min(g.sums[c]) > 0]        # a node of one class is a leaf
    state.unpersist()
    for g in grown:
        g.prune()
    return Forest(features, edges, [g.arrays() for g in grown])


def predict(df: DataFrame, forest: Forest, keep: Sequence[str], out: str = "score", most: int = 1 << 18) -> DataFrame:
    """``keep`` and the score of every row; a task scores a cell once, as long as it has few."""
    d = df.select(*keep, *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(forest.features)])
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        f, known = shared.value, {}
        for b in batches:
            if not b.num_rows:
                continue
            x, at = B._numbered(B._bins_of(b, len(keep), f.edges))
            names = [r.tobytes() for r in x]
            new = [i for i, name in enumerate(names) if name not in known]
            if new:
                if len(known) > most:
                    known, new = {}, list(range(len(x)))
                known.update(zip([names[i] for i in new], f.share(x[new]).tolist()))
            score = np.array([known[name] for name in names])[at]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(score)], names=[*keep, out])
    schema = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in keep)
    return d.mapInArrow(run, f"{schema}, `{out}` double")
