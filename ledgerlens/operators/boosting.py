"""Gradient boosting of leaf-wise trees, many models at once, on histograms.

Columns are cut into bins once, at quantiles (a mergeable sketch, one pass);
NULL and NaN are a bin below all others.  Rows with the same bins form a cell:
no tree tells them apart, so a cell has one margin and counts of its rows by
fold and label (with sampled rows, also their hashes).  Cells are written to the
shared folder in blocks of bytes.  A level of all models' trees is one job:
every task adds up gradient, hessian and count by (model, leaf, feature, bin)
over its block, partial sums meet by model, and only the best split of each
leaf comes back to the driver.  So a hundred trials of three folds cost as
many jobs as one model.

* **Best first.**  A tree grows to ``leaves`` leaves, always at the leaf of
  largest gain.  Which splits that makes is known without one job a split: a
  node is split in the order of the least gain on its path, so after every
  level only the ``leaves - 1`` nodes of largest such gain can still be in the
  tree, and only their children are looked at.
* **Regularised leaves.**  With gradient sum G and hessian sum H a leaf's
  value is ``-rate * shrink(G, alpha) / (H + lambda)``; a split's gain is the
  rise of ``shrink(G, alpha)**2 / (H + lambda)``.
* **Margins are kept** with the blocks and moved on by each round's trees;
  every ``keep_every`` rounds they go to the shared folder, so that a lost
  executor costs a few rounds.
* **Patience.**  The loss on the left-out fold is one number per model and
  round.  A model ends when it has not fallen for ``patience`` rounds and keeps
  the trees up to its least loss; nothing is fitted again.  ``start`` goes on
  with models where they stopped.
* **Ledger.**  Every split's gain is kept by model, round and feature, from
  which gain importances are sums.

Gradients, hessians and losses are rounded to multiples of 2**-20 before they
are added, so sums do not depend on the order of tasks: results are the same
for every partitioning.  Rows and columns are sampled by seeded hashes.

Blocks have at most about ``block_rows`` cells.  Cells that fill several are
dealt by block and model, as above.  Where one block holds all cells nothing has
to meet: the models are dealt over the tasks and a job does ``keep_every``
rounds of each, by the same steps and with the same result.  The driver holds
the trees, whose size is bounded by rounds and leaves, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import check_parity
from ledgerlens.session import checkpoint_dir

UNIT = 2.0 ** 20
MOST_MARGINS = 1 << 24     # numbers held by a task


@dataclass(frozen=True)
class Params:
    """One model.  ``fold`` is left out of its training and ends its rounds (None: neither)."""

    fold: int | None = None
    rounds: int = 1000
    patience: int = 100
    leaves: int = 31
    depth: int = 7
    rate: float = 0.02
    row_share: float = 1.0
    row_every: int = 1          # rows are drawn anew after so many rounds
    column_share: float = 1.0
    least_rows: int = 20
    least_hessian: float = 1e-3
    alpha: float = 0.0
    lambda_: float = 0.0
    positive_weight: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Arrays by node: feature (-1 at a leaf), last bin that goes left, children, value."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def place(self, x: np.ndarray) -> np.ndarray:
        node, inner = np.arange(len(self.feature)), self.feature >= 0
        # a leaf leads to itself
        f, cut = np.where(inner, self.feature, 0), np.where(inner, self.cut, 255).astype(np.uint8)
        child = np.stack([np.where(inner, self.left, node), np.where(inner, self.right, node)], 1).ravel()
        depth = [0] * len(node)
        for k in np.flatnonzero(inner).tolist():        # children come after their parent
            depth[self.left[k]] = depth[self.right[k]] = depth[k] + 1
        flat, row = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        at = np.zeros(len(x), np.intp)
        for _ in range(max(depth)):
            at = child.take(2 * at + (flat.take(row + f.take(at)) > cut.take(at)))
        return at


def best_round(losses: Sequence[float]) -> int:
    """Round of least loss among the first and later ones; ``losses`` begin with that of no round."""
    return 1 + int(np.argmin(losses[1:])) if len(losses) > 1 else 0


@dataclass
class Model:
    params: Params
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)       # after 0, 1, ... rounds
    ledger: list[tuple[int, int, int, float, int]] = field(default_factory=list)     # round, node, feature, gain, rows
    ended: bool = False

    @property
    def best(self) -> int:
        """Rounds up to the least loss, the first at least (all without a left-out fold)."""
        return best_round(self.losses) if self.params.fold is not None else len(self.trees)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees[:self.best]:
            out += t.value[t.place(x)]
        return out


@dataclass
class Boosted:
    features: list[str]
    edges: list[np.ndarray]
    models: list[Model]
    fitted_on: DataFrame | None = None      # no rows: the columns' names and types

    def ledger(self) -> list[tuple[int, int | None, int, int, str, float, int]]:
        """(model, fold, round, node, feature, gain, rows) of every split in the kept rounds."""
        return [(k, m.params.fold, r, node, self.features[f], gain, n) for k, m in enumerate(self.models)
                for r, node, f, gain, n in m.ledger if r < m.best]

    def importances(self) -> list[tuple[int, str, float]]:
        """(model, feature, gain) with 0 for features that no split uses."""
        out = {(k, f): 0.0 for k in range(len(self.models)) for f in self.features}
        for k, _, _, _, f, gain, _ in self.ledger():
            out[k, f] += gain
        return [(k, f, g) for (k, f), g in out.items()]


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64, accuracy: int = 10_000) -> list[np.ndarray]:
    """Upper edges of the bins, at most ``bins - 1`` different quantiles a feature;
    exact where there are fewer than half of ``accuracy`` rows."""
    probs = [k / bins for k in range(1, bins)]
    cols = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features]
    row = df.agg(*[F.percentile_approx(c, probs, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    return [np.unique(np.array(row[i] or [], float)) for i in range(len(features))]


def binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers: 0 for a missing value, else 1 + the number of edges below it."""
    out = np.zeros(values.shape, np.uint8)
    for k, e in enumerate(edges):
        v = values[:, k]
        out[:, k] = np.where(np.isnan(v), 0, 1 + np.searchsorted(e, v, side="left"))
    return out


def _bins(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], keep: Sequence[Column]) -> DataFrame:
    """``keep`` and ``x``: the bin numbers of a row, one byte a feature."""
    d = df.select(*keep, *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(features)])
    names, width = d.columns[:len(keep)], len(features)

    def run(batches):
        for b in batches:
            x = _bins_of(b, len(names), edges)
            offsets = pa.py_buffer(np.arange(0, width * len(x) + 1, width, dtype=np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, pa.py_buffer(x.tobytes())])],
                                             names=[*names, "x"])
    schema = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in names)
    return d.mapInArrow(run, f"{schema}, x binary" if names else "x binary")


def _bins_of(batch: pa.RecordBatch, first: int, edges: Sequence[np.ndarray]) -> np.ndarray:
    return binned(np.column_stack([batch.column(first + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(edges))]), edges)


def _bytes_of(t: pa.Table, width: int) -> np.ndarray:
    """The rows of the column ``x``, as an array of bytes."""
    parts = []
    for c in t.column("x").chunks:
        offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1]
        parts.append(np.frombuffer(c.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(c) else np.zeros(0, np.uint8))
    return np.concatenate(parts).reshape(-1, width)


def cell_counts(df: DataFrame, boosted: "Boosted", by: Sequence[str]) -> DataFrame:
    """(x, ``by``, n): rows that no model tells apart, counted."""
    return _bins(df, boosted.features, boosted.edges, [F.col(c) for c in by]).groupBy("x", *by).agg(F.count(F.lit(1)).alias("n"))


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of bytes, in order, and the number of each row among them."""
    flat = np.ascontiguousarray(values).view(f"V{values.shape[1]}").ravel()
    order = np.argsort(flat, kind="stable")
    new = np.r_[True, flat[order][1:] != flat[order][:-1]]
    at = np.empty(len(flat), np.int64)
    at[order] = np.cumsum(new) - 1
    return values[order[new]], at


def _blocks(df: DataFrame, features, label, fold_col, key, edges, kinds: list[tuple], sampled: bool, block_cells: int,
            block_rows: int) -> tuple[DataFrame, int, int]:
    """One row of bytes per block, written: the bins of its cells and the rows of each kind (fold, label) in
    them, for sampled models also the rows' hashes and places. With the numbers of blocks and cells."""
    spark = df.sparkSession
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(-1)
    y = F.col(label).cast("int")
    kind = F.coalesce(*[F.when(y.eqNullSafe(F.lit(v)) & fold.eqNullSafe(F.lit(f)), F.lit(i)) for i, (f, v) in enumerate(kinds)], F.lit(-1))
    hashes = [(key if isinstance(key, Column) else F.xxhash64(F.col(key))).alias("h")] if sampled else []
    path = f"{checkpoint_dir(spark).rstrip('/')}/boosting-{np.random.default_rng().integers(1 << 62):x}"
    d = _bins(df.filter(F.col(label).isNotNull()), features, edges, [kind.alias("kind"), *hashes])
    if sampled:
        d.write.parquet(f"{path}/rows")
        d = spark.read.parquet(f"{path}/rows")
    d.groupBy("x", "kind").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells")
    by_cell = cells.groupBy("x").agg(F.sum("n").alias("n"))
    found = by_cell.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n")).first()
    n_cells, total = found["cells"], found["n"] or 0
    n_blocks = max(1, -(-n_cells // block_cells), -(-total // block_rows) if sampled else 1)
    if sampled:     # a cell of very many rows is dealt out in pieces; there are few such cells
        hot = by_cell.filter(F.col("n") > block_rows).select("x", F.ceil(F.col("n") / block_rows).alias("pieces"))
        d = d.join(F.broadcast(hot), "x", "left").withColumn("piece", F.pmod("h", F.coalesce("pieces", F.lit(1))))
        d = d.select("x", "kind", "h", "piece").repartition(n_blocks, "x", "piece")
    else:
        d = cells.repartition(n_blocks, "x")
    width, n_kinds = len(features), len(kinds)

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if parts:
            t = pa.Table.from_batches(parts)
            x, at = _numbered(_bytes_of(t, width))
            place = at * n_kinds + t.column("kind").to_numpy()
            n = np.bincount(place, None if sampled else t.column("n").to_numpy(), len(x) * n_kinds).astype(np.int64)
            out = {"x": [x.tobytes()], "n": [n.tobytes()], "place": [b""], "h": [b""]}
            if sampled:
                order = np.argsort(place, kind="stable")
                out |= {"place": [place[order].astype(np.int32).tobytes()], "h": [t.column("h").to_numpy()[order].tobytes()]}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.binary()) for c in ("x", "n", "place", "h")]))
    d.mapInArrow(run, "x binary, n binary, place binary, h binary").write.parquet(f"{path}/blocks")
    return spark.read.parquet(f"{path}/blocks"), n_blocks, n_cells


class _Block:
    """Cells of one block: bins, rows by kind, places and hashes of single rows (none: rows are drawn by cell)."""

    def __init__(self, r, width: int, kinds: list[tuple]):
        self.x = np.frombuffer(r["x"], np.uint8).reshape(-1, width)
        self.n = np.frombuffer(r["n"], np.int64).reshape(-1, len(kinds))
        self.place, self.h, self.kinds = np.frombuffer(r["place"], np.int32), np.frombuffer(r["h"], np.int64), kinds

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _by_label(self, n: np.ndarray, use) -> dict[int, np.ndarray]:
        out = {}
        for i, (f, v) in enumerate(self.kinds):
            if use(f):
                v = int(v) & 255
                out[v] = out[v] + n[:, i] if v in out else n[:, i]
        return {v: c.astype(float) for v, c in out.items()}

    def held(self, p: Params) -> dict[int, np.ndarray]:
        """Rows of the left-out fold by label, for each cell."""
        return self._by_label(self.n, lambda f: f == p.fold)

    def train(self, p: Params, model_round: int, drawn: dict) -> dict[int, np.ndarray]:
        """Rows a tree is grown on by label, for each cell; ``drawn`` keeps the draws that a trial's models share."""
        n = self.n
        if p.row_share < 1:
            draw = _draw(p, model_round)
            if drawn.get("of") != (p.seed, p.row_share):
                drawn.clear()
                drawn["of"] = p.seed, p.row_share
            if draw not in drawn:
                drawn[draw] = (self._sampled if len(self.h) else self._sampled_by_cell)(*draw).astype(np.int32 if n.max(initial=0) < 1 << 31 else np.int64)
            n = drawn[draw]
        return self._by_label(n, lambda f: p.fold is None or f != p.fold)

    def _sampled(self, seed: int, share: float, step: int = 1 << 16) -> np.ndarray:
        out = np.zeros(self.n.size, np.int64)
        for i in range(0, len(self.h), step):       # places ascend
            use = self.place[i:i + step][_hash(self.h[i:i + step], seed) < share]
            if len(use):
                out[use[0]:use[-1] + 1] += np.bincount(use - use[0])
        return out.reshape(self.n.shape)

    def _sampled_by_cell(self, seed: int, share: float) -> np.ndarray:
        """How many of a cell's rows of a kind come into a draw that takes each with probability ``share``: binomial,
        from a number that depends on cell, kind and seed alone. A count is drawn by its last 8 bits and, above, by 4."""
        if not hasattr(self, "_digits"):
            h = np.zeros(len(self.x), np.uint64)
            with np.errstate(over="ignore"):
                for c in range(self.x.shape[1]):
                    h = (h ^ (self.x[:, c].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                h = (h[:, None] + np.arange(self.n.shape[1], dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)).ravel()
            n, self._digits, self._tables = self.n.ravel(), [], {}
            for shift, bits in [(0, 8), *[(s, 4) for s in range(8, 63, 4)]]:
                digit = n >> shift & (1 << bits) - 1
                use = np.flatnonzero(digit)
                if len(use):
                    levels, rank = np.unique(digit[use], return_inverse=True)
                    with np.errstate(over="ignore"):
                        self._digits.append((use, (h[use] ^ np.uint64(shift * 0xA24BAED4963EE407 & (1 << 64) - 1)).view(np.int64), levels << shift, rank))
        if share not in self._tables:
            self._tables = {share: [_binomial_table(levels, share) for _, _, levels, _ in self._digits]}
        out = np.zeros(self.n.size, np.int64)
        for (use, h, levels, rank), (cdf, start, least) in zip(self._digits, self._tables[share]):
            k = np.searchsorted(cdf, rank + _hash(h, seed), side="right") - start[rank] + least[rank]
            out[use] += np.minimum(k, levels[rank])
        return out.reshape(self.n.shape)

    def grid(self) -> "_Grid | None":
        """The cells as places of a grid of all bins, if most of it is filled."""
        if not hasattr(self, "_grid"):
            shape = tuple(int(v) + 1 for v in self.x.max(axis=0)) if len(self.x) else ()
            self._grid = _Grid(self.x, shape) if shape and math.prod(shape) <= 4 * len(self.x) + 4096 else None
        return self._grid


def _binomial_table(levels: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distribution functions of the binomials of ``levels`` rows, the i-th raised by i, one after the other; where each
    begins, and its least value. What lies beyond 10 deviations is left out."""
    parts, start, least, at = [], [], [], 0
    for i, n in enumerate(levels.tolist()):
        wide = 10 * math.sqrt(n * share * (1 - share)) + 10
        k = np.arange(max(0, math.floor(n * share - wide)), min(n, math.ceil(n * share + wide)) + 1)
        log = np.r_[0.0, np.cumsum(np.log((n - k[:-1]) / (k[1:])) + math.log(share / (1 - share)))] if share > 0 else np.r_[0.0, np.full(len(k) - 1, -np.inf)]
        cdf = np.cumsum(np.exp(log - log.max()))
        parts.append(i + np.minimum(cdf / cdf[-1], 1.0))
        start.append(at)
        least.append(int(k[0]))
        at += len(k)
    return np.concatenate(parts), np.array(start), np.array(least)


class _Grid:
    """Sums over boxes of bins: a table of sums below each corner answers any box with a few lookups. Sums are of
    integers, so they are those of a pass over the cells."""

    def __init__(self, x: np.ndarray, shape: tuple[int, ...]):
        self.shape, self.corners = shape, tuple(d + 1 for d in shape)
        self.place = np.ravel_multi_index(x.T.astype(np.intp), shape)
        self.corner = np.ravel_multi_index(x.T.astype(np.intp) + 1, self.corners)
        self.strides = [math.prod(self.corners[c + 1:]) for c in range(len(shape))]

    def table(self, *values: np.ndarray) -> np.ndarray:
        out = np.zeros((len(values), math.prod(self.corners)))
        for row, v in zip(out, values):
            row[self.corner] = v
        for c in range(len(self.shape)):
            np.cumsum(out.reshape(len(values), *self.corners), axis=c + 1, out=out.reshape(len(values), *self.corners))
        return np.ascontiguousarray(out.T)

    def histogram(self, table: np.ndarray, lo: np.ndarray, hi: np.ndarray, columns: Sequence[int], n_bins: int) -> np.ndarray:
        """``_histogram`` of boxes (box, feature), from the table."""
        out = np.empty((table.shape[1], len(lo), len(columns), n_bins))
        edges = np.arange(n_bins + 1)
        for j, c in enumerate(columns):
            along = np.clip(edges, lo[:, c, None], hi[:, c, None]) * self.strides[c]
            below = np.zeros((len(lo), n_bins + 1, table.shape[1]))
            others = [d for d in range(len(self.shape)) if d != c]
            for pick in range(1 << len(others)):
                ends = [(hi if pick >> i & 1 else lo)[:, d] * self.strides[d] for i, d in enumerate(others)]
                part = table.take(along + sum(ends, np.zeros(len(lo), np.intp))[:, None], axis=0)
                below += part if (len(others) - pick.bit_count()) % 2 == 0 else -part
            out[:, :, j, :] = np.diff(below, axis=1).transpose(2, 0, 1)
        return out


def _draw(p: Params, model_round: int) -> tuple[int, float]:
    return p.seed * 1_000_003 + model_round // p.row_every, p.row_share


def _hash(h: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from hashes and a seed."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64(seed % (1 << 63)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(float) / 2.0 ** 53


def _columns(p: Params, model_round: int, n: int) -> list[int]:
    k = max(1, math.ceil(p.column_share * n - 1e-9))
    return sorted(np.random.default_rng([p.seed, model_round]).choice(n, k, replace=False).tolist()) if k < n else list(range(n))


def _gradients(p: Params, margin: np.ndarray, rows: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of gradients and hessians and number of rows, by cell."""
    s = 1 / (1 + np.exp(-margin))
    g, h, n = (np.zeros(len(margin)) for _ in range(3))
    for y, c in rows.items():
        w = p.positive_weight if y == 1 else 1.0
        g += np.rint(w * (s - y) * UNIT) * c
        h += np.rint(w * s * (1 - s) * UNIT) * c
        n += c
    return g, h, n


def _loss(p: Params, margin: np.ndarray, rows: dict[int, np.ndarray]) -> float:
    some = np.flatnonzero(sum(rows.values())) if rows else []
    margin = margin[some]
    return sum((float((np.rint((p.positive_weight if y == 1 else 1.0) * np.logaddexp(0.0, -margin if y == 1 else margin) * UNIT) * c[some]).sum())
                for y, c in rows.items()), 0.0)


def _histogram(x, g, h, n, at: np.ndarray, frontier: Sequence[int], n_nodes: int, columns: Sequence[int], n_bins: int) -> np.ndarray:
    """[gradient, hessian, count; leaf; column; bin] of the rows in the frontier's leaves."""
    local = np.full(n_nodes, -1)
    local[list(frontier)] = np.arange(len(frontier))
    leaf = local[at]
    rows = np.flatnonzero(leaf >= 0)
    base, g, h, n = leaf[rows] * n_bins, g[rows], h[rows], n[rows]
    size = len(frontier) * n_bins
    out = np.zeros((3, len(frontier), len(columns), n_bins))
    for k, c in enumerate(columns):
        cell = base + x[rows, c]
        for j, w in enumerate((g, h, n)):
            out[j, :, k, :] = np.bincount(cell, w, size).reshape(len(frontier), n_bins)
    return out


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def best_splits(p: Params, hist: np.ndarray) -> list[tuple]:
    """Per leaf (G, H, rows, gain, column index, last left bin, G left, H left,
    rows left); gain 0 where nothing splits it.  Ties take the first column and bin."""
    g, h = hist[0] / UNIT, hist[1] / UNIT
    left = np.cumsum(np.stack([g, h, hist[2]]), axis=3)[..., :-1]
    total = np.stack([g, h, hist[2]])[:, :, 0, :].sum(axis=2)          # every column holds the same rows
    right = total[:, :, None, None] - left

    def value(s):
        return _shrunk(s[0], p.alpha) ** 2 / np.maximum(s[1] + p.lambda_, 1e-12)
    gain = value(left) + value(right) - value(total)[:, None, None]
    ok = ((left[2] >= p.least_rows) & (right[2] >= p.least_rows) & (left[1] >= p.least_hessian) & (right[1] >= p.least_hessian))
    gain = np.where(ok, gain, 0.0)
    flat = gain.reshape(len(gain), -1)
    out = []
    for k, j in enumerate(flat.argmax(axis=1)):
        c, b = divmod(int(j), gain.shape[2])
        top = float(flat[k, j])
        out.append((*total[:, k].tolist(), top if top > 1e-9 else 0.0, c, b, *left[:, k, c, b].tolist()))
    return out


class _Growing:
    """A tree while its levels are looked at: nodes as far as they may still be in it."""

    def __init__(self, params: Params, columns: list[int]):
        self.params, self.columns = params, columns
        self.nodes: list[dict] = [{"least": math.inf, "depth": 0, "sums": None, "gain": 0.0, "kids": None}]
        self.frontier = [0]

    def split(self, found: list[tuple]):
        p = self.params
        for k, s in zip(self.frontier, found):
            n = self.nodes[k]
            n["sums"], n["gain"], n["column"], n["cut"] = s[:3], s[3], s[4], s[5]
            n["least"] = min(n["least"], s[3])
            n["left_sums"] = s[6:]
        chosen = set(self.chosen())
        nxt = []
        for k in self.frontier:
            n = self.nodes[k]
            if k in chosen:
                n["kids"] = (len(self.nodes), len(self.nodes) + 1)
                parts = (n["left_sums"], tuple(a - b for a, b in zip(n["sums"], n["left_sums"])))
                for kid, sums in zip(n["kids"], parts):
                    self.nodes.append({"least": n["least"], "depth": n["depth"] + 1, "sums": sums, "gain": 0.0, "kids": None})
                    if n["depth"] + 1 < p.depth and sums[2] >= 2 * p.least_rows:
                        nxt.append(kid)
        self.frontier = nxt

    def chosen(self) -> list[int]:
        """The nodes split by the best-first order among those looked at."""
        able = [k for k, n in enumerate(self.nodes) if n["gain"] > 0]
        return sorted(able, key=lambda k: (-self.nodes[k]["least"], k))[:self.params.leaves - 1]

    def tree(self, final: bool = False) -> Tree:
        """As far as it is known; ``final``: only the chosen splits, with leaf values."""
        keep = set(self.chosen()) if final else {k for k, n in enumerate(self.nodes) if n["kids"]}
        n = len(self.nodes)
        t = Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n))
        p = self.params
        for k, node in enumerate(self.nodes):
            if k in keep:
                t.feature[k], t.cut[k] = self.columns[node["column"]], node["cut"]
                t.left[k], t.right[k] = node["kids"]
            elif final and node["sums"] is not None:
                g, h, _ = node["sums"]
                t.value[k] = -p.rate * float(_shrunk(np.array(g), p.alpha)) / max(h + p.lambda_, 1e-12)
        return t

    def ledger(self, model_round: int) -> list[tuple]:
        return [(model_round, k, self.columns[self.nodes[k]["column"]], self.nodes[k]["gain"], int(self.nodes[k]["sums"][2]))
                for k in sorted(self.chosen())]


def _grown(p: Params, model_round: int, block: _Block, rows: dict, margin, n_bins: int) -> tuple["_Growing", Tree, np.ndarray]:
    """One tree from one block that holds all rows, and what it adds to the cells' margins."""
    g, h, n = _gradients(p, margin, rows)
    out = _Growing(p, _columns(p, model_round, block.x.shape[1]))
    grid = block.grid()
    if grid is None:
        some = np.flatnonzero(n)
        xs, g, h, n = block.x[some], g[some], h[some], n[some]
        while out.frontier:
            t = out.tree()
            out.split(best_splits(p, _histogram(xs, g, h, n, t.place(xs), out.frontier, len(t.feature), out.columns, n_bins)))
        t = out.tree(final=True)
        return out, t, t.value[t.place(block.x)]
    table = grid.table(g, h, n)
    boxes = [([0] * len(grid.shape), list(grid.shape))]
    while out.frontier:
        looked = out.frontier
        lo, hi = (np.array([boxes[k][e] for k in looked], np.intp) for e in (0, 1))
        out.split(best_splits(p, grid.histogram(table, lo, hi, out.columns, n_bins)))
        for k in looked:        # kids are numbered in this order
            node = out.nodes[k]
            if node["kids"]:
                f, cut, (lo, hi) = out.columns[node["column"]], node["cut"] + 1, boxes[k]
                cut = min(max(cut, lo[f]), hi[f])
                boxes += [(lo, [*hi[:f], cut, *hi[f + 1:]]), ([*lo[:f], cut, *lo[f + 1:]], hi)]
    t = out.tree(final=True)
    value, todo = np.zeros(grid.shape), [0]
    while todo:
        k = todo.pop()
        if t.feature[k] >= 0:
            todo += [t.left[k], t.right[k]]
        else:
            value[tuple(slice(a, b) for a, b in zip(*boxes[k]))] = t.value[k]
    return out, t, value.ravel().take(grid.place)


def _rounds(p: Params, n_trees: int, losses: list[float], held: float, most: int, block: _Block, margin: np.ndarray, n_bins: int, drawn: dict):
    """Up to ``most`` rounds of a model on a block that holds all rows; moves
    ``margin`` on.  (trees, losses, ledger) that are new, and whether patience ended it."""
    trees, lost, ledger, known = [], list(losses), [], None
    out_rows = block.held(p)
    while True:
        if p.fold is not None and len(lost) <= n_trees:
            lost.append(_loss(p, margin, out_rows) / UNIT / max(held, 1e-9))
            if n_trees - best_round(lost) >= p.patience:
                return trees, lost[len(losses):], ledger, True
        if n_trees >= p.rounds or len(trees) == most:
            return trees, lost[len(losses):], ledger, False
        if known is None or p.row_share < 1 and n_trees % p.row_every == 0:
            known = block.train(p, n_trees, drawn)
        g, t, added = _grown(p, n_trees, block, known, margin, n_bins)
        margin += added
        trees.append(t)
        ledger += g.ledger(n_trees)
        n_trees += 1


def fit(df: DataFrame, features: Sequence[str], label: str, key: str | Column, models: Sequence[Params], fold_col: str | None = None,
        bins: int = 64, accuracy: int = 10_000, block_rows: int = 1 << 18, keep_every: int = 25, start: Boosted | None = None,
        block_hashes: int = 1 << 22, most_hashes: int = 1 << 22) -> Boosted:
    """Fit all ``models`` on ``df``; with ``start`` (fitted on the same rows)
    its models go on instead, up to ``models[k].rounds``.  A block has about ``block_rows``
    cells at most and, if a model samples rows, the hashes of about ``block_hashes`` rows. Beyond ``most_hashes`` rows a
    sample is drawn by cell, as the number of its rows that come into it, not row by row: the same distribution, at a
    cost that does not grow with the rows. ``key`` is a column's name, or the column of a row's hash."""
    spark = df.sparkSession
    sc = spark.sparkContext
    features = list(features)
    shape = spark.createDataFrame([], df.select(*features).schema)
    if start is None:
        edges = bin_edges(df, features, bins, accuracy)
        out = Boosted(features, edges, [Model(p) for p in models], shape)
    else:
        check_parity(start.fitted_on, df, features)
        edges = start.edges
        out = Boosted(features, edges, [replace(m, params=p, trees=list(m.trees), losses=list(m.losses), ledger=list(m.ledger), ended=False)
                                        for m, p in zip(start.models, models)], shape)
    n_bins = max((len(e) for e in edges), default=0) + 2
    counts = (df.filter(F.col(label).isNotNull()).groupBy((F.col(fold_col).cast("int") if fold_col else F.lit(-1)).alias("f"), F.col(label).cast("int").alias("y"))
              .agg(F.count("*").alias("n")).collect())             # folds x classes rows
    if start is None:
        for m in out.models:
            pos, neg = (sum(r["n"] for r in counts if r["y"] == c and (m.params.fold is None or r["f"] != m.params.fold)) for c in (1, 0))
            m.base = math.log(max(m.params.positive_weight * pos, 1e-9) / max(neg, 1e-9))
    held = {m.params.fold: sum(r["n"] * (m.params.positive_weight if r["y"] == 1 else 1) for r in counts if r["f"] == m.params.fold)
            for m in out.models}
    kinds = sorted(((r["f"], r["y"]) for r in counts), key=str)
    width = len(features)
    table, n_blocks, n_cells = _blocks(df, features, label, fold_col, key, edges, kinds,
                                       any(m.params.row_share < 1 for m in out.models) and sum(r["n"] for r in counts) <= most_hashes,
                                       max(1, block_rows // max(1, len(kinds) // 16)), block_hashes)
    # margins of a task have MOST_MARGINS numbers at most
    n_chunks = max(-(-sc.defaultParallelism // n_blocks), -(-len(out.models) * -(-n_cells // n_blocks) // MOST_MARGINS))
    n_chunks = max(1, min(len(out.models), n_chunks))
    n_parts = n_blocks * n_chunks
    # models that draw the same rows go to one task, if there are enough such groups
    by_draw = {}
    for k, m in enumerate(out.models):
        by_draw.setdefault((m.params.seed, m.params.row_share), []).append(k)
    dealt = list(by_draw.values()) if len(by_draw) >= 2 * n_chunks else [[k] for k in range(len(out.models))]
    mine = [[k for group in dealt[c::n_chunks] for k in group] for c in range(n_chunks)]
    begin = sc.broadcast([(m.base, m.trees) for m in out.models])
    params = [m.params for m in out.models]

    def first(part):
        """Blocks of a chunk's models with the margins they begin with and the rows drawn last."""
        for chunk, r in part:
            block = _Block(r, width, kinds)
            margin = np.empty((len(mine[chunk]), len(block.x)))
            for j, k in enumerate(mine[chunk]):
                base, trees = begin.value[k]
                margin[j] = base
                for t in trees:
                    margin[j] += t.value[t.place(block.x)]
            yield chunk, block, margin, {}

    state = (table.rdd.zipWithIndex().flatMap(lambda r: [(r[1] * n_chunks + c, (c, r[0])) for c in range(n_chunks)])
             .partitionBy(n_parts, lambda k: k).values().mapPartitions(first).persist(StorageLevel.MEMORY_AND_DISK))

    def moved(trees, rounds):
        def run(part):
            for chunk, block, margin, rows in part:
                last = {}
                for j, k in enumerate(mine[chunk]):
                    t = trees.value.get(k)
                    if t is not None:
                        margin[j] += t.value[t.place(block.x)]
                    # rows are drawn once for all levels of the rounds that share them
                    if params[k].row_share < 1 and k in rounds and rows.get(k, (None,))[0] != _draw(params[k], rounds[k]):
                        rows[k] = _draw(params[k], rounds[k]), {v: c.astype(np.int32) for v, c in block.train(params[k], rounds[k], last).items()}
                    elif k not in rounds:
                        rows.pop(k, None)
                yield chunk, block, margin, rows
        return run

    def level(work, with_loss):
        def run(part):
            for chunk, block, margin, rows in part:
                last = {}
                for j, k in enumerate(mine[chunk]):
                    if k not in work.value:
                        continue
                    p, model_round, tree, frontier, columns = work.value[k]
                    if with_loss and p.fold is not None:
                        yield (k, "loss"), _loss(p, margin[j], block.held(p))
                    known = rows[k][1] if k in rows and rows[k][0] == _draw(p, model_round) else block.train(p, model_round, last)
                    g, h, n = _gradients(p, margin[j], known)
                    some = np.flatnonzero(n)
                    xs = block.x[some]
                    yield (k, "hist"), _histogram(xs, g[some], h[some], n[some], tree.place(xs), frontier, len(tree.feature), columns, n_bins)
        return run

    def reduced(rdd, work):
        if n_blocks > 1:
            rdd = rdd.reduceByKey(lambda a, b: a + b, n_parts)
        return rdd.map(lambda kv: (kv[0], best_splits(work.value[kv[0][0]][0], kv[1]) if kv[0][1] == "hist" else kv[1])).collect()

    if n_blocks == 1:
        _fit_dealt(sc, out, state, mine, held, n_bins, keep_every)
        return out
    live = [k for k, m in enumerate(out.models) if len(m.trees) < m.params.rounds]
    since = 0
    while live:
        growing = {k: _Growing(out.models[k].params, _columns(out.models[k].params, len(out.models[k].trees), width)) for k in live}
        first_level = True
        while growing:
            todo = {k: g for k, g in growing.items() if g.frontier}
            if not todo:
                break
            work = sc.broadcast({k: (g.params, len(out.models[k].trees), g.tree(), g.frontier, g.columns) for k, g in todo.items()})
            for (k, what), found in reduced(state.mapPartitions(level(work, first_level)), work):
                if what == "hist":
                    todo[k].split(found)
                elif len(out.models[k].losses) <= len(out.models[k].trees):
                    out.models[k].losses.append(found / UNIT / max(held[out.models[k].params.fold], 1e-9))
            work.destroy()
            if first_level:         # the loss after the rounds so far is known now
                for k in live:
                    m = out.models[k]
                    if m.params.fold is not None and len(m.trees) - m.best >= m.params.patience:
                        m.ended = True
                        del growing[k]
                first_level = False
        done = {}
        for k, g in growing.items():
            m = out.models[k]
            done[k] = g.tree(final=True)
            m.ledger += g.ledger(len(m.trees))
            m.trees.append(done[k])
        live = [k for k in growing if len(out.models[k].trees) < out.models[k].params.rounds]
        if not live and not any(out.models[k].params.fold is not None for k in growing):
            break
        shared = sc.broadcast(done)
        nxt = state.mapPartitions(moved(shared, {k: len(out.models[k].trees) for k in live})).persist(StorageLevel.MEMORY_AND_DISK)
        since += 1
        if since % keep_every == 0:
            nxt.checkpoint()
        nxt.count()
        state.unpersist()
        state = nxt
        last = [k for k in growing if k not in live and out.models[k].params.fold is not None]
        if last:                    # models out of rounds: the loss of their last one
            work = sc.broadcast({k: (out.models[k].params, 0, out.models[k].trees[-1], [], []) for k in last})

            def losses(part):
                for chunk, block, margin, _ in part:
                    for j, k in enumerate(mine[chunk]):
                        if k in work.value:
                            yield k, _loss(work.value[k][0], margin[j], block.held(work.value[k][0]))
            for k, v in state.mapPartitions(losses).reduceByKey(lambda a, b: a + b).collect():
                out.models[k].losses.append(v / UNIT / max(held[out.models[k].params.fold], 1e-9))
    state.unpersist()
    return out


def _fit_dealt(sc, out: Boosted, state, mine, held, n_bins: int, most: int):
    """All rounds where one block holds all rows, ``most`` of them a job."""
    live = [k for k, m in enumerate(out.models) if len(m.trees) < m.params.rounds]
    while live:
        work = sc.broadcast({k: (out.models[k].params, len(out.models[k].trees), out.models[k].losses, held[out.models[k].params.fold]) for k in live})

        def run(part, work=work):
            for chunk, block, margin, *_ in part:
                found, drawn = [], {}
                for j, k in enumerate(mine[chunk]):
                    if k in work.value:
                        p, n_trees, losses, total = work.value[k]
                        found.append((k, _rounds(p, n_trees, losses, total, most, block, margin[j], n_bins, drawn)))
                yield chunk, block, margin, found
        nxt = state.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)
        nxt.checkpoint()
        live = []
        for k, (trees, losses, ledger, ended) in nxt.flatMap(lambda e: e[-1]).collect():
            m = out.models[k]
            m.trees += trees
            m.losses += losses
            m.ledger += ledger
            m.ended = ended
            if not ended and (len(m.trees) < m.params.rounds or m.params.fold is not None and len(m.losses) <= len(m.trees)):
                live.append(k)
        state.unpersist()
        state = nxt
    state.unpersist()


def predict(df: DataFrame, boosted: Boosted, keep: Sequence[str], which: Sequence[int] | None = None) -> DataFrame:
    """``keep`` and an array ``scores``: the probabilities of the models of
    ``which`` (all).  A frame whose features have other names or types than the
    fitted one's is refused."""
    check_parity(boosted.fitted_on, df, boosted.features)
    d = df.select(*keep, *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(boosted.features)])
    return _scored(d, boosted, keep, which, lambda b, edges: _bins_of(b, len(keep), edges))


def predict_cells(cells: DataFrame, boosted: Boosted, keep: Sequence[str], which: Sequence[int] | None = None) -> DataFrame:
    """``predict`` for rows that hold their bins in ``x`` (``cell_counts``)."""
    width = len(boosted.features)
    return _scored(cells.select(*keep, "x"), boosted, keep, which, lambda b, _: _bytes_of(pa.Table.from_batches([b]), width))


def _scored(d: DataFrame, boosted: Boosted, keep: Sequence[str], which: Sequence[int] | None, bins_of) -> DataFrame:
    """Each task scores a cell once, as long as its scores stay small."""
    which = list(range(len(boosted.models)) if which is None else which)
    shared = d.sparkSession.sparkContext.broadcast((boosted.edges, [boosted.models[k] for k in which]))

    def run(batches):
        edges, models = shared.value
        place, known = {}, np.zeros((0, len(models)))
        for b in batches:
            if not b.num_rows:
                continue
            x, at = _numbered(bins_of(b, edges))
            names = [r.tobytes() for r in x]
            new = [i for i, name in enumerate(names) if name not in place]
            if new:
                if len(known) * max(len(models), 1) > MOST_MARGINS // 8:
                    place, known, new = {}, known[:0], list(range(len(x)))
                place.update((names[i], len(known) + j) for j, i in enumerate(new))
                known = np.concatenate([known, np.column_stack([1 / (1 + np.exp(-m.margin(x[new]))) for m in models])])
            s = known[np.array([place[name] for name in names])[at]]
            offsets = pa.array(np.arange(0, s.size + 1, s.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.ListArray.from_arrays(offsets, pa.array(s.ravel()))],
                                             names=[*keep, "scores"])
    schema = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in keep)
    return d.mapInArrow(run, f"{schema}, scores array<double>")


def out_of_fold(df: DataFrame, boosted: Boosted, fold_col: str, keep: Sequence[str]) -> DataFrame:
    """Every row scored by the model that left its fold out (one model per fold)."""
    place = {m.params.fold: k for k, m in enumerate(boosted.models)}
    at = F.element_at(F.create_map(*[F.lit(x) for kv in place.items() for x in kv]), F.col(fold_col).cast("int"))
    cols = [*keep, *([fold_col] if fold_col not in keep else [])]
    return predict(df, boosted, cols).select(*cols, F.get("scores", at).alias("score"))


def ledger_frame(spark, boosted: Boosted) -> DataFrame:
    """The splits as a table (their number is bounded by models, rounds and leaves)."""
    kind = "model int, fold int, round int, node int, feature string, gain double, rows long"
    return spark.createDataFrame(pd.DataFrame(boosted.ledger(), columns=[c.split()[0] for c in kind.split(", ")]), kind) \
        if boosted.ledger() else spark.createDataFrame([], kind)
