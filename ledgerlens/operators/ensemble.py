"""Blending: simplex weight grid, blended scores, AUC per weight vector.

The grid (all w_i = k_i/steps with Σk_i = steps) is a fixed, bounded list
(231 points for 3 models and step 0.05). Score tuples meet as packed arrays by
(tile of near points, range of blends), where numpy blends and sorts them for
each point; only the counts of each range go on.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import safe_div
from ledgerlens.session import written


def grid_points(n_models: int = 3, steps: int = 20) -> list[tuple[int, ...]]:
    """Integer compositions of ``steps`` into ``n_models`` parts (avoids float drift)."""
    if n_models == 1:
        return [(steps,)]
    return [(i,) + rest for i in range(steps, -1, -1) for rest in grid_points(n_models - 1, steps - i)]


def weight_grid_column(names: Sequence[str], steps: int = 20) -> Column:
    pts = grid_points(len(names), steps)
    return F.array(*[F.struct(*[(F.lit(k) / F.lit(float(steps))).alias(n) for k, n in zip(p, names)]) for p in pts])


def blend(df: DataFrame, scores: Sequence[str], weights: Sequence[float], out: str = "blend") -> DataFrame:
    expr = None
    for s, w in zip(scores, weights):
        term = F.lit(float(w)) * F.col(s)
        expr = term if expr is None else expr + term
    return df.withColumn(out, expr)


#: score tuples of a cell, cells, and tuples of a block, about
CELL_ROWS, MOST_CELLS, BLOCK_ROWS = 3 << 20, 1 << 14, 1 << 16
BATCH_BYTES = 4 << 20       # of packed arrays handed over at once
BLEND_BYTES = 12 << 30      # of blends (10 bytes each) counted in one pass over the blocks, one weight vector at least
TRAVEL_BYTES = 1 << 31      # on disk at once on their way to the cells, as long as one tile's are fewer
HELD_BYTES = 1 << 28        # of score tuples in a task
PROBES = 64                 # tuples of a block that the limits of cells are laid by
_PART = "part int, tile int, cell int, label int, rows int, scores binary, n binary"
_CELL = "point int, cell int, pairs double, n_pos long, n_neg long"


def _blend(w, s: Sequence[np.ndarray]) -> np.ndarray:
    b = w[0] * s[0]
    for wk, sk in zip(w[1:], s[1:]):
        b += wk * sk
    return b


def _narrow(n: np.ndarray | None) -> bytes:
    return b"" if n is None else n.astype(np.min_scalar_type(int(n.max()))).tobytes()


def _counts(n, rows: int) -> np.ndarray | None:
    n = n.as_buffer()
    return np.frombuffer(n, f"u{len(n) // rows}").astype(np.int64) if len(n) else None


def _coded(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A column as its different values and a byte a row, if they are so few; else no values and the column."""
    none = np.zeros(0)
    if len(np.unique(v[:2048])) > 256:
        return none, v
    u = np.unique(v)
    return (u, np.searchsorted(u, v).astype(np.uint8)) if len(u) <= 256 and not np.isnan(u[-1]) else (none, v)


def _bytes(columns: Sequence[tuple[np.ndarray, np.ndarray]]) -> bytes:
    return b"".join([np.array([len(u) for u, _ in columns], np.int64).tobytes(), *[a.tobytes() for c in columns for a in c]])


def _columns(scores, width: int, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """What ``_bytes`` wrote."""
    data, at, out = scores.as_buffer(), 8 * width, []
    for k in np.frombuffer(data, np.int64, width).tolist():
        u = np.frombuffer(data, np.float64, k, at)
        v = np.frombuffer(data, np.uint8 if k else np.float64, rows, at + 8 * k)
        at += 8 * k + v.nbytes
        out.append((u, v))
    return out


def _values(columns: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Arrays (score, row)."""
    return np.stack([u.take(v) if len(u) else v for u, v in columns])


def _pack(width: int):
    """Score tuples with class counts -> blocks of the tuples of one class."""
    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                held.append([c.to_numpy(zero_copy_only=False) for c in part.columns])
                rows += part.num_rows
                if rows >= BLOCK_ROWS:
                    yield from packed(held)
                    held, rows = [], 0
        if rows:
            yield from packed(held)

    def packed(held):
        *s, pos, neg = (np.concatenate(c) for c in zip(*held))
        s, out = np.stack(s), []
        for label, n in ((1, pos), (0, neg)):
            use = np.flatnonzero(n)
            if not len(use):
                continue
            mine, n = s[:, use], n[use]
            total = int(n.sum())
            if 2 * total <= 3 * len(n):     # counts that are mostly one cost more than rows
                mine, n = np.repeat(mine, n, axis=1), None
            out.append((label, mine.shape[1], total, _bytes([_coded(v) for v in mine]), _narrow(n), mine[:, ::-(-mine.shape[1] // PROBES)].T.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, (pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3))],
                                         names=["label", "rows", "total", "scores", "n", "probe"])
    return run


def _halves(points: np.ndarray, numbers: Sequence[int]) -> tuple[list[int], list[int]]:
    """The numbers of points near each other, in two parts of them that lie apart."""
    p = points[list(numbers)]
    order = np.argsort(p[:, int(np.argmax(p.max(axis=0) - p.min(axis=0)))], kind="stable")
    cut = -(-len(order) // 2)
    return [numbers[k] for k in order[:cut]], [numbers[k] for k in order[cut:]]


def _groups(points: np.ndarray, numbers: Sequence[int], most: int) -> list[list[int]]:
    return [list(numbers)] if len(numbers) <= most else [g for h in _halves(points, numbers) for g in _groups(points, h, most)]


def _cell_numbers(b: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """Number of splits that each blend is not less than."""
    if len(splits) > 64:
        return np.searchsorted(splits, b, side="right").astype(np.uint16)
    out = np.zeros(len(b), np.uint8)
    for q in splits:
        out += ~(b < q)
    return out


def _lay(weights: np.ndarray, probes: np.ndarray, n: int, row: float, tasks: int) -> tuple[list[list[int]], np.ndarray]:
    """Tiles of weight vectors whose cells are counted together, as many as TRAVEL_BYTES take, and each vector's
    splits. A tile's tuples, ``row`` bytes each, go to every cell that one of its vectors has them in; a vector that
    is a tile of its own sends blends, those of a block collapsed. Splits and tiles steer sizes only."""
    width, n_cells = probes.shape[0], min(n // CELL_ROWS + 1, MOST_CELLS)
    blends = np.stack([_blend(w, probes) for w in weights])
    ordered = np.sort(blends, axis=1)
    splits = ordered[:, np.arange(1, n_cells) * blends.shape[1] // n_cells]
    few = (ordered[:, 1:] != ordered[:, :-1]).sum(axis=1) < 0.5 * blends.shape[1]
    at = np.stack([_cell_numbers(b, q) for b, q in zip(blends, splits)])
    hot = np.array([np.bincount(a).max() > 2 * blends.shape[1] / n_cells + 1 for a in at])
    alone = [k for k in range(len(weights)) if few[k] or hot[k]]
    rest = [k for k in range(len(weights)) if not (few[k] or hot[k])]

    def cost(t):
        """Nanoseconds a tuple, roughly, for what travels, is blended again and sorted; of the largest tile; bytes; the tile."""
        if len(t) == 1:
            return 210.0, 210.0, [8 * n], [t]
        lo, hi = at[t].min(axis=0).astype(int), at[t].max(axis=0).astype(int)
        cells = np.cumsum(np.bincount(lo, minlength=n_cells + 1) - np.bincount(hi + 1, minlength=n_cells + 1)) / len(lo)
        size = int(row * n * cells.sum())
        if size > TRAVEL_BYTES or 8 * width * n * cells.max() > HELD_BYTES:
            return float("inf"), float("inf"), [size], [t]
        took = cells.sum() * (row * 18 + 4 * len(t)) + 57 * len(t)
        return took, took, [size], [t]

    def best(t, most):
        whole = cost(t) if len(t) <= most else (float("inf"), float("inf"), [], [])
        if len(t) < 2:
            return whole
        a, b = (best(h, most) for h in _halves(weights, t))
        return min(whole, (a[0] + b[0], max(a[1], b[1]), a[2] + b[2], a[3] + b[3]), key=lambda f: f[0])
    found = [best(rest, 1 << i) for i in range(len(rest).bit_length() + 1)] if rest else [(0.0, 0.0, [], [])]
    # all tasks together, or the longest
    *_, size, tiles = min(found, key=lambda f: max(f[0] / tasks, f[1] / n_cells))
    tiles, size = [[k] for k in alone] + tiles, [8 * n // (2 if few[k] else 1) for k in alone] + size
    fit = max(1, int(np.searchsorted(np.cumsum(size), TRAVEL_BYTES, side="right")))
    return tiles[:fit], splits


def _collapsed(b: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Blends in order; with counts if they, or enough of them, come more than once."""
    if n is None:
        b.sort()
    else:
        order = np.argsort(b)
        b, n = b[order], n[order]
    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    if n is None:
        return (b, None) if 3 * len(first) > 2 * len(b) else (b[first], np.diff(np.r_[first, len(b)]))
    return b[first], np.add.reduceat(n, first)


def _cut_blocks(points: np.ndarray, steps: int, tiles: list[list[int]], splits: np.ndarray):
    """A block of one class -> its tuples (a tile of one vector: their blends) by tile and cell."""
    weights, width, n_cells = points / float(steps), points.shape[1], splits.shape[1] + 1

    def parts(columns, n):
        s = _values(columns)
        for j, tile in enumerate(tiles):
            if len(tile) == 1:
                b, c = _collapsed(_blend(weights[tile[0]], s), n)
                edges = [0, *np.searchsorted(b, splits[tile[0]], side="left"), len(b)]
                for cell, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    if hi > lo:
                        yield j, cell, int(hi - lo), b[lo:hi].tobytes(), _narrow(c if c is None else c[lo:hi])
                continue
            if n_cells == 1:
                yield j, 0, s.shape[1], _bytes(columns), _narrow(n)
                continue
            lo = hi = None
            for k in tile:
                at = _cell_numbers(_blend(weights[k], s), splits[k])
                lo, hi = (at, at.copy()) if lo is None else (np.minimum(lo, at, out=lo), np.maximum(hi, at, out=hi))
            for cell in range(int(lo.min()), int(hi.max()) + 1):
                use = np.flatnonzero((lo <= cell) & (hi >= cell))
                if len(use):
                    yield j, cell, len(use), _bytes([(u, v.take(use)) for u, v in columns]), _narrow(n if n is None else n.take(use))

    def run(batches):
        out, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                label, rows = batch.column("label")[i].as_py(), batch.column("rows")[i].as_py()
                for j, cell, *part in parts(_columns(batch.column("scores")[i], width, rows), _counts(batch.column("n")[i], rows)):
                    _, scores, counts = part
                    out.append((j * n_cells + cell, j, cell, label, *part))
                    held += len(scores) + len(counts)
                    if held >= BATCH_BYTES:
                        yield batch_of(out)
                        out, held = [], 0
        if out:
            yield batch_of(out)

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int32()] * 5, *[pa.binary()] * 2))],
                                          names=["part", "tile", "cell", "label", "rows", "scores", "n"])
    return run


def _ranked_pairs(key: np.ndarray, n_pos: int, step: int = 1 << 15) -> float:
    """Pairs of a negative below a positive, ties one half. A number is a blend's bits, then its class: one sort,
    and a positive's place tells the negatives below it."""
    # numbers that are bits of finite positive doubles are sorted as such, which is faster
    (key.view(np.float64) if int(key.max()) < 0x7FF0 << 48 else key).sort()
    pairs, ties = -(n_pos * (n_pos - 1) // 2), []
    for i in range(0, len(key), step):          # what is looked at stays in the cache
        part = key[i:i + step + 1]
        at = np.flatnonzero((part[:step] & np.uint64(1)).astype(bool))
        pairs += int(at.sum()) + i * len(at)
        same = np.flatnonzero((part[1:] ^ part[:-1]) <= 1)
        if len(same):
            ties.append(same + i)
    if not ties:
        return float(pairs)
    same = np.concatenate(ties)
    tied = np.zeros(len(key), bool)
    tied[same] = tied[same + 1] = True
    key = key[tied]
    first = np.flatnonzero(np.r_[True, key[1:] >> np.uint64(1) != key[:-1] >> np.uint64(1)])
    p = np.add.reduceat((key & np.uint64(1)).astype(np.int64), first)
    return pairs - int(np.dot(p, np.diff(np.r_[first, len(key)]) - p)) / 2.0


def _pairs(neg: np.ndarray, pos: np.ndarray) -> float | None:
    """The same from blends of any size and sign; None if they have no order as 63-bit integers."""
    if not len(neg) or not len(pos):
        return 0.0
    b = np.concatenate([neg, pos])
    b += 0.0                    # -0.0 is 0.0
    low, high = b.min(), b.max()
    if not (np.isfinite(low) and np.isfinite(high)):
        return None
    key = b.view(np.int64)
    if low < 0:
        key ^= (key >> 63) & np.int64(2 ** 63 - 1)
        least = int(key.min())
        if int(key.max()) - least >= 1 << 63:
            return None
        key -= np.int64(least)
    key = key.view(np.uint64)
    key <<= np.uint64(1)
    key[len(neg):] |= np.uint64(1)
    return _ranked_pairs(key, len(pos))


def _weighted_pairs(b: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """The same for any blends, with counts."""
    if not len(b):
        return 0.0
    order = np.argsort(b)
    b = b[order]
    first = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) & ~(np.isnan(b[1:]) & np.isnan(b[:-1]))])
    pos, neg = np.add.reduceat(pos[order], first), np.add.reduceat(neg[order], first)
    return float(np.dot(pos.astype(float), np.cumsum(neg) - neg + neg / 2.0))


def _joined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray | None]:
    if len(parts) == 1:
        return parts[0]
    some = any(n is not None for _, n in parts)
    return (np.concatenate([s for s, _ in parts], axis=1),
            np.concatenate([np.ones(s.shape[1], np.int64) if n is None else n for s, n in parts]) if some else None)


def _count_cells(points: np.ndarray, numbers: Sequence[int], steps: int, tiles: list[list[int]], splits: np.ndarray, enough: int = 1 << 13):
    """All parts of a tile's cell -> per weight vector the pairs inside it and its class counts."""
    weights, n_cells = points / float(steps), splits.shape[1] + 1

    def inside(k, cell, s, n):
        """Blends of a vector that lie in the cell, with counts."""
        b = _blend(weights[k], s)
        if n_cells == 1:
            return b, n
        use = ~(b < splits[k, cell - 1]) if cell else np.ones(len(b), bool)
        if cell < n_cells - 1:
            use &= b < splits[k, cell]
        use = np.flatnonzero(use)
        return b.take(use), n if n is None else n.take(use)

    def of_tile(j, k, cell, s, n):
        return (s[0], n) if len(tiles[j]) == 1 else inside(k, cell, s, n)

    def plain(j, k, cell, parts, key):
        """The usual case, blends from 0 to 1.5 without counts, piece by piece into ``key``; else None."""
        at, sizes = 0, []
        for label in (0, 1):
            for s, _ in parts[label]:
                b, _ = of_tile(j, k, cell, s, None)
                if not len(b):
                    continue
                if not (b.min() >= 0 and b.max() < 1.5):
                    return None
                bits = np.add(b, 0.0, out=key[at:at + len(b)]).view(np.int64)       # -0.0 is 0.0
                bits <<= 1
                if label:
                    bits |= 1
                at += len(b)
            sizes.append(at - sum(sizes))
        n_neg, n_pos = sizes
        return (_ranked_pairs(key[:at].view(np.uint64), n_pos) if n_neg and n_pos else 0.0), n_pos, n_neg

    def any_kind(j, k, cell, parts):
        found = []
        for label in (0, 1):
            mine = [of_tile(j, k, cell, s, n) for s, n in parts[label]]
            found.append(_joined([(b[None], n) for b, n in mine]) if mine else (np.zeros((1, 0)), None))
        (neg, n_neg), (pos, n_pos) = [(b[0], n) for b, n in found]
        pairs = _pairs(neg, pos) if n_neg is None and n_pos is None else None
        n_neg, n_pos = (np.ones(len(b), np.int64) if n is None else n for b, n in ((neg, n_neg), (pos, n_pos)))
        if pairs is None:
            pairs = _weighted_pairs(np.concatenate([neg, pos]), np.r_[np.zeros(len(neg), np.int64), n_pos], np.r_[n_neg, np.zeros(len(pos), np.int64)])
        return pairs, int(n_pos.sum()), int(n_neg.sum())

    def counted(j, cell, parts):
        key = np.empty(sum(s.shape[1] for p in parts for s, _ in p)) if all(n is None for p in parts for _, n in p) else None
        for k in tiles[j]:
            yield numbers[k], cell, *((plain(j, k, cell, parts, key) if key is not None else None) or any_kind(j, k, cell, parts))

    def run(batches):
        held, small = {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                j, cell, label, rows = (batch.column(c)[i].as_py() for c in ("tile", "cell", "label", "rows"))
                scores = batch.column("scores")[i]
                part = (np.frombuffer(scores.as_buffer(), np.float64)[None] if len(tiles[j]) == 1 else _values(_columns(scores, points.shape[1], rows)),
                        _counts(batch.column("n")[i], rows))
                few = small.setdefault((j, cell, label), [])
                few.append(part)
                if sum(s.shape[1] for s, _ in few) >= enough:
                    s, n = _joined(few)         # pieces that stay in the cache
                    held.setdefault((j, cell), ([], []))[label].extend(
                        (s[:, at:at + enough], n if n is None else n[at:at + enough]) for at in range(0, s.shape[1], enough))
                    few.clear()
        for (j, cell, label), few in small.items():
            if few:
                held.setdefault((j, cell), ([], []))[label].append(_joined(few))
        small.clear()
        for j, cell in list(held):
            out = [r for r in counted(j, cell, held.pop((j, cell)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()))],
                                             names=["point", "cell", "pairs", "n_pos", "n_neg"])
    return run


def blend_grid_auc(df: DataFrame, label: str, scores: Sequence[str], weight_names: Sequence[str],
                   steps: int = 20) -> DataFrame:
    """(weights..., auc) for every grid point, exact; one row each while there are rows with a label and scores.

    Rows collapse to distinct score tuples with class counts where enough of them are alike to pay for it, and the
    tuples to blocks of one class, written once.
    A weight vector's blends are cut into cells, ranges of about ``CELL_ROWS`` of them; pairs inside a cell are
    counted where its blends meet, pairs across cells from the cells' totals, so any splits give the same counts.
    What meets is not blends: near vectors form a tile, and a tile's tuples go once to each cell that one of its
    vectors has them in, where every vector blends them again and keeps what is its own. (A vector whose blends
    collapse, or beyond some 1e9 tuples every one, is a tile of its own and sends blends.) Passes over the blocks
    take as many vectors as ``BLEND_BYTES`` and ``TRAVEL_BYTES`` allow, one tile at least, and the files of a pass
    leave the disk before the next, so disk grows with the tuples, not with tuples times weight vectors. Of a pass
    only one row per weight vector comes back. Scores are finite; rows with a NULL label or score are left out; an
    AUC without positives or negatives is NULL."""
    spark = df.sparkSession
    y = F.col(label).cast("long")
    d = df.select(y.alias("_y"), *[F.col(s).cast("double").alias(f"_s{i}") for i, s in enumerate(scores)])
    s = [f"_s{i}" for i in range(len(scores))]
    with _files_leave(spark):
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # positives and negatives are counted once per tuple or row; everything below reads the written blocks
        tuples = d.dropna().select(*s, F.col("_y").alias("_pos"), (F.lit(1) - F.col("_y")).alias("_neg"))
        seen = tuples.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*s)).alias("tuples")).first()
        if 3 * seen["tuples"] < 2 * seen["rows"]:
            tuples = tuples.groupBy(*s).agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        # blocks are small beside what they become, so adaptive execution must not put them into few tasks
        blocks = written(tuples.mapInArrow(_pack(len(s)), "label int, rows long, total long, scores binary, n binary, probe binary")
                          .repartition(tasks), "blend-blocks")
        size = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.sum("rows").alias("rows"), F.sum(F.length("scores")).alias("bytes"), F.sum(F.when(F.col("label") == 1, F.col("total"))).alias("p"),
                          F.sum(F.when(F.col("label") == 0, F.col("total"))).alias("n")).first()
        n, classes = size["rows"] or 0, (size["p"] or 0, size["n"] or 0)
        # of very many blocks only some tell where cells may end
        probes = blocks.filter(F.pmod(F.xxhash64("probe"), F.lit(size["blocks"] // (1 << 14) + 1)) == 0).select("probe").collect()
        probes = np.concatenate([np.frombuffer(r["probe"], np.float64).reshape(-1, len(s)) for r in probes]).T if probes else np.zeros((len(s), 0))
        points = grid_points(len(scores), steps)
        # 10 bytes a blend: its value and counts of one byte
        groups = _groups(np.array(points), range(len(points)), max(1, BLEND_BYTES // (10 * n))) if n else []
        found = []
        with _files_leave(spark, {"spark.sql.files.openCostInBytes": str(1 << 30), "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}):
            while groups:
                mine = groups.pop(0)
                tiles, splits = _lay(np.array([points[k] for k in mine]) / float(steps), probes, n, size["bytes"] / n, 2 * spark.sparkContext.defaultParallelism)
                use = [k for t in tiles for k in t]
                place = {k: i for i, k in enumerate(use)}
                numbers, splits, tiles = [mine[k] for k in use], splits[use], [[place[k] for k in t] for t in tiles]
                at = np.array([points[k] for k in numbers])
                cells = (blocks.mapInArrow(_cut_blocks(at, steps, tiles, splits), _PART)
                               .repartitionById(len(tiles) * (splits.shape[1] + 1), F.col("part"))
                               .mapInArrow(_count_cells(at, numbers, steps, tiles, splits), _CELL))
                # at most MOST_CELLS rows a weight vector
                w = Window.partitionBy("point").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
                below = F.coalesce(F.sum("n_neg").over(w), F.lit(0))
                rows = (cells.withColumn("pairs", F.col("pairs") + F.col("n_pos").cast("double") * below)
                             .groupBy("point").agg(F.sum("pairs").alias("pairs"), F.sum("n_pos").alias("p"),
                                                   F.sum("n_neg").alias("n")).collect())
                if {r["point"] for r in rows} != set(numbers) or any((r["p"], r["n"]) != classes for r in rows):
                    raise RuntimeError("cells do not hold each tuple once per weight vector")
                found += [(r["point"], r["pairs"], float(r["p"]), r["n"]) for r in rows]
                if len(numbers) < len(mine):
                    groups.insert(0, [k for k in mine if k not in set(numbers)])
    auc = spark.createDataFrame(found, "point int, pairs double, p double, n long")      # a row per weight vector
    grid = F.get(weight_grid_column(weight_names, steps), F.col("point"))
    return (auc.withColumn("_w", grid)
               .select(*[F.col(f"_w.{c}").alias(c) for c in weight_names],
                       safe_div(F.col("pairs"), F.col("p") * F.col("n")).alias("auc")))


@contextmanager
def _files_leave(spark, settings: dict | None = None):
    """Inside, the shuffle files of a finished query are removed, and ``settings`` hold."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **(settings or {})}
    was = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in was.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def best_row(df: DataFrame, metric: str, tiebreak: Sequence[str]) -> DataFrame:
    """Arg-max row (ties broken by ``tiebreak`` descending) via a distributed top-1."""
    return df.orderBy(F.desc(metric), *[F.desc(c) for c in tiebreak]).limit(1)
