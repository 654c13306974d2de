"""Leaf-wise boosting against a plain numpy version that splits one leaf at a time."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import boosting as B
from ledgerlens.operators import evaluate as E
from ledgerlens.plans import q_model


def table(n=600, seed=1):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=n), r.integers(0, 6, n).astype(float), r.exponential(size=n)])
    x[r.random((n, 3)) < 0.05] = np.nan
    z = np.nan_to_num(x[:, 0]) + 0.7 * (np.nan_to_num(x[:, 1]) > 2) - 0.3 * np.nan_to_num(x[:, 2]) + r.normal(size=n)
    return x, (z > 0.5).astype(int)


@pytest.fixture(scope="module")
def data(spark):
    x, y = table()
    rows = [(i, *[None if np.isnan(v) else float(v) for v in a], int(b), i % 3) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, fold int").cache()


def brute(x, y, fold, h, p: B.Params, edges):
    """Margins of all rows and the ledger's gains, growing the best leaf first, one split after the other."""
    xb = B.binned(x, edges)
    inside = fold != p.fold
    w = np.where(y == 1, p.positive_weight, 1.0)
    margin = np.full(len(y), math.log(p.positive_weight * y[inside].sum() / (1 - y[inside]).sum()))
    losses, gains = [], []

    def loss():
        v = w * np.logaddexp(0, np.where(y == 1, -margin, margin))
        return np.rint(v[~inside] * B.UNIT).sum() / B.UNIT / w[~inside].sum()

    def shrink(v):
        return math.copysign(max(abs(v) - p.alpha, 0), v)

    for t in range(p.rounds):
        losses.append(loss())
        if t and t - 1 - int(np.argmin(losses[1:])) >= p.patience:
            break
        use = inside & ((B._hash(h, p.seed * 1_000_003 + t // p.row_every) < p.row_share) if p.row_share < 1 else True)
        s = 1 / (1 + np.exp(-margin))
        g, hs = np.rint(w * (s - y) * B.UNIT) / B.UNIT, np.rint(w * s * (1 - s) * B.UNIT) / B.UNIT
        cols = B._columns(p, t, x.shape[1])

        def best(rows, depth):
            top = (0.0, None)
            if depth >= p.depth:
                return top
            for c in cols:
                for b in range(max(len(e) for e in edges) + 1):
                    left = rows & (xb[:, c] <= b)
                    right = rows & (xb[:, c] > b)
                    sums = [(shrink(g[m & use].sum()), hs[m & use].sum(), (m & use).sum()) for m in (left, right, rows)]
                    if min(q[2] for q in sums[:2]) < p.least_rows or min(q[1] for q in sums[:2]) < p.least_hessian:
                        continue
                    v = [a * a / max(e + p.lambda_, 1e-12) for a, e, _ in sums]
                    if v[0] + v[1] - v[2] > max(top[0], 1e-9) + 1e-12:
                        top = (v[0] + v[1] - v[2], (left, right))
            return top
        leaves, queue = {}, []
        root = np.ones(len(y), bool)
        number = 0
        leaves[number] = (root, 0)
        gain, cut = best(root, 0)
        heapq.heappush(queue, (-gain, number, cut))
        while queue and len(leaves) < p.leaves:
            gain, k, cut = heapq.heappop(queue)
            if cut is None:
                break
            gains.append(-gain)
            depth = leaves.pop(k)[1] + 1
            for part in cut:
                number += 1
                leaves[number] = (part, depth)
                gn, ct = best(part, depth)
                heapq.heappush(queue, (-gn, number, ct))
        for rows, _ in leaves.values():
            margin[rows] += -p.rate * shrink(g[rows & use].sum()) / max(hs[rows & use].sum() + p.lambda_, 1e-12)
    else:
        losses.append(loss())
    return margin, losses, gains


CASES = [B.Params(fold=1, rounds=4, leaves=6, depth=4, rate=0.3, least_rows=8),
         B.Params(fold=2, rounds=5, leaves=9, depth=5, rate=0.2, least_rows=5, alpha=0.4, lambda_=2.0, positive_weight=3.0, least_hessian=0.5),
         B.Params(fold=0, rounds=4, leaves=5, depth=3, rate=0.3, least_rows=10, row_share=0.7, row_every=2, column_share=0.6, seed=7)]


@pytest.mark.parametrize("block_rows", [1 << 18, 150])
def test_models_match_brute_force(spark, data, block_rows):
    b = B.fit(data, ["a", "b", "c"], "y", "id", CASES, "fold", bins=8, block_rows=block_rows, keep_every=2)
    pdf = data.withColumn("h", F.xxhash64("id")).toPandas()
    x, y, fold, h = pdf[["a", "b", "c"]].to_numpy(float), pdf["y"].to_numpy(), pdf["fold"].to_numpy(), pdf["h"].to_numpy()
    for m, p in zip(b.models, CASES):
        margin, losses, gains = brute(x, y, fold, h, p, b.edges)
        assert m.losses == pytest.approx(losses, abs=1e-9) and len(m.trees) == p.rounds
        assert sorted(g for *_, g, _ in m.ledger) == pytest.approx(sorted(gains), rel=1e-9)
        full = B.Model(p, m.base, m.trees)
        full.losses = m.losses[:1] + sorted(m.losses[1:], reverse=True)      # all rounds
        assert full.margin(B.binned(x, b.edges)) == pytest.approx(margin, abs=1e-9)


def test_patience_and_going_on(spark, data):
    p = [B.Params(fold=i, rounds=60, patience=5, rate=0.5, leaves=8, least_rows=5) for i in range(3)]
    whole = B.fit(data, ["a", "b", "c"], "y", "id", p, "fold", bins=16)
    for m in whole.models:
        assert m.ended and len(m.trees) - m.best == 5 and len(m.losses) == len(m.trees) + 1
    short = [B.Params(**{**q.__dict__, "rounds": 3}) for q in p]
    on = B.fit(data, ["a", "b", "c"], "y", "id", p, "fold", start=B.fit(data, ["a", "b", "c"], "y", "id", short, "fold", bins=16))
    rows = B.fit(data.repartition(5), ["a", "b", "c"], "y", "id", p, "fold", bins=16, block_rows=100, keep_every=4)
    for a, b, c in zip(whole.models, on.models, rows.models):
        assert a.losses == b.losses == c.losses and a.ledger == b.ledger == c.ledger
    assert all(g > 0 for *_, g, _ in whole.ledger())
    assert sum(g for _, _, g in whole.importances()) == pytest.approx(sum(r["gain"] for r in B.ledger_frame(spark, whole).collect()))


def test_out_of_fold_scores_rank(spark, data):
    b = B.fit(data, ["a", "b", "c"], "y", "id", [B.Params(fold=i, rounds=40, rate=0.2, leaves=6) for i in range(3)], "fold", bins=16)
    oof = B.out_of_fold(data, b, "fold", ["id", "y"])
    assert oof.count() == 600 and E.roc_auc(oof, "y", "score").first()["auc"] > 0.7
    top = max(b.importances(), key=lambda x: x[2])
    assert top[1] == "a"
    assert B.predict(data.limit(0), b, ["id"]).count() == 0


def test_single_class_and_constant_columns(spark, data):
    d = data.withColumn("flat", F.lit(1.0)).withColumn("none", F.lit(None).cast("double"))
    b = B.fit(d, ["flat", "none"], "y", "id", [B.Params(fold=0, rounds=3)], "fold")
    assert b.ledger() == [] and np.allclose(np.concatenate([t.value for t in b.models[0].trees]), 0, atol=1e-6)
    one = B.fit(d.withColumn("y", F.lit(1)), ["a"], "y", "id", [B.Params(rounds=2)])
    assert len(one.models[0].trees) == 2 and B.predict(d, one, ["id"]).filter("scores[0] > 0.99").count() == 600


def test_changed_types_are_refused(spark, data):
    from ledgerlens.operators import prep as P
    other = data.withColumn("a", F.col("a").cast("string"))
    b = B.fit(data, ["a", "b"], "y", "id", [B.Params(rounds=1)])
    for bad in (other, data.drop("a")):
        with pytest.raises(ValueError, match="schema mismatch"):
            B.predict(bad, b, ["id"])
        with pytest.raises(ValueError, match="schema mismatch"):
            P.impute_finite(bad, data, ["a"])
    with pytest.raises(ValueError, match="schema mismatch"):
        P.fit_labels([data, other], "a")
    with pytest.raises(ValueError, match="schema mismatch"):
        B.fit(other, ["a", "b"], "y", "id", [B.Params(rounds=2)], start=b)


def test_search_grows_all_trials_together(spark, data):
    d = data.withColumnsRenamed({"a": "s1", "b": "s2", "c": "s3", "id": "rid"})
    t = q_model.search_trials(spark, d, n_trials=4, rounds=30, patience=5).orderBy("trial").toPandas()
    assert len(t) == 4 and (t["mean_auc"] > 0.6).all() and set(t.columns) >= {n.rstrip("_") for n in q_model.SPACE}
    assert t["rate"].between(0.01, 0.05).all() and t["leaves"].between(20, 80).all() and t["positive_weight"].between(8, 14).all()


def test_rows_of_the_same_bins_are_one_cell(spark, data, monkeypatch):
    """Repeated rows add no cells and no blocks; they count as often as they come."""
    many = data.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(19)))).withColumn("id", F.col("id") * 100 + F.col("k"))
    seen = []
    cut = B._blocks
    monkeypatch.setattr(B, "_blocks", lambda *a: seen.append(cut(*a)) or seen[-1])
    p = [B.Params(fold=i, rounds=3, leaves=6, rate=0.3, least_rows=20) for i in range(3)]
    for d in (data, many):
        B.fit(d, ["a", "b", "c"], "y", "id", p, "fold", bins=8, block_rows=700)
    (table, blocks, cells), (more, more_blocks, more_cells) = seen
    assert blocks == more_blocks == 1 and cells == more_cells and table.count() == more.count() == 1
    assert np.frombuffer(more.first()["n"], np.int64).sum() == 20 * 600
    by_cell = B.cell_counts(many, B.Boosted(["a", "b", "c"], B.bin_edges(data, ["a", "b", "c"], 8), []), ["fold"])
    assert by_cell.agg(F.sum("n")).first()[0] == 12_000 and by_cell.select("x").distinct().count() == cells


def test_sampled_rows_of_a_hot_cell_are_dealt_out(spark):
    """One cell with most rows: its hashes lie in several blocks, and the models stay the same."""
    d = spark.range(3000).select("id", F.when(F.col("id") % 5 == 0, F.col("id") % 7).otherwise(F.lit(3)).cast("double").alias("a"),
                                 (F.xxhash64("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 3).cast("int").alias("fold"))
    p = [B.Params(fold=i, rounds=6, leaves=4, rate=0.3, row_share=0.6, row_every=2, seed=5) for i in range(3)]
    one = B.fit(d, ["a"], "y", "id", p, "fold", bins=8)
    dealt = B.fit(d, ["a"], "y", "id", p, "fold", bins=8, block_hashes=500)
    kinds = [(f, y) for f in range(3) for y in (0, 1)]
    blocks = B._blocks(d, ["a"], "y", "fold", "id", one.edges, kinds, True, 1 << 18, 500)[0].collect()
    assert len(blocks) > 1 and sum(len(r["h"]) for r in blocks) == 8 * 3000 and max(len(r["h"]) for r in blocks) < 8 * 2000
    for a, b in zip(one.models, dealt.models):
        assert a.losses == b.losses and a.ledger == b.ledger


def test_samples_beyond_the_hashes_are_drawn_by_cell(spark, data):
    """No hash of a row is kept, and models do not depend on the blocks."""
    p = [B.Params(fold=i, rounds=4, leaves=5, depth=3, rate=0.3, least_rows=10, row_share=0.7, row_every=2, seed=7) for i in range(3)]
    one = B.fit(data, ["a", "b", "c"], "y", "id", p, "fold", bins=8, most_hashes=599)
    many = B.fit(data, ["a", "b", "c"], "y", "id", p, "fold", bins=8, most_hashes=599, block_rows=150)
    by_row = B.fit(data, ["a", "b", "c"], "y", F.xxhash64("id"), p, "fold", bins=8)
    for a, b, c, q in zip(one.models, many.models, by_row.models, p):
        assert a.losses == b.losses and a.ledger == b.ledger and len(a.trees) == 4
        assert 0.55 * 400 < a.ledger[0][4] < 0.85 * 400 and a.losses != c.losses
        assert c.losses == B.fit(data, ["a", "b", "c"], "y", "id", [q], "fold", bins=8).models[0].losses


def test_draws_by_cell_are_binomial():
    n = np.array([0, 1, 7, 255, 256, 4097, 10 ** 6], np.int64)
    x = np.array([[i, j] for i in range(40) for j in range(len(n))], np.uint8)
    row = {"x": x.tobytes(), "n": np.stack([np.tile(n, 40), np.tile(n[::-1], 40)], 1).tobytes(), "place": b"", "h": b""}
    block = B._Block(row, 2, [(0, 0), (0, 1)])
    for share in (0.6, 0.95):
        drawn = np.stack([block._sampled_by_cell(seed, share) for seed in range(60)]).reshape(60, 40, len(n), 2)
        both = np.concatenate([drawn[..., 0], drawn[..., ::-1, 1]], axis=1).reshape(-1, len(n))
        sd = np.sqrt(n * share * (1 - share))
        assert (both <= n).all() and (np.abs(both.mean(0) - n * share) <= 4.5 * sd / np.sqrt(len(both))).all()
        assert both.std(0)[1:] == pytest.approx(sd[1:], rel=0.06)
    part = B._Block(row | {"x": x[14:].tobytes(), "n": block.n[14:].tobytes()}, 2, block.kinds)
    assert (part._sampled_by_cell(3, 0.7) == block._sampled_by_cell(3, 0.7)[14:]).all()


def test_sums_over_boxes_are_those_of_the_cells():
    r = np.random.default_rng(2)
    x = r.integers(0, [9, 4, 6], (150, 3)).astype(np.uint8)
    x = np.unique(x, axis=0)
    g, h, n = r.integers(-9, 9, (3, len(x))).astype(float)
    block = B._Block({"x": x.tobytes(), "n": np.ones(len(x), np.int64).tobytes(), "place": b"", "h": b""}, 3, [(0, 0)])
    grid = block.grid()
    lo, hi = np.array([[0, 0, 0], [2, 1, 3], [4, 0, 0]]), np.array([grid.shape, [5, 3, 6], [4, 4, 6]])
    got = grid.histogram(grid.table(g, h, n), lo, hi, [0, 2], 10)
    for k in range(3):
        use = ((x >= lo[k]) & (x < hi[k])).all(axis=1)
        for j, c in enumerate([0, 2]):
            for i, v in enumerate((g, h, n)):
                assert (got[i, k, j] == np.bincount(x[use, c], v[use], 10)).all()
