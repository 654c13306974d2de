"""The skew-safe operators against brute force on small fixtures with one hot key."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import ensemble as B, evaluate as E, ordered as O
from ledgerlens.operators import prefix
from ledgerlens.operators.prefix import running_max
from ledgerlens.operators.profile import exact_percentiles


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(7)
    data = []
    u = 0
    for k in range(30):
        n = 900 if k == 0 else rng.randint(1, 12)        # key 0 holds most of the rows
        for _ in range(n):
            data.append((k, rng.randint(-40, 0), u, rng.choice([None, rng.random()]), rng.randint(0, 1)))
            u += 1
    rng.shuffle(data)
    return spark.createDataFrame(data, "k long, t long, u long, v double, y int").repartition(5)


def test_order_ranks_match_single_window(hot):
    r = O.with_order_ranks(hot, "k", "t", ["u"])
    w = Window.partitionBy("k")
    ref = (hot.withColumn("a", F.row_number().over(w.orderBy("t", "u")))
              .withColumn("d", F.row_number().over(w.orderBy(F.desc("t"), "u")))
              .withColumn("n", F.count(F.lit(1)).over(w)))
    got = {x["u"]: (x["_rn_a"], x["_rn_d"], x["_n"]) for x in r.collect()}
    exp = {x["u"]: (x["a"], x["d"], x["n"]) for x in ref.collect()}
    assert got == exp


def test_order_ranks_permutation_invariant(hot):
    a = O.with_order_ranks(hot, "k", "t", ["u"]).select("u", "_rn_a").collect()
    b = O.with_order_ranks(hot.repartition(3, "t").orderBy(F.rand(1)), "k", "t", ["u"]).select("u", "_rn_a").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("accuracy", [50, 100_000])
def test_exact_percentiles_vs_numpy(spark, hot, accuracy):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["k"], r["p_idx"]): r["value"]
           for r in exact_percentiles(hot, "v", probs, by=["k"], accuracy=accuracy).collect()}
    pdf = hot.toPandas()
    for k, g in pdf.groupby("k"):
        vals = g["v"].dropna().to_numpy()
        for i, p in enumerate(probs):
            if len(vals) == 0:
                assert (k, i) not in got
            else:
                assert got[(k, i)] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12, abs=1e-12)


def test_exact_percentiles_heavy_ties(spark):
    vals = [1.0] * 500 + [2.0] * 3 + [3.0] * 500
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r["value"] for r in exact_percentiles(df, "v", [0.25, 0.5, 0.75], accuracy=20).orderBy("p_idx").collect()]
    assert got == [float(np.percentile(vals, q)) for q in (25, 50, 75)]


def _auc_brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_half(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0)], "s double, y int")
    assert E.roc_auc(df, "y", "s").first()["auc"] == 0.5


@pytest.mark.parametrize("buckets", [1, 4, 256])
def test_auc_vs_brute_force(spark, buckets):
    rng = random.Random(3)
    data = [(rng.choice([round(rng.random(), 2), 0.5]), rng.randint(0, 1), rng.randint(0, 2)) for _ in range(600)]
    df = spark.createDataFrame(data, "s double, y int, g int")
    got = {r["g"]: r["auc"] for r in E.roc_auc(df, "y", "s", by=["g"], n_buckets=buckets).collect()}
    for g in range(3):
        sub = [(s, y) for s, y, gg in data if gg == g]
        assert got[g] == pytest.approx(_auc_brute(*zip(*sub)), abs=1e-12)


def test_roc_points_monotone_and_complete(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1)], "s double, y int")
    pts = sorted((r["threshold"], r["tpr"], r["fpr"]) for r in E.roc_points(df, "y", "s").collect())
    assert pts == [(0.1, 1.0, 1.0), (0.4, 1.0, 0.5), (0.8, 0.5, 0.0)]


def test_stratified_folds_balanced(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    f = E.stratified_folds(df, "id", "y", 5, 42).groupBy("fold", "y").count().collect()
    for y in (0, 1):
        cnt = [r["count"] for r in f if r["y"] == y]
        assert len(cnt) == 5 and max(cnt) - min(cnt) <= 1


def test_top_k_per_group_matches_row_number(hot):
    got = {(r["k"], r["u"]) for r in O.top_k_per_group(hot, "k", [F.desc("t"), F.asc("u")], 3, salt_col="u").collect()}
    w = Window.partitionBy("k").orderBy(F.desc("t"), F.asc("u"))
    exp = {(r["k"], r["u"]) for r in hot.withColumn("r", F.row_number().over(w)).filter("r <= 3").collect()}
    assert got == exp


def test_running_max(spark):
    rng = random.Random(5)
    vals = [(i, rng.random()) for i in range(500)]
    df = spark.createDataFrame(vals, "k long, v double")
    got = [r["running_max"] for r in running_max(df, "k", "v", n_buckets=8).orderBy("k").collect()]
    assert got == list(np.maximum.accumulate([v for _, v in vals]))


EDGE = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1023, 1.0, 2.0, 4.0, 8.0, 1e308, 1.7976931348623157e308,
        float("inf"), -float("inf"), 0.1, 0.3, -0.1, 1 / 3, 2.0 ** 29, 2.0 ** 29 - 2.0 ** -23, 1.0 - 2.0 ** -53, 1e-310]


def test_order_key_is_the_ieee_layout(spark):
    rng = random.Random(11)
    vals = EDGE + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for r in df.select("v", prefix.order_key(df, "v").alias("k")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["k"] == (bits if r["v"] >= 0 else -bits), r
    nan = spark.createDataFrame([(float("nan"),)], "v double")
    assert nan.select(prefix.order_key(nan, "v").alias("k")).first()["k"] == (2047 << 52) + 1


@pytest.mark.parametrize("shifts", [(20, 40), (8, 16, 48), (50,)])
def test_prefix_tree_against_brute_force(spark, shifts):
    rng = random.Random(12)
    vals = sorted(set([v for v in EDGE if v == v] + [rng.gauss(0, 1) for _ in range(400)] + [1e-9 * i for i in range(200)]))
    data = [(g, v, rng.randint(0, 9), rng.randint(0, 9)) for g in ("a", "b", None) for v in vals if v != 0 or g != "b"]
    data = [r for r in data if r[0] is not None]
    df = spark.createDataFrame(data, "g string, v double, p long, n long")
    tree = prefix.prefix_tree(df, ["g"], "v", {"before": F.col("n")}, shifts=shifts)
    top = prefix.prefix_tree(df, ["g"], "v", {"before": F.col("n")}, agg="max", shifts=shifts)
    got, most = ({(r["g"], r["v"]): r["before"] for r in t.collect()} for t in (tree, top))
    pairs = {r["g"]: r for r in prefix.pairs_below(df, ["g"], "v", "p", "n", shifts).collect()}
    for g in ("a", "b"):
        rows = sorted((r for r in data if r[0] == g), key=lambda r: r[1])
        below, num, peak = 0, 0.0, None
        for _, v, p, n in rows:
            assert got[g, v] == below and most[g, v] == peak
            num, below, peak = num + p * (below + n / 2), below + n, n if peak is None else max(peak, n)
        assert pairs[g]["pairs"] == num and pairs[g]["low"] == below


def test_prefix_tree_cells_do_not_grow(spark):
    """Children of one cell, at 1 and at 100 times the rows: far fewer than the rows, within the bound."""
    for n in (2_000, 200_000):
        df = spark.range(n).select((F.rand(7) + F.col("id") * 1e-12).alias("v"))
        k = df.select(prefix.order_key(df, "v").alias("k"))
        for low, high in zip((0, *prefix.SHIFTS), prefix.SHIFTS):
            cells = k.select(F.shiftright("k", low).alias("c"), F.shiftright("k", high).alias("up")).distinct()
            assert cells.groupBy("up").count().agg(F.max("count")).first()[0] <= min(1 << 20, max(100, n / 1000))
    plan = prefix.prefix_tree(df, [], "v", {"b": F.lit(1)})._jdf.queryExecution().toString()
    assert "Sample" not in plan


def test_auc_without_buckets(spark):
    rng = random.Random(4)
    data = [(rng.choice([rng.gauss(0, 1), round(rng.random(), 2), 0.5]), rng.randint(0, 1), rng.choice("xyz")) for _ in range(900)]
    df = spark.createDataFrame(data + [(None, 1, "x"), (0.5, None, "x"), (0.5, 1, "only")], "s double, y int, g string")
    got = {r["g"]: r["auc"] for r in E.roc_auc(df, "y", "s", by=["g"]).collect()}
    for g in "xyz":
        assert got[g] == pytest.approx(_auc_brute(*zip(*[r[:2] for r in data if r[2] == g])), abs=1e-12)
    assert got["only"] is None and E.roc_auc(df.limit(0), "y", "s").collect() == []


def test_blend_grid_against_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    data = [(round(rng.random(), 1), rng.gauss(0, 1e3), rng.choice([0.25, 0.5]), rng.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(data + [(None, 1.0, 0.5, 1), (0.1, 1.0, 0.5, None)] + [(0.5, 7.0, 0.5, 1)] * 100,
                               "a double, b double, c double, y int")
    rows = data + [(0.5, 7.0, 0.5, 1)] * 100
    for cell_rows, block_rows in ((1 << 18, 1 << 16), (9, 40)):     # one cell and one block; many of each
        monkeypatch.setattr(B, "CELL_ROWS", cell_rows)
        monkeypatch.setattr(B, "BLOCK_ROWS", block_rows)
        got = B.blend_grid_auc(df, "y", ["a", "b", "c"], ["wa", "wb", "wc"], steps=4).collect()
        assert len(got) == 15
        for r in got:
            s = [r["wa"] * a + r["wb"] * b + r["wc"] * c for a, b, c, _ in rows]
            assert r["auc"] == pytest.approx(_auc_brute(s, [x[3] for x in rows]), abs=1e-12)
    assert B.blend_grid_auc(df.limit(0), "y", ["a", "b", "c"], ["wa", "wb", "wc"], steps=4).collect() == []


def test_blend_grid_goes_over_its_weight_vectors_in_groups(spark, monkeypatch):
    """Blends beyond BLEND_BYTES never lie on disk together; any grouping gives the same AUCs."""
    df = spark.range(400).select((F.xxhash64("id") % 97 / 97).alias("a"), (F.xxhash64("id", F.lit(1)) % 89 / 89).alias("b"),
                                 (F.col("id") % 3 == 0).cast("int").alias("y"))
    rows, seen = [], []
    cut = B._cut_blocks
    monkeypatch.setattr(B, "_cut_blocks", lambda p, *a: seen.append(len(p)) or cut(p, *a))
    for most in (1 << 30, 10 * 400 * 2):
        monkeypatch.setattr(B, "BLEND_BYTES", most)
        rows.append(sorted(B.blend_grid_auc(df, "y", ["a", "b"], ["wa", "wb"], steps=6).collect()))
    assert rows[0] == rows[1] and len(rows[0]) == 7 and seen == [7, 2, 2, 2, 1]


def _pairs_brute(neg, pos):
    return float(sum((n < p) + (n == p) / 2 for n in neg for p in pos))


@pytest.mark.parametrize("low,high", [(0.0, 1.0), (-1.0, 1.0), (-5e300, 5e300), (3.0, 900.0), (-7.0, -6.0), (-1e-310, 1e-310)])
def test_pairs_of_blends_by_their_bits(low, high):
    rng = np.random.default_rng(3)
    neg, pos = (np.r_[rng.uniform(low / 2, high / 2, n) * 2, rng.choice([low, -0.0, 0.0, high], 40)] for n in (90, 60))
    pos[:20] = neg[:20]
    got = B._pairs(neg, pos)
    if high - low < 1e300:
        assert got == _pairs_brute(neg, pos)
    b, p = np.r_[neg, pos], np.r_[np.zeros(len(neg), np.int64), np.ones(len(pos), np.int64)]
    assert got in (None, B._weighted_pairs(b, p, 1 - p)) and B._weighted_pairs(b, p, 1 - p) == _pairs_brute(neg, pos)


@pytest.mark.parametrize("repeats", [False, True])
def test_tuples_of_near_weight_vectors_travel_together(monkeypatch, repeats):
    """Under three bytes a blend go to the cells, where a blend alone has eight; every tuple is counted once a vector."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    s = np.stack([rng.random(6000), rng.integers(0, 11, 6000) / 10, rng.integers(1, 51, 6000) / 50])
    pos = rng.integers(0, 2, 6000) * (rng.integers(1, 300, 6000) if repeats else 1)
    neg = np.where(pos == 0, 1, rng.integers(0, 4, 6000) if repeats else 0)
    rows = pa.RecordBatch.from_arrays([pa.array(v) for v in (*s, pos, neg)], names=["a", "b", "c", "pos", "neg"])
    monkeypatch.setattr(B, "BLOCK_ROWS", 1500)
    monkeypatch.setattr(B, "CELL_ROWS", 2500)
    blocks = list(B._pack(3)([rows]))
    sizes = [sum(v for b in blocks for v in b.column("rows").to_pylist()), sum(len(v) for b in blocks for v in b.column("scores").to_pylist())]
    probes = np.concatenate([np.frombuffer(v, np.float64).reshape(-1, 3) for b in blocks for v in b.column("probe").to_pylist()]).T
    points = np.array(B.grid_points(3, 20))
    tiles, splits = B._lay(points / 20, probes, sizes[0], sizes[1] / sizes[0], 1)
    assert sorted(k for t in tiles for k in t) == list(range(231)) and splits.shape[1] > 0
    parts = list(B._cut_blocks(points, 20, tiles, splits)(blocks))
    assert sum(len(v) for b in parts for v in b.column("scores").to_pylist()) < 3 * 231 * sizes[0]
    found = pa.Table.from_batches(list(B._count_cells(points, range(231), 20, tiles, splits)(parts))).to_pandas()
    for k in (0, 17, 100, 230):
        mine = found[found.point == k].sort_values("cell")
        assert (mine.n_pos.sum(), mine.n_neg.sum()) == (pos.sum(), neg.sum())
        pairs = mine.pairs.sum() + (mine.n_pos * (mine.n_neg.cumsum() - mine.n_neg)).sum()
        w = points[k] / 20.0
        assert pairs == B._weighted_pairs(w[0] * s[0] + w[1] * s[1] + w[2] * s[2], pos, neg)


@pytest.mark.parametrize("tie", ["long", "double", "string"])
def test_order_ranks_split_one_time(spark, tie):
    """One entity with a single time, one with none at all, one with both; cells of four tiebreaks."""
    rng = random.Random(9)
    data = [("one", 5, u) for u in range(-40, 40)] + [("none", None, u) for u in range(50)]
    data += [("mix", rng.choice([None, 1, 2]), u) for u in range(60)] + [("mix", 2, None), (None, 1, 3)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, t int, u long").withColumn("u", F.col("u").cast(tie))
    got = O.with_order_ranks(df, "k", "t", ["u"], cell_bits=50 if tie == "double" else 2).collect()
    assert len(got) == len(data) - 1
    for k in ("one", "none", "mix"):
        rows = [r for r in got if r["k"] == k]
        first = lambda r: (r["u"] is not None, r["u"])
        up = sorted(rows, key=lambda r: (r["t"] is None, r["t"] or 0, *first(r)))
        down = sorted(rows, key=lambda r: (r["t"] is None, -(r["t"] or 0), *first(r)))
        assert [r["_rn_a"] for r in up] == [r["_rn_d"] for r in down] == list(range(1, len(rows) + 1))
        assert all(r["_n"] == len(rows) for r in rows)


def test_running_max_by_the_tree(spark):
    rng = random.Random(8)
    vals = [(i * 3 - 700, rng.random()) for i in range(500)]
    for t in ("long", "double"):
        df = spark.createDataFrame(vals, "k long, v double").withColumn("k", F.col("k").cast(t))
        got = [r["running_max"] for r in running_max(df, "k", "v").orderBy("k").collect()]
        assert got == list(np.maximum.accumulate([v for _, v in vals]))


def test_weight_grid_simplex():
    pts = B.grid_points(3, 20)
    assert len(pts) == 231 and all(sum(p) == 20 for p in pts) and len(set(pts)) == 231


def test_wide_correlation_path_matches_pairwise(spark):
    from conftest import SF0001
    from ledgerlens.operators.profile import corr_pairs
    from ledgerlens.sources import tables as T
    li = T.load(spark, SF0001, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    li = li.select(*[F.when((F.col("l_orderkey") + i) % len(cols) != 0, F.col(c)).alias(c) for i, c in enumerate(cols)])
    assert li.dropna().isEmpty()          # every row has a NULL
    narrow = {(r["a"], r["b"]): r["r"] for r in corr_pairs(li, cols).collect()}
    wide = {(r["a"], r["b"]): r["r"] for r in corr_pairs(li, cols, max_aggregates=1).collect()}
    want = li.toPandas().astype(float).corr()
    assert narrow.keys() == wide.keys()
    for k in narrow:
        assert wide[k] == pytest.approx(narrow[k], abs=1e-9) and narrow[k] == pytest.approx(want.loc[k], abs=1e-9)


def test_wide_correlation_is_one_pass_and_holds_far_from_zero(spark):
    """Tasks' co-moments meet without a pass for the means before; columns far from zero, constant ones and
    pairs that are never present together keep their result."""
    import numpy as np
    import pandas as pd
    from ledgerlens.operators.profile import corr_pairs
    r = np.random.default_rng(4)
    x = r.standard_normal(500)
    pdf = pd.DataFrame({"a": 1e9 + x, "b": 3e9 - x + r.standard_normal(500), "c": 7.1, "d": np.where(np.arange(500) < 250, x, np.nan),
                        "e": np.where(np.arange(500) >= 250, x, np.nan)})
    df = spark.createDataFrame(pdf).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns]).repartition(6)
    out = corr_pairs(df, pdf.columns, max_aggregates=1)
    got = {(v["a"], v["b"]): v["r"] for v in out.collect()}
    assert len(got) == 10 and got["d", "e"] is None and all(v is None for k, v in got.items() if "c" in k)
    want = pdf.corr()
    for k in (("a", "b"), ("a", "d"), ("b", "e"), ("a", "e")):
        assert got[k] == pytest.approx(want.loc[k], abs=1e-6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and plan.count("MapInArrow") <= 2


def test_untimed_rows_rank_last_in_both_directions(spark):
    import pandas as pd
    rng = random.Random(3)
    data = [(k, rng.choice([None, None, 1, 2, 3, 5, 8]), u, rng.random(), rng.randint(0, 1)) for u, k in
            enumerate(rng.choice([0, 0, 0, 1, 2, 3, 4]) for _ in range(120))]
    df = spark.createDataFrame(data, "k long, t long, u long, v double, y int")
    pdf = df.toPandas()
    r = O.with_order_ranks(df, "k", "t", ["u"])
    out = {x["k"]: x for x in r.groupBy("k").agg(
        O.newest_mean("v", 3).alias("newest"), O.head_mean("v", 3).alias("head"), O.tail_mean("v", 3).alias("tail"),
        O.leading_streak(F.col("y") == 1).alias("streak"), O.newest_k_rate(F.col("y") == 1).alias("rate"),
        O.first_value("v", "t", ["u"]).alias("first"), O.last_value("v", "t", ["u"]).alias("last")).collect()}
    for k, g in pdf.groupby("k"):
        up = g.sort_values(["t", "u"], na_position="last")
        down = pd.concat([g[g.t.notna()].sort_values(["t", "u"], ascending=[False, True]), g[g.t.isna()].sort_values("u")])
        streak = next((i for i, y in enumerate(down.y) if y != 1), len(down))
        o = out[k]
        assert o["streak"] == streak and o["first"] == up.v.iloc[0] and o["last"] == up.v.iloc[-1]
        for name, want in (("newest", down.v[:3].mean()), ("head", up.v[:3].mean()), ("tail", up.v[-3:].mean()), ("rate", (down.y[:3] == 1).mean())):
            assert o[name] == pytest.approx(want), (k, name)


def test_percentiles_collapse_ties(spark):
    """A value held by most rows is one candidate, whatever the number of its rows."""
    df = spark.range(30_000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 10 < 8, 5.0).otherwise(F.col("id") * 1.0).alias("v"))
    pdf = df.toPandas()
    got = {(r["k"], r["p_idx"]): r["value"] for r in exact_percentiles(df, "v", [0.1, 0.5, 0.9], by=["k"]).collect()}
    for k, g in pdf.groupby("k"):
        for i, p in enumerate((0.1, 0.5, 0.9)):
            assert got[k, i] == pytest.approx(np.percentile(g.v, 100 * p))


def test_queries_keep_full_precision(spark):
    from ledgerlens.plans.registry import finish
    assert finish(spark.sql("SELECT 3e-7D AS x, 1.5e300D AS y")).first()[:] == (3e-7, 1.5e300)


def test_vocabulary_with_a_common_prefix(spark):
    from ledgerlens.operators import prep as P
    vals = [f"common-prefix-{i:05d}" for i in range(1500)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "c string").repartition(5)
    got = {r["value"]: r["code"] for r in P.fit_labels([df], "c").collect()}
    assert got == {v: i for i, v in enumerate(sorted(v or "missing" for v in vals))}
    other = spark.createDataFrame([("common-prefix-00003",), ("unseen",), (None,)], "c string")
    assert {r["c"]: r["c_code"] for r in P.apply_labels(other, P.fit_labels([df], "c"), "c").collect()} == {
        "common-prefix-00003": 3, "unseen": None, None: 1500}


def test_fold_models_score_each_row_once(spark):
    from ledgerlens.operators import model as M
    rng = random.Random(1)
    data = [(i, i % 3, int(rng.random() < 0.4)) for i in range(300)]
    df = spark.createDataFrame([(i, f, y, y + rng.gauss(0, 0.4), rng.random()) for i, f, y in data], "id long, fold int, y int, a double, b double")
    f = M.fit_folds(df, ["a", "b"], "y", "fold", 3, "gbt", early_stopping=True, maxIter=5, maxDepth=2)
    oof = f.oof(["id"])
    assert sorted(r["id"] for r in oof.collect()) == list(range(300))
    assert E.roc_auc(oof, "y", "score").first()["auc"] > 0.8
    mean = {r["id"]: r["score"] for r in f.test_average(df.limit(20), ["id"]).collect()}
    each = [{r["id"]: r["score"] for r in M.positive_score(m.transform(f.frame)).select("id", "score").collect()} for m in f.models]
    assert all(v == pytest.approx(np.mean([e[i] for e in each])) for i, v in mean.items())


def test_boosting_ends_by_patience(spark):
    """The least validation loss of the rounds that patience allows, with every tree up to it."""
    from ledgerlens.operators import model as M
    assert M.best_round([5, 4, 4.5, 4.4, 3, 3.5], 3) == (5, False)
    assert M.best_round([5, 4, 4.5, 4.4, 3, 3.5], 2) == (2, True)
    assert M.best_round([1, 2, 3, 0], 2) == (1, True)
    rng = random.Random(4)
    data = [(i, i % 2, int(rng.random() < 0.5)) for i in range(300)]
    df = spark.createDataFrame([(i, f, y, y + rng.gauss(0, 0.5), rng.random()) for i, f, y in data], "id long, fold int, y int, a double, b double")
    small = dict(maxIter=7, maxDepth=2, stepSize=0.05)
    full = M.fit_folds(df, ["a", "b"], "y", "fold", 2, "gbt", **small)
    f = M.fit_folds(df, ["a", "b"], "y", "fold", 2, "gbt", early_stopping=True, patience=2, **small)
    for i in range(2):
        losses = full.models[i].evaluateEachIteration(full.frame.filter(F.col("fold") == i))
        assert f.models[i].getNumTrees == M.best_round(losses, 2)[0] > 2


@pytest.mark.parametrize("name", ["oof_scores", "gbt_importance", "test_average", "selected_retrain", "random_search"])
def test_model_queries_use_the_surveyed_settings(spark, name, monkeypatch):
    from conftest import SF0001
    from ledgerlens.operators import boosting as B
    from ledgerlens.plans import catalog

    class Seen(Exception):
        pass

    def fit(df, features, label, key, models, fold_col=None, **kw):
        raise Seen(models)
    monkeypatch.setattr(B, "fit", fit)
    with pytest.raises(Seen) as e:
        catalog.QUERIES[name](spark, SF0001)
    models = e.value.args[0]
    if name == "random_search":
        assert len(models) == 300 and {(m.rounds, m.patience) for m in models} == {(2000, 50)}
        assert len({(m.depth, m.rate, m.row_share, m.alpha) for m in models}) == 100
        assert all(6 <= m.depth <= 15 and 0.01 <= m.rate <= 0.05 and 20 <= m.leaves <= 80 and 30 <= m.least_rows <= 150 for m in models)
        assert all(0.6 <= v <= 0.95 for m in models for v in (m.row_share, m.column_share))
    else:
        assert {(m.rounds, m.depth, m.rate, m.patience) for m in models} == {(1000, 7, 0.02, 100)}
        assert sorted(m.fold for m in models) == list(range(len(models)))


def test_every_pair_of_the_wide_correlation(spark):
    from conftest import SF0001
    from ledgerlens.operators.profile import corr_pairs
    from ledgerlens.plans import q_eval
    df = q_eval.wide_columns(spark, SF0001)
    got = {(r["a"], r["b"]): r["r"] for r in corr_pairs(df, df.columns).collect()}
    pdf = df.toPandas().astype(float)
    want = pdf.corr()
    assert len(got) == 80 * 79 // 2
    for (a, b), r in got.items():
        both = pdf[[a, b]].dropna()
        if both[a].nunique() < 2 or both[b].nunique() < 2:
            assert r is None, (a, b)
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-9), (a, b)


@pytest.mark.parametrize("hot_rows,joined", [(None, False), (None, True), (8, False), (8, True), (0, False)])
def test_order_ranks_of_hot_and_other_keys(spark, hot_rows, joined):
    """Keys of more rows than one task may hold are numbered by cells, the others in one sort; ranks are the same."""
    rng = random.Random(12)
    data = [(k, rng.choice("ab"), rng.choice([None, 1, 1, 2, 3, 5]), rng.choice([None, *range(6)]), u)
            for u, k in enumerate(rng.choice([0, 0, 0, 1, 2, 3, 4, None]) for _ in range(300))]
    df = spark.createDataFrame(data, "k long, j string, t long, p long, u long").repartition(5)
    got = O.with_order_ranks(df, ["k", "j"], "t", ["p", "u"], cell_bits=1, hot_rows=hot_rows, joined_on_first=joined).collect()
    want = {}
    for key in {d[:2] for d in data if d[0] is not None}:
        rows = sorted((d for d in data if d[:2] == key), key=lambda d: (d[3] is not None, d[3], d[4]) if d[3] is not None else (False, 0, d[4]))
        up = sorted(rows, key=lambda d: (d[2] is None, d[2] or 0))
        down = sorted(rows, key=lambda d: (d[2] is None, -(d[2] or 0)))
        want |= {d[4]: (up.index(d) + 1, down.index(d) + 1, len(rows)) for d in rows}
    assert {r["u"]: (r["_rn_a"], r["_rn_d"], r["_n"]) for r in got} == want and len(got) == len(want)


def test_clustered_keeps_all_rows_and_spreads_hot_keys(spark, hot):
    spark.conf.set("spark.sql.adaptive.enabled", "false")       # parts stay as dealt
    try:
        for most in (None, 100):
            c, at = O.clustered(hot, "k", most), {}
            assert sorted(map(str, c.collect())) == sorted(map(str, hot.collect()))
            for r in c.select("k", F.spark_partition_id().alias("p")).distinct().collect():
                at.setdefault(r["k"], []).append(r["p"])
            assert (len(at[0]) > 1) == (most == 100) and all(len(p) == 1 for k, p in at.items() if k)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
