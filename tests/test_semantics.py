"""Edge-case fixtures: null / zero-division / tie / threshold rules (FIXTURES §3)."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators import joins as J, ordered as O, rollup as R
from ledgerlens.operators.profile import corr_expr


def rows(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_null_key_dropped(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 2.0), (1, 3.0)], "k long, v double")
    out = rows(R.rollup(df, "k", [F.count(F.lit(1)).alias("n")]))
    assert out == [(1, 2)]


def test_all_null_measure(spark):
    df = spark.createDataFrame([(3, None), (3, None)], "k long, v double")
    r = R.rollup(df, "k", [R.size_agg("size"), *R.measure_aggs({"v": ["sum", "mean", "max", "std", "count"]})]).first()
    assert r["v_sum"] == 0.0 and r["v_mean"] is None and r["v_max"] is None and r["v_std"] is None
    assert r["v_count"] == 0 and r["size"] == 2


def test_single_row(spark):
    df = spark.createDataFrame([(2, 1, 7.0)], "k long, t long, v double")
    r = R.rollup(df, "k", [F.stddev_samp("v").alias("sd"), O.first_last_change("v", "t", ["t"]).alias("tr")]).first()
    assert r["sd"] is None and r["tr"] == 0.0


def test_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (None, 0.0)], "a double, b double")
    out = df.select(X.safe_div("a", "b").alias("s"), X.ieee_div("a", "b").alias("i")).collect()
    assert [r["s"] for r in out] == [None] * 4
    assert [r["i"] for r in out] == [math.inf, None, -math.inf, None]


def test_clip_null_inf(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,), (None,)], "c double")
    assert [r[0] for r in df.select(X.clip("c", 0.0, 1.0)).collect()] == [1.0, 0.0, None]


def test_null_compare_flag(spark):
    df = spark.createDataFrame([(1, None), (1, 1)], "k long, delay long")
    r = R.rollup(df.withColumn("late", X.flag(F.col("delay") > 0)), "k",
                 [F.collect_list("late").alias("l"), F.avg("late").alias("m")]).first()
    assert sorted(r["l"]) == [0, 1] and r["m"] == 0.5


def test_pct_rank_ties(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 2, 3), (1, None, 4)], "k long, t long, u long")
    out = {r["u"]: r["p"] for r in O.pct_rank(df, "k", "t", "p").collect()}
    assert out[1] == pytest.approx(1 / 3) and out[2] == pytest.approx(2.5 / 3) and out[3] == pytest.approx(2.5 / 3)
    assert out[4] is None


def test_tie_topk_keep_first(spark):
    df = spark.createDataFrame([(1, -10, i) for i in range(4)] + [(1, -20, 4)], "k long, t long, u long")
    r = O.with_order_ranks(df, "k", "t", ["u"])
    newest = sorted(x["u"] for x in r.filter("_rn_d <= 3").collect())
    oldest = sorted(x["u"] for x in r.filter("_rn_a <= 2").collect())
    assert newest == [0, 1, 2] and oldest == [0, 4]


def test_null_time_rows_kept_and_last(spark):
    df = spark.createDataFrame([(1, None, 0), (1, 5, 1), (1, 3, 2)], "k long, t long, u long")
    got = {r["u"]: (r["_rn_a"], r["_n"]) for r in O.with_order_ranks(df, "k", "t", ["u"]).collect()}
    assert got == {2: (1, 3), 1: (2, 3), 0: (3, 3)}


@pytest.mark.parametrize("n,expected",[(1, 0.0), (2, 0.0), (3, None), (5, None), (6, None), (7, None)])
def test_thresholds(spark, n, expected):
    df = spark.createDataFrame([(1, i, i, float(i)) for i in range(n)], "k long, t long, u long, v double")
    r = R.rollup(O.with_order_ranks(df, "k", "t", ["u"]), "k", [
        O.tail_head_diff("v", 3, 3).alias("w10"), O.tail_head_diff("v", 6, 6).alias("w4"),
        O.ratio_of_sums_trend("v", "v", 3, 3, 1.0).alias("w11")]).first()
    if n < 3:
        assert r["w10"] == 0.0 and r["w11"] == 1.0
    else:
        assert r["w10"] == pytest.approx((n - 1 + n - 2 + n - 3) / 3 - 1.0)
    if n < 6:
        assert r["w4"] == 0.0
    else:
        assert r["w4"] == pytest.approx(sum(range(n - 6, n)) / 6 - sum(range(6)) / 6)


def test_gaps(spark):
    df = spark.createDataFrame([(1, -30), (1, -20), (1, -5)], "k long, t long")
    assert R.rollup(df, "k", [O.mean_abs_gap("t").alias("g")]).first()["g"] == 12.5


@pytest.mark.parametrize("codes,expected", [(["C", "0", "2", "C"], 2), (["C", "X", "0"], 3), (["1", "C"], 0)])
def test_streak(spark, codes, expected):
    # codes listed newest first -> time descending
    df = spark.createDataFrame([(1, -i, i, c) for i, c in enumerate(codes)], "k long, t long, u long, c string")
    r = R.rollup(O.with_order_ranks(df, "k", "t", ["u"]), "k",
                 [O.leading_streak(F.col("c").isin("C", "X", "0")).alias("s")]).first()
    assert r["s"] == expected


def test_category_shares(spark):
    df = spark.createDataFrame([(1, "C"), (1, "C"), (1, "1"), (1, None)], "k long, c string")
    r = R.rollup(df, "k", R.category_shares("c", ["C", "1", "X"], "S_")).first()
    assert r["S_C_RATIO"] == pytest.approx(2 / 3) and r["S_1_RATIO"] == pytest.approx(1 / 3) and r["S_X_RATIO"] == 0.0


def test_row_stats(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (1.0, 3.0)], "a double, b double")
    out = df.select(X.row_mean("a", "b"), X.row_max("a", "b"), X.row_sum0("a", "b")).collect()
    assert [tuple(r) for r in out] == [(None, None, 0.0), (1.0, 1.0, 1.0), (2.0, 3.0, 4.0)]


def test_corr_constant_and_pairwise(spark):
    c = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "x double, y double")
    assert c.agg(corr_expr("x", "y")).first()[0] is None
    p = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 6.0)], "x double, y double")
    assert p.agg(corr_expr("x", "y")).first()[0] == pytest.approx(0.99587059, abs=1e-8)


def test_suffix_clash(spark):
    a = spark.createDataFrame([(1, 1.0)], "id long, m double")
    b = spark.createDataFrame([(1, 2.0)], "id long, m double")
    with pytest.raises(ValueError):
        J.spine_join(a, [b], "id")
    out = J.spine_join(a, [J.prefix_columns(b, "id", "POS_")], "id")
    assert out.columns == ["id", "m", "POS_m"]


def test_unknown_code_map(spark):
    df = spark.createDataFrame([("1",), ("Z",)], "c string")
    m = {"C": 0, "1": 1}
    out = df.select(X.map_values("c", m).alias("a"), F.coalesce(X.map_values("c", m), F.lit(0)).alias("b")).collect()
    assert [tuple(r) for r in out] == [(1, 1), (None, 0)]


def test_band(spark):
    df = spark.createDataFrame([(1, p) for p in (-13, -12, -7, -6)], "k long, p long")
    r = R.rollup(df, "k", [F.collect_list(F.when(R.slice_pred("p", -12, -6), F.col("p"))).alias("x")]).first()
    assert sorted(r["x"]) == [-12, -7]


def test_orphan_child(spark):
    child = spark.createDataFrame([(10, 1.0), (99, 2.0)], "parent long, v double")
    parent = spark.createDataFrame([(10, 1)], "parent long, id long")
    assert rows(J.attach_key(child, parent, "parent", "id")) == [(10, 1.0, 1)]


def test_csv_inf_roundtrip(spark, tmp_path):
    from ledgerlens.sources import io
    df = spark.createDataFrame([(1, math.inf), (2, -math.inf), (3, 1.5)], "k long, v double")
    io.write_csv(df, str(tmp_path / "c"))
    back = io.read_csv(spark, str(tmp_path / "c"), schema="k long, v double")
    assert rows(back, ["k"]) == [(1, math.inf), (2, -math.inf), (3, 1.5)]


def test_params_and_names_roundtrip(spark, tmp_path):
    from ledgerlens.sources import io
    p = {"maxDepth": 5, "stepSize": 0.1}
    io.write_params(spark, p, str(tmp_path / "p"))
    assert io.read_params(spark, str(tmp_path / "p")) == p
    assert [r[0] for r in io.name_list(spark, ["a", "b"]).collect()] == ["a", "b"]


def test_column_split_and_width(spark):
    from ledgerlens.operators.profile import column_split, width_report
    df = spark.createDataFrame([(1, "x", 2.0)], "SK_ID_CURR long, c string, v double")
    assert column_split(df) == (["SK_ID_CURR", "v"], ["c"])
    assert width_report(df, df.withColumn("w", F.lit(1))) == {"original": 2, "final": 3, "new": 1}


def test_result_sinks_and_trial_read_back(spark, tmp_path):
    from ledgerlens.sources import io
    trials = [(0, {"maxDepth": 6, "stepSize": 0.02}, 0.71), (1, {"maxDepth": 9, "stepSize": 0.01}, 0.78), (2, {"maxDepth": 7}, 0.78)]
    io.write_trials(spark, trials, str(tmp_path / "trials"))
    table, best = io.read_trials(spark, str(tmp_path / "trials"))
    assert table.count() == 3 and best == {"maxDepth": 9, "stepSize": 0.01}
    io.write_ranked(table.select("trial", "mean_auc"), str(tmp_path / "ranked"), [table["mean_auc"].desc(), "trial"])
    got = io.read_csv(spark, str(tmp_path / "ranked"), "trial int, mean_auc double")
    assert [r["trial"] for r in got.collect()] == [1, 2, 0]
    rows = [("data", "rows", "100"), ("model", "auc", "0.78")]
    io.write_report(spark, rows, str(tmp_path / "report"))
    assert [tuple(r) for r in io.read_csv(spark, str(tmp_path / "report"), "section string, key string, value string").collect()] == rows
