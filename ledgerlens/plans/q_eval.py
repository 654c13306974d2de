"""Catalogue part 4: profiling (D*, A16-A17), selection (S2-S4), splits and
metrics (M1-M2, M4-M7, M11), fold summaries (A19-A20), blending (B2-B5, T6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import ensemble as B, evaluate as E, profile as D, selection as S
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import ORACLE, finish, query
from ledgerlens.sources import tables as T

MODELS = ["s1", "s2", "s3"]
SPINE_NUM = ["income", "acctbal", "ext1", "ext2", "ext3"]
LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _one_row_join(a, b):
    """Join two one-row frames (both bounded to a single row)."""
    return a.withColumn("_g", F.lit(0)).join(F.broadcast(b.withColumn("_g", F.lit(0))), "_g").drop("_g")


# ------------------------------------------------------------------ A16 / A17 / M11
@query("score_summary")
def score_summary(spark, d):
    s = T.scored(spark, d)
    basic = s.agg(F.min("s1").alias("min_s1"), F.max("s1").alias("max_s1"), F.avg("s1").alias("mean_s1"),
                  F.stddev_samp("s1").alias("std_s1"), F.count("s1").alias("n"))
    med = D.percentiles_wide(s, "s1", [0.5], ["median_s1"])
    return finish(_one_row_join(basic, med))


sql("score_summary", """
SELECT min(s1) AS min_s1, max(s1) AS max_s1, avg(s1) AS mean_s1, stddev_samp(s1) AS std_s1, count(s1) AS n,
       median(s1) AS median_s1
FROM scored""", ["scored"], rnd=["min_s1", "max_s1", "mean_s1", "std_s1", "median_s1"])


@query("value_counts")
def value_counts(spark, d):
    return finish(D.value_counts(T.scored(spark, d), "y"))


sql("value_counts", """
SELECT CAST(y AS BIGINT) AS y, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM scored GROUP BY y""", ["scored"], rnd=["share"])


@query("class_weights")
def class_weights(spark, d):
    return finish(E.class_weights(T.scored(spark, d), "y"))


sql("class_weights", """
SELECT CAST(y AS BIGINT) AS y, count(*) AS n_class, sum(count(*)) OVER () / (2.0 * count(*)) AS weight
FROM scored GROUP BY y""", ["scored"], rnd=["weight"])


# ------------------------------------------------------------------ D1 / D4 / D6 / D7
@query("missing_report")
def missing_report(spark, d):
    return finish(D.missing_report(T.spine(spark, d)))


_SPINE_ALL = ["id", "seg", "region", "acctbal", "income", "ext1", "ext2", "ext3"]
sql("missing_report", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS missing, 100.0 * (count(*) - count({c})) / count(*) AS missing_pct "
    f"FROM spine" for c in _SPINE_ALL) + ") t WHERE missing > 0", ["spine"], rnd=["missing_pct"])


@query("describe_features")
def describe_features(spark, d):
    return finish(D.describe(T.spine(spark, d), SPINE_NUM))


sql("describe_features", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, quantile_cont({c}, 0.25) AS p25, "
    f"quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75 FROM spine" for c in SPINE_NUM),
    ["spine"], rnd=["mean", "std", "min", "max", "p25", "p50", "p75"])


@query("box_stats")
def box_stats(spark, d):
    return finish(D.box_stats(T.hist(spark, d), "amt", ["status"]))


sql("box_stats", """
WITH q AS (SELECT status, quantile_cont(amt, 0.25) AS q1, quantile_cont(amt, 0.5) AS median,
                  quantile_cont(amt, 0.75) AS q3 FROM hist GROUP BY status)
SELECT q.status, q1, median, q3, q3 - q1 AS iqr,
       min(amt) FILTER (WHERE amt >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
       max(amt) FILTER (WHERE amt <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
       count(*) FILTER (WHERE amt < q1 - 1.5 * (q3 - q1) OR amt > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       count(*) AS n
FROM hist h JOIN q ON h.status = q.status
GROUP BY q.status, q1, median, q3""", ["hist"], rnd=["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])


@query("corr_matrix")
def corr_matrix(spark, d):
    return finish(D.corr_pairs(T.load(spark, d, "lineitem"), LI_COLS))


sql("corr_matrix", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({b}, {a}) AS r FROM lineitem"
    for i, a in enumerate(LI_COLS) for b in LI_COLS[i + 1:]), rnd=["r"])


# ------------------------------------------------------------------ D8 / D9 / D10
@query("score_histogram")
def score_histogram(spark, d):
    return finish(D.histogram(T.scored(spark, d), "s1", 50, ["y"]))


sql("score_histogram", """
WITH r AS (SELECT min(s1) AS lo, max(s1) AS hi FROM scored),
     b AS (SELECT y, CAST(least(floor((s1 - lo) / (hi - lo) * 50) + 1, 50) AS BIGINT) AS bin, lo, hi FROM scored, r)
SELECT CAST(y AS BIGINT) AS y, bin, count(*) AS count, min(lo) + (bin - 1) * (min(hi) - min(lo)) / 50 AS bin_lo
FROM b GROUP BY y, bin""", ["scored"], rnd=["bin_lo"])


_PCTS = [0.1, 0.25, 0.5, 0.75, 0.9]
_PNAMES = ["p10", "p25", "p50", "p75", "p90"]


@query("score_percentiles")
def score_percentiles(spark, d):
    return finish(D.percentiles_wide(T.scored(spark, d), "s1", _PCTS, _PNAMES))


sql("score_percentiles", "SELECT " + ", ".join(f"quantile_cont(s1, {p}) AS {n}" for p, n in zip(_PCTS, _PNAMES))
    + " FROM scored", ["scored"], rnd=_PNAMES)


@query("class_conditional_stats")
def class_conditional_stats(spark, d):
    s = T.scored(spark, d)
    basic = s.filter(F.col("s1").isNotNull()).groupBy("y").agg(F.avg("s1").alias("mean_s1"), F.count("s1").alias("n"))
    med = D.percentiles_wide(s, "s1", [0.5], ["median_s1"], by=["y"])
    return finish(basic.join(med, "y"))


sql("class_conditional_stats", """
SELECT CAST(y AS BIGINT) AS y, avg(s1) AS mean_s1, count(s1) AS n, median(s1) AS median_s1
FROM scored WHERE s1 IS NOT NULL GROUP BY y""", ["scored"], rnd=["mean_s1", "median_s1"])


# ------------------------------------------------------------------ S2 / S3 / S4
@query("percentile_filter")
def percentile_filter(spark, d):
    sup = T.load(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("importance"))
    return finish(S.percentile_filter(sup, "importance", 0.2))


sql("percentile_filter", """
SELECT s_suppkey, s_acctbal AS importance FROM supplier
WHERE s_acctbal > (SELECT quantile_cont(s_acctbal, 0.2) FROM supplier)""", rnd=["importance"])


_SEL_ORDER = ["l_extendedprice", "gross", "l_quantity", "qty_tax", "l_discount", "l_tax", "l_linenumber"]


@query("correlated_features")
def correlated_features(spark, d):
    li = T.load(spark, d, "lineitem").select(
        *LI_COLS, (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("gross"),
        (F.col("l_quantity") * (F.lit(1.0) + F.col("l_tax"))).alias("qty_tax"))
    return finish(S.correlated_columns(li, _SEL_ORDER, 0.95))


sql("correlated_features", """
WITH li AS (SELECT *, l_extendedprice * (1.0 - l_discount) AS gross, l_quantity * (1.0 + l_tax) AS qty_tax FROM lineitem),
     p AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, {i} AS ia, '{b}' AS b, corr({b}, {a}) AS r FROM li"
    for i, a in enumerate(_SEL_ORDER) for b in _SEL_ORDER[i + 1:]) + """)
SELECT b AS feature, count(*) AS n_partners, string_agg(a, ',' ORDER BY ia) AS partners
FROM p WHERE abs(r) > 0.95 GROUP BY b""")


# ------------------------------------------------------------------ M1 / M2 / U1
def _orders_labelled(spark, d):
    return T.hist(spark, d).select("u", (F.col("status") == "F").cast("int").alias("y"))


_SQL_FOLDS = """f AS (
  SELECT u, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(CAST(u AS VARCHAR) || ':42'), u) - 1) % 5 AS BIGINT) AS fold
  FROM (SELECT u, CAST(status = 'F' AS INTEGER) AS y FROM hist) o)"""


@query("stratified_folds")
def stratified_folds(spark, d):
    return finish(E.stratified_folds(_orders_labelled(spark, d), "u", "y", 5, 42))


sql("stratified_folds", "SELECT u, CAST(y AS BIGINT) AS y, fold FROM f", ["hist"], ctes=_SQL_FOLDS)


@query("stratified_holdout")
def stratified_holdout(spark, d):
    return finish(E.stratified_holdout(_orders_labelled(spark, d), "u", "y", 0.2, 42))


sql("stratified_holdout", """
SELECT u, CAST(y AS BIGINT) AS y,
       CAST(row_number() OVER (PARTITION BY y ORDER BY md5(CAST(u AS VARCHAR) || ':42'), u) - 1
            < ceil(count(*) OVER (PARTITION BY y) * 0.2) AS BIGINT) AS is_valid
FROM (SELECT u, CAST(status = 'F' AS INTEGER) AS y FROM hist) o""", ["hist"])


@query("union_all_folds")
def union_all_folds(spark, d):
    f = E.stratified_folds(_orders_labelled(spark, d), "u", "y", 5, 42)
    parts = [f.filter(F.col("fold") == i) for i in range(5)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return finish(u.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("y").alias("n_pos")))


sql("union_all_folds", "SELECT fold, count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS n_pos FROM f GROUP BY fold",
    ["hist"], ctes=_SQL_FOLDS)


# ------------------------------------------------------------------ M4 / M5 / M7 / A20 / A19
def _scored_long(spark, d, with_fold=False):
    s = T.scored(spark, d)
    if with_fold:
        folds = E.stratified_folds(_orders_labelled(spark, d), "u", "y", 5, 42).select(
            F.col("u").alias("l_orderkey"), "fold")
        s = s.join(folds, "l_orderkey")
    keep = ["y"] + (["fold"] if with_fold else [])
    return s.select(*keep, *MODELS).unpivot(keep, MODELS, "model", "score")


def _sql_auc(by: str) -> str:
    return f"""r AS (SELECT {by}, y, rank() OVER (PARTITION BY {by} ORDER BY s)
                       + (count(*) OVER (PARTITION BY {by}, s) - 1) / 2.0 AS rk FROM long),
     a AS (SELECT {by}, (sum(rk) FILTER (WHERE y = 1)
                  - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
                  / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)) AS auc
           FROM r GROUP BY {by})"""


_SQL_LONG = "long AS (" + " UNION ALL ".join(f"SELECT '{m}' AS model, y, {m} AS s FROM scored" for m in MODELS) + ")"
_SQL_LONG_FOLD = ("long AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, f.fold, s.y, {m} AS s FROM scored s JOIN f ON s.l_orderkey = f.u" for m in MODELS) + ")")


@query("roc_auc")
def roc_auc(spark, d):
    return finish(E.roc_auc(_scored_long(spark, d), "y", "score", by=["model"]))


sql("roc_auc", "SELECT model, auc FROM a", ["scored"], rnd=["auc"], ctes=_SQL_LONG + ",\n" + _sql_auc("model"))


def _auc_by_fold(spark, d):
    return E.roc_auc(_scored_long(spark, d, with_fold=True), "y", "score", by=["model", "fold"])


@query("auc_by_fold")
def auc_by_fold(spark, d):
    return finish(_auc_by_fold(spark, d))


_SQL_FOLD_AUC = _SQL_FOLDS + ",\n" + _SQL_LONG_FOLD + ",\n" + _sql_auc("model, fold")
sql("auc_by_fold", "SELECT model, fold, auc FROM a", ["hist", "scored"], rnd=["auc"], ctes=_SQL_FOLD_AUC)


@query("model_comparison")
def model_comparison(spark, d):
    a = E.roc_auc(_scored_long(spark, d), "y", "score", by=["model"])
    # the comparison table has one row per model (bounded), so a global rank is fine
    from pyspark.sql import Window
    return finish(a.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("auc"), "model"))))


sql("model_comparison", "SELECT model, auc, row_number() OVER (ORDER BY auc DESC, model) AS rank FROM a",
    ["scored"], rnd=["auc"], ctes=_SQL_LONG + ",\n" + _sql_auc("model"))


@query("fold_metric_summary")
def fold_metric_summary(spark, d):
    return finish(E.fold_summary(_auc_by_fold(spark, d), ["model"], "auc"))


sql("fold_metric_summary", """
SELECT model, avg(auc) AS mean_auc, stddev_pop(auc) AS std_auc, min(auc) AS min_auc, max(auc) AS max_auc,
       count(*) AS n_folds
FROM a GROUP BY model""", ["hist", "scored"], rnd=["mean_auc", "std_auc", "min_auc", "max_auc"], ctes=_SQL_FOLD_AUC)


@query("fold_importance_summary")
def fold_importance_summary(spark, d):
    """Per-fold importance = |r(feature, y)| inside the fold, summarised per feature."""
    s = T.scored(spark, d)
    folds = E.stratified_folds(_orders_labelled(spark, d), "u", "y", 5, 42).select(F.col("u").alias("l_orderkey"), "fold")
    li = T.load(spark, d, "lineitem").select(*T.SCORED_KEYS, "l_quantity", "l_discount", "l_tax")
    j = s.join(folds, "l_orderkey").join(li, T.SCORED_KEYS)
    feats = ["l_quantity", "l_discount", "l_tax", "s1"]
    per_fold = j.groupBy("fold").agg(*[F.abs(D.corr_expr(c, "y")).alias(c) for c in feats])
    long = per_fold.unpivot(["fold"], feats, "feature", "importance")
    return finish(long.groupBy("feature").agg(
        F.avg("importance").alias("importance_mean"), F.stddev_samp("importance").alias("importance_std"),
        F.min("importance").alias("importance_min"), F.max("importance").alias("importance_max")))


_FI_FEATS = ["l_quantity", "l_discount", "l_tax", "s1"]
sql("fold_importance_summary", """
WITH j AS (SELECT f.fold, s.y, s.s1, l.l_quantity, l.l_discount, l.l_tax
           FROM scored s JOIN f ON s.l_orderkey = f.u
           JOIN lineitem l ON s.l_orderkey = l.l_orderkey AND s.l_linenumber = l.l_linenumber
                          AND s.l_partkey = l.l_partkey AND s.l_suppkey = l.l_suppkey
                          AND s.l_extendedprice = l.l_extendedprice),
     pf AS (""" + "\nUNION ALL\n".join(
    f"SELECT fold, '{c}' AS feature, abs(corr(y, {c})) AS importance FROM j GROUP BY fold" for c in _FI_FEATS) + """)
SELECT feature, avg(importance) AS importance_mean, stddev_samp(importance) AS importance_std,
       min(importance) AS importance_min, max(importance) AS importance_max
FROM pf GROUP BY feature""", ["hist", "scored"], ctes=_SQL_FOLDS,
    rnd=["importance_mean", "importance_std", "importance_min", "importance_max"])


# ------------------------------------------------------------------ B2 / B4 / B3 / T6
_W = [0.75, 0.15, 0.10]


@query("blend_scores")
def blend_scores(spark, d):
    return finish(B.blend(T.scored(spark, d), MODELS, _W).select(*T.SCORED_KEYS, "y", "blend"))


sql("blend_scores", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CAST(y AS BIGINT) AS y, 0.75 * s1 + 0.15 * s2 + 0.1 * s3 AS blend
FROM scored""", ["scored"], rnd=["l_extendedprice", "blend"])


@query("fold_average_scores")
def fold_average_scores(spark, d):
    """Per-row mean over the model scores (the test-set average of k fold models)."""
    s = T.scored(spark, d)
    long = s.select(*T.SCORED_KEYS, *MODELS).unpivot(T.SCORED_KEYS, MODELS, "model", "score")
    return finish(long.groupBy(*T.SCORED_KEYS).agg(F.avg("score").alias("avg_score"),
                                                   F.count(F.lit(1)).alias("n_models")))


sql("fold_average_scores", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       avg(score) AS avg_score, count(*) AS n_models
FROM (""" + " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, {m} AS score FROM scored" for m in MODELS)
    + """) t GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice""", ["scored"],
    rnd=["l_extendedprice", "avg_score"])


_WN = ["w_s1", "w_s2", "w_s3"]


def _blend_grid(spark, d):
    return B.blend_grid_auc(T.scored(spark, d), "y", MODELS, _WN, 20)


@query("blend_grid")
def blend_grid(spark, d):
    return finish(_blend_grid(spark, d))


_SQL_GRID = """g AS (SELECT CAST(i AS DOUBLE) / 20.0::DOUBLE AS w_s1, CAST(j AS DOUBLE) / 20.0::DOUBLE AS w_s2,
                CAST(20 - i - j AS DOUBLE) / 20.0::DOUBLE AS w_s3
         FROM range(0, 21) a(i), range(0, 21) b(j) WHERE i + j <= 20),
     bl AS (SELECT w_s1, w_s2, w_s3, y, w_s1 * s1 + w_s2 * s2 + w_s3 * s3 AS s FROM scored, g),
     r AS (SELECT w_s1, w_s2, w_s3, y,
                  rank() OVER (PARTITION BY w_s1, w_s2, w_s3 ORDER BY s)
                  + (count(*) OVER (PARTITION BY w_s1, w_s2, w_s3, s) - 1) / 2.0 AS rk FROM bl),
     a AS (SELECT w_s1, w_s2, w_s3, (sum(rk) FILTER (WHERE y = 1)
                  - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
                  / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)) AS auc
           FROM r GROUP BY w_s1, w_s2, w_s3)"""
sql("blend_grid", "SELECT w_s1, w_s2, w_s3, auc FROM a", ["scored"], ctes=_SQL_GRID,
    rnd=["w_s1", "w_s2", "w_s3", "auc"])


@query("blend_best")
def blend_best(spark, d):
    return finish(B.best_row(_blend_grid(spark, d), "auc", _WN))


sql("blend_best", "SELECT w_s1, w_s2, w_s3, auc FROM a ORDER BY auc DESC, w_s1 DESC, w_s2 DESC, w_s3 DESC LIMIT 1",
    ["scored"], ctes=_SQL_GRID, rnd=["w_s1", "w_s2", "w_s3", "auc"])


# ------------------------------------------------------------------ B5 (gain of the blend over the best single model)
@query("blend_gain")
def blend_gain(spark, d):
    s = B.blend(T.scored(spark, d), MODELS, _W)
    long = s.select("y", *MODELS, "blend").unpivot(["y"], MODELS + ["blend"], "model", "score")
    a = E.roc_auc(long, "y", "score", by=["model"])
    one = a.agg(F.max(F.when(F.col("model") == "blend", F.col("auc"))).alias("blend_auc"),
                F.max(F.when(F.col("model") != "blend", F.col("auc"))).alias("best_single_auc"),
                F.max_by(F.when(F.col("model") != "blend", F.col("model")),
                         F.when(F.col("model") != "blend", F.col("auc"))).alias("best_single_model"))
    return finish(one.withColumn("gain", F.col("blend_auc") - F.col("best_single_auc")))


sql("blend_gain", """
SELECT max(auc) FILTER (WHERE model = 'blend') AS blend_auc,
       max(auc) FILTER (WHERE model <> 'blend') AS best_single_auc,
       arg_max(model, auc) FILTER (WHERE model <> 'blend') AS best_single_model,
       max(auc) FILTER (WHERE model = 'blend') - max(auc) FILTER (WHERE model <> 'blend') AS gain
FROM a""", ["scored"], rnd=["blend_auc", "best_single_auc", "gain"],
    ctes="long AS (" + " UNION ALL ".join(f"SELECT '{m}' AS model, y, {m} AS s FROM scored" for m in MODELS)
    + " UNION ALL SELECT 'blend' AS model, y, 0.75 * s1 + 0.15 * s2 + 0.1 * s3 AS s FROM scored),\n" + _sql_auc("model"))


# ------------------------------------------------------------------ D6 capped / M14 / D7 wide
@query("box_stats_capped")
def box_stats_capped(spark, d):
    return finish(D.box_stats(T.hist(spark, d), "amt", ["status"], below=200000.0))


ORACLE_CAP = ORACLE["box_stats"].replace("FROM orders)", "FROM orders WHERE o_totalprice < 200000.0)")
sql("box_stats_capped", ORACLE_CAP, rnd=["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])


@query("top_importance")
def top_importance(spark, d):
    """The two features of largest mean importance, ties by name."""
    return finish(fold_importance_summary(spark, d).orderBy(F.desc("importance_mean"), "feature").limit(2)
                  .select("feature", "importance_mean"))


sql("top_importance", "SELECT feature, importance_mean FROM (" + ORACLE["fold_importance_summary"]
    + ") t ORDER BY importance_mean DESC, feature LIMIT 2", rnd=["importance_mean"])


N_WIDE = 80


def wide_columns(spark, d):
    """80 derived columns in which every row has NULLs."""
    li = T.load(spark, d, "lineitem")
    cols = [F.when((F.col("l_orderkey") + i) % 5 != 0, F.col("l_quantity") * (i % 7) + F.col("l_discount") * (10 * (i % 11))
                   + F.col("l_linenumber") * (i % 3)).alias(f"v{i}") for i in range(1, N_WIDE + 1)]
    return li.select(*cols)


@query("wide_correlation")
def wide_correlation(spark, d):
    """All 3,160 pairs of the 80 columns, pairwise complete."""
    return finish(D.corr_pairs(wide_columns(spark, d), [f"v{i}" for i in range(1, N_WIDE + 1)]))


sql("wide_correlation", """
SELECT 'v' || x.i AS a, 'v' || y.i AS b, CASE WHEN var_pop(x.v) > 0 AND var_pop(y.v) > 0 THEN corr(x.v, y.v) END AS r
FROM long x JOIN long y ON x.k = y.k AND x.i < y.i GROUP BY x.i, y.i
""", ctes="""li AS (SELECT row_number() OVER () AS k, l_orderkey, l_quantity, l_discount, l_linenumber FROM lineitem),
long AS (
  SELECT k, i, l_quantity * (i % 7) + l_discount * (10 * (i % 11)) + l_linenumber * (i % 3) AS v
  FROM li, (SELECT unnest(range(1, 81)) AS i) WHERE (l_orderkey + i) % 5 <> 0)""", rnd=["r"])
