"""Catalogue part 5: training (M3, M8-M10, M12, S1). Linear models are MLlib's;
boosting is ``operators/boosting.py``, the forest ``operators/forest.py``. Scores of fitted models are
not SQL; what SQL can say of them (the first split's gains of every fold) has an
oracle in ``split_gains``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import boosting as B, evaluate as E, model as M
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import finish, query
from ledgerlens.session import cut_lineage, written
from ledgerlens.sources import tables as T

FEATS = ["s1", "s2", "s3"]


def _train(spark, d, k: int):
    s = T.scored_with_id(spark, d)
    return cut_lineage(E.stratified_folds(s, "rid", "y", k, 42))      # read three times by each fit


def _folds(df, k: int, features=FEATS, **params) -> B.Boosted:
    """One model per fold, ended on the fold it leaves out; rounds, depth and step are the operator's surveyed defaults."""
    return B.fit(df, features, "y", "rid", [B.Params(fold=i, **params) for i in range(k)], "fold")


@query("logistic_fit")
def logistic_fit(spark, d):
    return finish(M.fit_predict(T.scored(spark, d), FEATS, "y", "logistic", T.SCORED_KEYS))


@query("forest_fit")
def forest_fit(spark, d):
    return finish(M.fit_predict(T.scored(spark, d), FEATS, "y", "forest", T.SCORED_KEYS))


@query("oof_scores")
def oof_scores(spark, d):
    s = _train(spark, d, 5)
    return finish(B.out_of_fold(s, _folds(s, 5), "fold", [*T.SCORED_KEYS, "y"]))


@query("gbt_importance")
def gbt_importance(spark, d):
    """Gain importance per fold (3 folds), from the ledger of splits, summarised per feature, sorted desc."""
    b = _folds(_train(spark, d, 3), 3)
    t = spark.createDataFrame(b.importances(), "fold int, feature string, importance double")
    return finish(t.groupBy("feature").agg(
        F.avg("importance").alias("importance_mean"), F.stddev_samp("importance").alias("importance_std"),
        F.min("importance").alias("importance_min"), F.max("importance").alias("importance_max"))
        .orderBy(F.desc("importance_mean")))


@query("split_gains")
def split_gains(spark, d):
    """The ledger's first splits: per fold the feature and gain at the root of
    the first tree, one model for each feature alone."""
    s = _train(spark, d, 3)
    rows = []
    for f in FEATS:
        b = B.fit(s, [f], "y", "rid", [B.Params(fold=i, rounds=1, leaves=2, lambda_=1.0) for i in range(3)], "fold", accuracy=1_000_000)
        rows += [(m.params.fold, f, gain, n) for m in b.models for _, _, _, gain, n in m.ledger]
    return finish(spark.createDataFrame(rows, "fold int, feature string, gain double, n_rows long"))


def _root_gain_sql(f: str) -> str:
    """Best split of one feature by quantile bins, from class counts below each edge."""
    return f"""
  SELECT fold, '{f}' AS feature, max(pow(gl, 2) / (hl + 1.0) + pow(g - gl, 2) / (h - hl + 1.0) - pow(g, 2) / (h + 1.0)) AS gain, any_value(n) AS n_rows
  FROM (
    SELECT t.fold, t.n, (t.n - t.p) * g0 + t.p * g1 AS g, t.n * h0 AS h, (c.n - c.p) * g0 + c.p * g1 AS gl, c.n * h0 AS hl, c.n AS nl
    FROM tot t JOIN (
      SELECT v.fold, e.edge, count(*) AS n, sum(y) AS p
      FROM rows_ v JOIN (SELECT DISTINCT unnest(quantile_disc({f}, {[k / 64 for k in range(1, 64)]})) AS edge FROM scored) e ON v.{f} <= e.edge
      GROUP BY v.fold, e.edge) c ON c.fold = t.fold)
  WHERE nl >= 20 AND n - nl >= 20 GROUP BY fold"""


# gradients and hessians at the base margin are multiples of 2**-20, as in the operator
sql("split_gains", f"""
SELECT fold, feature, gain, n_rows FROM ({" UNION ALL ".join(_root_gain_sql(f) for f in FEATS)}) WHERE gain > 1e-9
""", adapters=["scored"], rnd=["gain"], ctes="""f AS (
  SELECT *, (row_number() OVER (PARTITION BY y ORDER BY md5(rid || ':42'), rid) - 1) % 3 AS own FROM (
    SELECT *, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rid FROM scored)),
rows_ AS (SELECT k.fold, f.* FROM f, (SELECT unnest([0, 1, 2]) AS fold) k WHERE own <> k.fold),
tot AS (
  SELECT *, round(q * 1048576) / 1048576.0::DOUBLE AS g0, round((q - 1) * 1048576) / 1048576.0::DOUBLE AS g1,
         round(q * (1 - q) * 1048576) / 1048576.0::DOUBLE AS h0
  FROM (SELECT fold, count(*) AS n, sum(y) AS p, sum(y)::DOUBLE / count(*)::DOUBLE AS q FROM rows_ GROUP BY fold))""")


#: the surveyed space (fixed values of SURVEY 2.16), every parameter of it
SPACE = {"leaves": ("int", 20, 80), "depth": ("int", 6, 15), "rate": ("log", 0.01, 0.05), "column_share": ("float", 0.6, 0.95),
         "row_share": ("float", 0.6, 0.95), "row_every": ("int", 1, 7), "least_rows": ("int", 30, 150),
         "least_hessian": ("log", 0.001, 0.1), "alpha": ("float", 0.0, 2.0), "lambda_": ("float", 0.0, 20.0),
         "positive_weight": ("float", 8.0, 14.0)}


def search_trials(spark, df, n_trials: int = 100, folds: int = 3, rounds: int = 2000, patience: int = 50, space=None, seed: int = 42):
    """The trial table: parameters, rounds and mean fold AUC of ``n_trials`` draws.
    All trials and folds grow together; the AUCs of all come from one pass over
    their out-of-fold scores."""
    drawn = M.sample_params(space or SPACE, n_trials, seed)
    models = [B.Params(fold=i, rounds=rounds, patience=patience, seed=seed + t, **p) for t, p in enumerate(drawn) for i in range(folds)]
    b = B.fit(df, FEATS, "y", F.col("rid_hash") if "rid_hash" in df.columns else "rid", models, "fold")
    # rows of the same bins have the same scores, so they are scored once and counted
    cells = (B.cell_counts(df.filter(F.col("y").isNotNull()), b, ["fold", "y"]).groupBy("x", "fold")
             .agg(F.sum(F.col("n") * F.col("y")).alias("pos"), F.sum(F.col("n") * (F.lit(1) - F.col("y"))).alias("neg"))
             .repartition(4 * spark.sparkContext.defaultParallelism, "x"))
    # of a cell's scores only those of the models that left its fold out: one per trial
    scores = (B.predict_cells(cells, b, ["fold", "pos", "neg"]).select("fold", "pos", "neg", F.posexplode("scores").alias("k", "score"))
              .filter(F.col("k") % folds == F.col("fold")))
    auc = (E.roc_auc(scores.withColumn("trial", F.expr(f"k div {folds}").cast("int")), None, "score", by=["trial", "fold"], counts=("pos", "neg"))
           .groupBy("trial").agg(F.avg("auc").alias("mean_auc")))
    names = list(drawn[0])
    rows = [(t, *[float(p[n]) for n in names], sum(b.models[folds * t + i].best for i in range(folds)) / folds) for t, p in enumerate(drawn)]
    return spark.createDataFrame(rows, "trial int, " + ", ".join(f"{n.rstrip('_')} double" for n in names) + ", mean_rounds double").join(auc, "trial")


@query("random_search")
def random_search(spark, d):
    """100 trials over the whole search space, each fold's boosting ended after 50 rounds without gain."""
    s = E.stratified_folds(T.scored_with_id(spark, d).select("rid", "y", *FEATS), "rid", "y", 3, 42)
    t = search_trials(spark, written(s.select(F.xxhash64("rid").alias("rid_hash"), "y", "fold", *FEATS), "search-rows"))
    # the trial table has n_trials rows (bounded), so an ordered window over it is fine
    return finish(t.withColumn("best_so_far", F.max("mean_auc").over(
        Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, 0))))


@query("test_average")
def test_average(spark, d):
    """Fold models with early stopping on their left-out fold; mean score on the held-out rows."""
    s = E.stratified_holdout(T.scored_with_id(spark, d), "rid", "y", 0.2, 42)
    s = cut_lineage(s)
    b = _folds(cut_lineage(E.stratified_folds(s.filter("is_valid = 0").drop("is_valid"), "rid", "y", 3, 42)), 3)
    out = B.predict(s.filter("is_valid = 1"), b, [*T.SCORED_KEYS, "y"])
    mean = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) / F.size("scores")
    return finish(out.select(*T.SCORED_KEYS, "y", mean.alias("score")))


@query("selected_retrain")
def selected_retrain(spark, d):
    """Importance filter, correlation filter, retrained fold models; scores carry the chosen features."""
    s = _train(spark, d, 3).withColumn("s1_copy", F.col("s1") * 2 + 1).withColumn("flat", F.lit(0.0))
    feats = [*FEATS, "s1_copy", "flat"]
    chosen = M.select_features(s, _folds(s, 3, feats).importances()) or feats
    out = B.out_of_fold(s, _folds(s, 3, chosen), "fold", [*T.SCORED_KEYS, "y"])
    return finish(out.withColumn("features", F.lit(",".join(chosen))))
