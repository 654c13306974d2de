"""Splits and score evaluation: stratified folds / hold-out, exact ROC-AUC,
ROC points, per-fold summaries, class weights.

Exact AUC (ties count one half):

    AUC = Σ_s pos(s) · (neg(< s) + neg(s)/2) / (P · N)

over distinct scores s. Rows are first aggregated to distinct scores (partial
aggregation, so a score value shared by a third of all rows is cheap); the
running count of negatives below each score uses the prefix tree of
``prefix.py`` instead of a single-task global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import safe_div
from ledgerlens.operators.prefix import pairs_below, prefix_before, prefix_tree, quantile_bucketed


def fold_hash(id_col: str, seed: int) -> Column:
    """Deterministic shuffle key (same md5 in Spark and DuckDB)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def _class_positions(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    """0-based position of each row within its class in (md5(id:seed), id) order,
    via 4096 hash-prefix buckets (bounded: classes x 4096 totals)."""
    h = fold_hash(id_col, seed)
    d = df.withColumn("_h", h)
    return prefix_before(d, [label], [F.col("_h"), F.col(id_col)], F.substring("_h", 1, 3),
                         {"_pos": F.lit(1)}, broadcast_totals=True).drop("_h")


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """fold = (position within class) mod k: every fold gets the same class mix (±1)."""
    d = _class_positions(df, id_col, label, seed)
    return d.withColumn(out, (F.col("_pos") % F.lit(k)).cast("int")).drop("_pos")


def stratified_holdout(df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 42,
                       out: str = "is_valid") -> DataFrame:
    """Per class, the first ceil(share · n_class) rows in hash order are held out."""
    d = _class_positions(df, id_col, label, seed)
    n_cls = df.groupBy(label).agg(F.count(F.lit(1)).alias("_ncls"))
    d = d.join(F.broadcast(n_cls), label)          # one row per class: bounded
    return d.withColumn(out, (F.col("_pos") < F.ceil(F.col("_ncls") * F.lit(test_share))).cast("int")) \
        .drop("_pos", "_ncls")


def _score_table(df: DataFrame, label: str | None, score, by: Sequence[str], counts: tuple[str, str] | None = None) -> DataFrame:
    s = F.col(score) if isinstance(score, str) else score
    if counts:      # rows that stand for several: (positives, negatives)
        pos, neg = counts
        return (df.select(*by, s.cast("double").alias("_s"), F.col(pos).alias("_p"), F.col(neg).alias("_n"))
                  .filter(F.col("_s").isNotNull()).groupBy(*by, "_s").agg(F.sum("_p").alias("_pos"), F.sum("_n").alias("_neg")))
    y = F.col(label).cast("long")
    return (df.select(*by, s.cast("double").alias("_s"), y.alias("_y"))
              .filter(F.col("_s").isNotNull() & F.col("_y").isNotNull())
              .groupBy(*by, "_s")
              .agg(F.sum("_y").alias("_pos"), F.sum(F.lit(1) - F.col("_y")).alias("_neg")))


def roc_auc(df: DataFrame, label: str | None, score, by: Sequence[str] = (), out: str = "auc",
            n_buckets: int | None = None, counts: tuple[str, str] | None = None) -> DataFrame:
    """Exact ROC-AUC per group (one row per group; one row overall when ``by`` is empty).

    The numerator is counted level by level in the prefix tree of the scores. With
    ``n_buckets`` scores are cut into that many quantile buckets instead, and it splits into
      * within-bucket pairs: a window partitioned by (group, bucket), and
      * cross-bucket pairs: Σ_b pos(b) · neg(buckets below b), from the tiny
        (group, bucket) totals table,
    so no row-level join back of bucket offsets is needed.
    """
    by = list(by)
    keys = by or ["_g"]
    t = _score_table(df, label, score, by, counts)
    if not by:
        t = t.withColumn("_g", F.lit(0))
    if n_buckets is None:
        p = pairs_below(t, keys, "_s", "_pos", "_neg")
        return p.select(*by, safe_div(F.col("pairs"), F.col("high").cast("double") * F.col("low")).alias(out))
    t = quantile_bucketed(t, "_s", n_buckets, out="_qb")
    w_in = Window.partitionBy(*keys, "_qb").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    within = (t.withColumn("_nb", F.coalesce(F.sum("_neg").over(w_in), F.lit(0)))
               .groupBy(*keys).agg(
                   F.sum(F.col("_pos").cast("double") * (F.col("_nb") + F.col("_neg") / F.lit(2.0))).alias("_num_in"),
                   F.sum("_pos").cast("double").alias("_P"), F.sum("_neg").cast("double").alias("_N")))
    tot = t.groupBy(*keys, "_qb").agg(F.sum("_pos").alias("_bp"), F.sum("_neg").alias("_bn"))
    w_b = Window.partitionBy(*keys).orderBy("_qb").rowsBetween(Window.unboundedPreceding, -1)
    cross = (tot.withColumn("_nbb", F.coalesce(F.sum("_bn").over(w_b), F.lit(0)))
                .groupBy(*keys).agg(F.sum(F.col("_bp").cast("double") * F.col("_nbb")).alias("_num_x")))
    res = within.join(cross, keys)
    return res.select(*by, safe_div(F.col("_num_in") + F.col("_num_x"), F.col("_P") * F.col("_N")).alias(out))


def roc_points(df: DataFrame, label: str, score, by: Sequence[str] = ()) -> DataFrame:
    """One ROC point per distinct score threshold s (predict positive when score >= s)."""
    by = list(by)
    t = prefix_tree(_score_table(df, label, score, by), by, "_s",
                    {"_neg_before": F.col("_neg"), "_pos_before": F.col("_pos")})
    keys = by or ["_g"]
    if not by:
        t = t.withColumn("_g", F.lit(0))
    totals = t.groupBy(*keys).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    # one row per group; the group-less case is a single row (bounded)
    t = t.join(F.broadcast(totals) if not by else totals, keys)
    tp = F.col("_P") - F.col("_pos_before")
    fp = F.col("_N") - F.col("_neg_before")
    return t.select(*by, F.col("_s").alias("threshold"),
                    tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
                    safe_div(tp, F.col("_P")).alias("tpr"), safe_div(fp, F.col("_N")).alias("fpr"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """'balanced' weights N / (2 · N_c) per class."""
    w = Window.partitionBy()  # over the two-row class table only
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    return c.select(label, "n_class", safe_div(F.sum("n_class").over(w), F.lit(2) * F.col("n_class")).alias("weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label)           # one row per class: bounded


def fold_summary(metrics: DataFrame, by: Sequence[str], value: str = "auc") -> DataFrame:
    """mean and population std of a per-fold metric (np.mean / np.std)."""
    return metrics.groupBy(*by).agg(
        F.avg(value).alias(f"mean_{value}"), F.stddev_pop(value).alias(f"std_{value}"),
        F.min(value).alias(f"min_{value}"), F.max(value).alias(f"max_{value}"),
        F.count(F.lit(1)).alias("n_folds"))
