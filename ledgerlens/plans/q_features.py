"""Catalogue part 3: row features (F1-F16) and preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators import prep as P, rollup as R
from ledgerlens.operators.joins import spine_join
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import finish, query
from ledgerlens.sources import tables as T

EXT = ["ext1", "ext2", "ext3"]


def _hagg(spark, d):
    return R.rollup(T.hist(spark, d), "id", [
        F.min("day").alias("day_min"), F.sum("amt").alias("amt_sum"), F.avg("amt").alias("amt_mean"),
        F.max("amt").alias("amt_max"), F.count(F.lit(1)).alias("n_loans"),
        X.sum0(F.when(F.col("status") == "O", F.col("amt")).otherwise(F.lit(0.0))).alias("open_sum"),
    ])


_SQL_HAGG = """hagg AS (
  SELECT id, min(day) AS day_min, sum(amt) AS amt_sum, avg(amt) AS amt_mean, max(amt) AS amt_max,
         count(*) AS n_loans, sum(CASE WHEN status = 'O' THEN amt ELSE 0.0 END) AS open_sum
  FROM hist GROUP BY id)"""


def _spine_h(spark, d):
    return spine_join(T.spine(spark, d), [_hagg(spark, d)], "id")


# ------------------------------------------------------------------ F1 / F2
@query("row_features_basic")
def row_features_basic(spark, d):
    s = _spine_h(spark, d)
    return finish(s.select(
        "id",
        X.days_to_years("day_min").alias("AGE_YEARS"),
        X.safe_div("income", "amt_sum").alias("INCOME_CREDIT_RATIO"),
        X.safe_div("amt_mean", "income").alias("ANNUITY_INCOME_RATIO"),
        X.safe_div("amt_sum", "amt_max").alias("CREDIT_GOODS_RATIO"),
    ))


sql("row_features_basic", """
SELECT s.id, -CAST(day_min AS DOUBLE) / 365.0 AS AGE_YEARS,
       income / nullif(amt_sum, 0) AS INCOME_CREDIT_RATIO,
       amt_mean / nullif(income, 0) AS ANNUITY_INCOME_RATIO,
       amt_sum / nullif(amt_max, 0) AS CREDIT_GOODS_RATIO
FROM spine s LEFT JOIN hagg h ON s.id = h.id""", ["spine", "hist"], ctes=_SQL_HAGG,
    rnd=["AGE_YEARS", "INCOME_CREDIT_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_GOODS_RATIO"])


# ------------------------------------------------------------------ F3
@query("smoothed_ratio")
def smoothed_ratio(spark, d):
    s = _spine_h(spark, d).fillna(0, subset=["n_loans"])
    return finish(s.select(
        "id",
        X.smooth_div("income", "n_loans").alias("INCOME_PER_LOAN"),
        X.smooth_div("acctbal", "n_loans").alias("AVG_CREDIT_PER_LOAN"),
        X.smooth_div("income", "region").alias("INCOME_PER_REGION_MEMBER"),
    ))


sql("smoothed_ratio", """
SELECT s.id, income / (coalesce(n_loans, 0) + 1.0) AS INCOME_PER_LOAN,
       acctbal / (coalesce(n_loans, 0) + 1.0) AS AVG_CREDIT_PER_LOAN,
       income / nullif(region + 1.0, 0) AS INCOME_PER_REGION_MEMBER
FROM spine s LEFT JOIN hagg h ON s.id = h.id""", ["spine", "hist"], ctes=_SQL_HAGG,
    rnd=["INCOME_PER_LOAN", "AVG_CREDIT_PER_LOAN", "INCOME_PER_REGION_MEMBER"])


# ------------------------------------------------------------------ F4
@query("row_stats")
def row_stats(spark, d):
    s = T.spine(spark, d)
    return finish(s.select("id", X.row_mean(*EXT).alias("EXT_SOURCE_MEAN"), X.row_max(*EXT).alias("EXT_SOURCE_MAX"),
                           X.row_min(*EXT).alias("EXT_SOURCE_MIN")))


sql("row_stats", """
SELECT id, list_avg(list_value(ext1, ext2, ext3)) AS EXT_SOURCE_MEAN,
       list_max(list_value(ext1, ext2, ext3)) AS EXT_SOURCE_MAX,
       list_min(list_value(ext1, ext2, ext3)) AS EXT_SOURCE_MIN
FROM spine""", ["spine"], rnd=["EXT_SOURCE_MEAN", "EXT_SOURCE_MAX", "EXT_SOURCE_MIN"])


# ------------------------------------------------------------------ F5 / F11 / F6 / F7 / F8
@query("interaction_features")
def interaction_features(spark, d):
    s = _spine_h(spark, d)
    mean = X.fill(X.row_mean(*EXT), 0.5)
    return finish(s.select(
        "id", X.product(*EXT).alias("EXT_SOURCE_PROD"),
        (mean * X.safe_log1p("income")).alias("EXT_SOURCE_INCOME_INTERACTION"),
        (mean * X.safe_log1p("amt_sum")).alias("EXT_SOURCE_CREDIT_INTERACTION"),
    ))


sql("interaction_features", """
SELECT s.id, ext1 * ext2 * ext3 AS EXT_SOURCE_PROD,
       coalesce(list_avg(list_value(ext1, ext2, ext3)), 0.5) * ln(1 + income) AS EXT_SOURCE_INCOME_INTERACTION,
       coalesce(list_avg(list_value(ext1, ext2, ext3)), 0.5) * ln(1 + amt_sum) AS EXT_SOURCE_CREDIT_INTERACTION
FROM spine s LEFT JOIN hagg h ON s.id = h.id""", ["spine", "hist"], ctes=_SQL_HAGG,
    rnd=["EXT_SOURCE_PROD", "EXT_SOURCE_INCOME_INTERACTION", "EXT_SOURCE_CREDIT_INTERACTION"])


@query("weighted_score")
def weighted_score(spark, d):
    s = T.spine(spark, d)
    return finish(s.select("id", X.weighted_sum0({"ext1": 0.4, "ext2": 0.4, "ext3": 0.2}).alias("EXT_SOURCE_WEIGHTED")))


sql("weighted_score", """
SELECT id, 0.4 * coalesce(ext1, 0) + 0.4 * coalesce(ext2, 0) + 0.2 * coalesce(ext3, 0) AS EXT_SOURCE_WEIGHTED
FROM spine""", ["spine"], rnd=["EXT_SOURCE_WEIGHTED"])


@query("flag_count")
def flag_count(spark, d):
    s = T.spine(spark, d)
    flags = [X.flag(F.col(c).isNotNull()) for c in EXT + ["income"]]
    return finish(s.select("id", X.row_sum0(*flags).alias("CONTACT_INFO_COUNT")))


sql("flag_count", """
SELECT id, CAST((ext1 IS NOT NULL)::INT + (ext2 IS NOT NULL)::INT + (ext3 IS NOT NULL)::INT
                + (income IS NOT NULL)::INT AS BIGINT) AS CONTACT_INFO_COUNT
FROM spine""", ["spine"])


@query("nonlinear_transforms")
def nonlinear_transforms(spark, d):
    s = T.spine(spark, d)
    cols = []
    for c in EXT:
        v = X.fill(c, 0.0)
        cols += [F.pow(v, 2).alias(f"{c}_SQUARED"), F.pow(v, 3).alias(f"{c}_CUBED"),
                 X.safe_sqrt(v).alias(f"{c}_SQRT"), X.safe_log1p(v).alias(f"{c}_LOG")]
    return finish(s.select("id", *cols))


_NL = [f"{c}_{k}" for c in EXT for k in ("SQUARED", "CUBED", "SQRT", "LOG")]
sql("nonlinear_transforms", "SELECT id, " + ", ".join(
    f"pow(coalesce({c}, 0), 2) AS {c}_SQUARED, pow(coalesce({c}, 0), 3) AS {c}_CUBED, "
    f"sqrt(coalesce({c}, 0)) AS {c}_SQRT, ln(1 + coalesce({c}, 0)) AS {c}_LOG" for c in EXT) + " FROM spine",
    ["spine"], rnd=_NL)


# ------------------------------------------------------------------ F9 / F10
@query("clip_score")
def clip_score(spark, d):
    s = _spine_h(spark, d)
    ins = T.inst(spark, d).withColumn("late", X.flag(F.col("entry_day") - F.col("due_day") > 0))
    late = R.rollup(ins, "id", [F.avg("late").alias("late_mean")])
    s = s.join(late, "id", "left")
    ext = X.fill(X.row_mean(*EXT), 0.5)
    age = X.days_to_years("day_min")
    ann = X.ieee_div("amt_mean", "income")
    debt = X.ieee_div("open_sum", "amt_sum")
    r1 = F.lit(0.5) * ext + F.lit(0.3) * (age / F.lit(100.0)) + F.lit(0.2) * (F.lit(1.0) - X.fill(X.clip(ann, 0.0, 1.0), 0.2))
    r2 = (F.lit(0.4) * ext + F.lit(0.3) * (F.lit(1.0) - X.fill(X.clip(debt, 0.0, 1.0), 0.3))
          + F.lit(0.3) * (F.lit(1.0) - X.fill(X.clip("late_mean", 0.0, 1.0), 0.0)))
    return finish(s.select("id", r1.alias("RISK_SCORE_1"), r2.alias("RISK_SCORE_2")))


sql("clip_score", """
WITH lt AS (SELECT id, avg(CASE WHEN entry_day - due_day > 0 THEN 1 ELSE 0 END) AS late_mean FROM inst GROUP BY id),
     b AS (SELECT s.id, coalesce(list_avg(list_value(ext1, ext2, ext3)), 0.5) AS ext,
                  -CAST(day_min AS DOUBLE) / 365.0 AS age,
                  CASE WHEN isnan(amt_mean / income) THEN NULL ELSE amt_mean / income END AS ann,
                  CASE WHEN isnan(open_sum / amt_sum) THEN NULL ELSE open_sum / amt_sum END AS debt,
                  late_mean
           FROM spine s LEFT JOIN hagg h ON s.id = h.id LEFT JOIN lt ON s.id = lt.id)
SELECT id,
       0.5 * ext + 0.3 * (age / 100.0) + 0.2 * (1.0 - coalesce(CASE WHEN ann IS NULL THEN NULL ELSE greatest(least(ann, 1.0), 0.0) END, 0.2))
         AS RISK_SCORE_1,
       0.4 * ext + 0.3 * (1.0 - coalesce(CASE WHEN debt IS NULL THEN NULL ELSE greatest(least(debt, 1.0), 0.0) END, 0.3))
         + 0.3 * (1.0 - coalesce(CASE WHEN late_mean IS NULL THEN NULL ELSE greatest(least(late_mean, 1.0), 0.0) END, 0.0))
         AS RISK_SCORE_2
FROM b""", ["spine", "hist", "inst"], ctes=_SQL_HAGG, rnd=["RISK_SCORE_1", "RISK_SCORE_2"])


# ------------------------------------------------------------------ F13
@query("sentinel_flag")
def sentinel_flag(spark, d):
    li = T.load(spark, d, "lineitem").select(*T.SCORED_KEYS, "l_quantity")
    return finish(li.select(*T.SCORED_KEYS, X.sentinel_flag("l_quantity", 50.0).alias("QTY_ANOMALY"),
                            X.null_if_sentinel("l_quantity", 50.0).alias("QTY_CLEAN")))


sql("sentinel_flag", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CAST(l_quantity = 50 AS BIGINT) AS QTY_ANOMALY, nullif(l_quantity, 50) AS QTY_CLEAN
FROM lineitem""", rnd=["l_extendedprice", "QTY_CLEAN"])


# ------------------------------------------------------------------ F15 / E5 / F16 / E9
@query("fill_constants")
def fill_constants(spark, d):
    s = T.spine(spark, d).select("id", "income", *EXT)
    return finish(P.fill_constants(s, {"income": 0.0, "ext1": 0.5, "ext2": 0.5, "ext3": 0.5}))


sql("fill_constants", """
SELECT id, coalesce(income, 0.0) AS income, coalesce(ext1, 0.5) AS ext1, coalesce(ext2, 0.5) AS ext2,
       coalesce(ext3, 0.5) AS ext3
FROM spine""", ["spine"], rnd=["income", "ext1", "ext2", "ext3"])


@query("inf_to_null")
def inf_to_null(spark, d):
    s = T.spine(spark, d)
    s = s.withColumn("_r", X.ieee_div("acctbal", "region"))
    return finish(s.select("id", X.flag(F.col("_r").isin(X.INF, -X.INF)).alias("IS_INF"),
                           X.fill(X.inf_to_null("_r"), 0.0).alias("RATIO_CLEAN")))


sql("inf_to_null", """
SELECT id, CAST(coalesce(isinf(acctbal / region), false) AS BIGINT) AS IS_INF,
       coalesce(CASE WHEN isinf(acctbal / region) OR isnan(acctbal / region) THEN NULL ELSE acctbal / region END, 0.0)
         AS RATIO_CLEAN
FROM spine""", ["spine"], rnd=["RATIO_CLEAN"])


# ------------------------------------------------------------------ E1 / E4 / A18 / E3
_IMP = ["income", "ext1", "ext2", "ext3"]


@query("median_impute")
def median_impute(spark, d):
    s = T.spine(spark, d).select("id", *_IMP).withColumn("is_test", P.hash_split("id"))
    stats = P.fit_medians(s.filter(F.col("is_test") == 0), _IMP)
    return finish(P.apply_medians(s, stats, _IMP))


sql("median_impute", """
WITH s AS (SELECT *, CAST(substr(md5(CAST(id AS VARCHAR)), 1, 1) < '4' AS BIGINT) AS is_test FROM spine),
     m AS (SELECT median(income) AS mi, median(ext1) AS m1, median(ext2) AS m2, median(ext3) AS m3 FROM s WHERE is_test = 0)
SELECT id, is_test, coalesce(income, mi) AS income, coalesce(ext1, m1) AS ext1, coalesce(ext2, m2) AS ext2,
       coalesce(ext3, m3) AS ext3
FROM s, m""", ["spine"], rnd=["income", "ext1", "ext2", "ext3"])


@query("missing_indicators")
def missing_indicators(spark, d):
    s = T.spine(spark, d).select("id", *_IMP)
    return finish(P.missing_indicators(s, _IMP).drop(*_IMP))


sql("missing_indicators", "SELECT id, " + ", ".join(
    f"CAST({c} IS NULL AS BIGINT) AS {c}_MISSING" for c in _IMP) + " FROM spine", ["spine"])


@query("group_median_impute")
def group_median_impute(spark, d):
    s = T.spine(spark, d).select("id", "region", "income")
    stats = P.fit_medians(s, ["income"], by=["region"])
    out = P.apply_medians(s, stats, ["income"], by=["region"], suffix="_FILLED")
    return finish(out.select("id", "region", "income", "income_FILLED"))


sql("group_median_impute", """
SELECT id, region, income, coalesce(income, median(income) OVER (PARTITION BY region)) AS income_FILLED
FROM spine""", ["spine"], rnd=["income", "income_FILLED"])


# ------------------------------------------------------------------ E6 / E7 / U2
def _seg_splits(spark, d):
    s = T.spine(spark, d).select("id", F.when(F.col("ext1").isNotNull(), F.col("seg")).alias("seg"),
                                 P.hash_split("id"))
    return s.filter(F.col("is_test") == 0), s.filter(F.col("is_test") == 1)


@query("label_encode")
def label_encode(spark, d):
    train, test = _seg_splits(spark, d)
    vocab = P.fit_labels([train, test], "seg")
    return finish(P.apply_labels(train.unionByName(test), vocab, "seg", "seg_code").select("id", "seg", "seg_code"))


sql("label_encode", """
SELECT id, CASE WHEN ext1 IS NOT NULL THEN seg END AS seg,
       CAST(dense_rank() OVER (ORDER BY coalesce(CASE WHEN ext1 IS NOT NULL THEN seg END, 'missing')) - 1 AS BIGINT) AS seg_code
FROM spine""", ["spine"])


@query("category_vocabulary")
def category_vocabulary(spark, d):
    train, test = _seg_splits(spark, d)
    return finish(P.fit_labels([train, test], "seg"))


sql("category_vocabulary", """
SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT coalesce(CASE WHEN ext1 IS NOT NULL THEN seg END, 'missing') AS value FROM spine) v""", ["spine"])


@query("label_encode_train_only")
def label_encode_train_only(spark, d):
    """Vocabulary of the train rows only: a value that they lack has no code."""
    s = T.spine(spark, d).select("id", F.concat_ws("-", "seg", F.col("region").cast("string")).alias("seg")) \
        .withColumn("is_test", P.hash_split("id"))
    train = s.filter((F.col("is_test") == 0) & (F.substring("seg", -1, 1) != "7"))
    return finish(P.apply_labels(s, P.fit_labels([train], "seg"), "seg", "seg_code").select("id", "seg", "seg_code"))


sql("label_encode_train_only", """
WITH s AS (SELECT id, concat_ws('-', seg, CAST(region AS VARCHAR)) AS seg,
                  CAST(substr(md5(CAST(id AS VARCHAR)), 1, 1) < '4' AS BIGINT) AS is_test FROM spine),
     v AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code
           FROM (SELECT DISTINCT coalesce(seg, 'missing') AS value FROM s WHERE is_test = 0 AND right(seg, 1) <> '7') u)
SELECT id, seg, code AS seg_code FROM s LEFT JOIN v ON coalesce(s.seg, 'missing') = v.value""", ["spine"])


@query("finite_impute")
def finite_impute(spark, d):
    """Median imputation, infinities to NULL, median imputation again, with train statistics."""
    s = T.spine(spark, d).withColumn("is_test", P.hash_split("id"))
    s = s.select("id", "is_test", F.when(F.col("id") % 7 == 0, F.lit(X.INF)).when(F.col("id") % 11 == 0, F.lit(-X.INF))
                 .otherwise(F.col("income")).alias("x"))
    return finish(P.impute_finite(s, s.filter("is_test = 0"), ["x"]))


sql("finite_impute", """
WITH s AS (SELECT id, CAST(substr(md5(CAST(id AS VARCHAR)), 1, 1) < '4' AS BIGINT) AS is_test,
                  CASE WHEN id % 7 = 0 THEN 'Infinity'::DOUBLE WHEN id % 11 = 0 THEN '-Infinity'::DOUBLE ELSE income END AS x
           FROM spine),
     m AS (SELECT quantile_cont(x, 0.5) AS v FROM s WHERE is_test = 0),
     p AS (SELECT id, is_test, CASE WHEN isinf(coalesce(x, v)) THEN NULL ELSE coalesce(x, v) END AS x FROM s, m),
     m2 AS (SELECT quantile_cont(x, 0.5) AS v FROM p WHERE is_test = 0)
SELECT id, is_test, coalesce(x, v) AS x FROM p, m2""", ["spine"], rnd=["x"])
