"""Catalogue part 2: ordered per-entity analytics (W1-W17) and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.exprs import flag, smooth_div
from ledgerlens.operators import evaluate as E, ordered as O, rollup as R
from ledgerlens.operators.joins import attach_key
from ledgerlens.operators.prefix import running_max
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import finish, query
from ledgerlens.sources import tables as T

BAL_TIE = ["parent", "u1", "u2", "u3", "u4"]
INST_TIE = ["u0", "u1", "u2", "u3", "u4"]
SQL_BAL_TIE = "parent, u1, u2, u3, u4"
SQL_INST_TIE = "u0, u1, u2, u3, u4"


def _bal_entity(spark, d):
    b = attach_key(T.bal(spark, d), T.hist(spark, d).select(F.col("u").alias("parent"), "id"), "parent", "id")
    return b.withColumn("sev", F.coalesce(
        F.when(F.col("code").isin("C", "X", "0"), F.lit(0)).when(F.col("code").isin("1", "2", "3", "4", "5"),
                                                                  F.col("code").cast("int")), F.lit(0)))


_SQL_BAL_ENTITY = """be AS (
  SELECT h.id, b.*, CASE WHEN b.code IN ('C','X','0') THEN 0
                         WHEN b.code IN ('1','2','3','4','5') THEN CAST(b.code AS INTEGER) ELSE 0 END AS sev
  FROM bal b JOIN hist h ON b.parent = h.u)"""


def _inst_delay(spark, d):
    i = T.inst(spark, d)
    return (i.withColumn("delay", F.col("entry_day") - F.col("due_day"))
             .withColumn("late", flag(F.col("entry_day") - F.col("due_day") > 0)))


# ------------------------------------------------------------------ W1
@query("recency_pct_rank")
def recency_pct_rank(spark, d):
    h = T.hist(spark, d).select("id", "u", "day")
    return finish(O.pct_rank(h, "id", "day", out="CREDIT_RECENCY"))


sql("recency_pct_rank", """
SELECT id, u, day,
       (rank() OVER (PARTITION BY id ORDER BY day) + (count(*) OVER (PARTITION BY id, day) - 1) / 2.0)
         / count(day) OVER (PARTITION BY id) AS CREDIT_RECENCY
FROM hist""", ["hist"], rnd=["CREDIT_RECENCY"])


# ------------------------------------------------------------------ W2 / W3
@query("first_last_trend")
def first_last_trend(spark, d):
    h = T.hist(spark, d)
    return finish(R.rollup(h, "id", [
        O.first_last_change("amt", "day", ["u"]).alias("CREDIT_AMOUNT_TREND"),
        O.first_last_change("day", "day", ["u"]).alias("DAY_SPAN_TREND"),
    ]).fillna(0))


sql("first_last_trend", """
WITH r AS (SELECT id, amt, day, row_number() OVER (PARTITION BY id ORDER BY day, u) AS rn_a,
                  row_number() OVER (PARTITION BY id ORDER BY day DESC, u DESC) AS rn_z,
                  count(*) OVER (PARTITION BY id) AS n FROM hist)
SELECT id,
       coalesce(CASE WHEN max(n) >= 2 THEN max(amt) FILTER (WHERE rn_z = 1) - max(amt) FILTER (WHERE rn_a = 1) ELSE 0 END, 0)
         AS CREDIT_AMOUNT_TREND,
       CAST(coalesce(CASE WHEN max(n) >= 2 THEN max(day) FILTER (WHERE rn_z = 1) - max(day) FILTER (WHERE rn_a = 1) ELSE 0 END, 0)
         AS DOUBLE) AS DAY_SPAN_TREND
FROM r GROUP BY id""", ["hist"], rnd=["CREDIT_AMOUNT_TREND", "DAY_SPAN_TREND"])


@query("relative_amount_trend")
def relative_amount_trend(spark, d):
    h = T.hist(spark, d)
    return finish(R.rollup(h, "id", [O.relative_change("amt", "day", ["u"]).alias("PREV_LOAN_AMOUNT_TREND")]).fillna(0))


sql("relative_amount_trend", """
WITH r AS (SELECT id, amt, row_number() OVER (PARTITION BY id ORDER BY day, u) AS rn_a,
                  row_number() OVER (PARTITION BY id ORDER BY day DESC, u DESC) AS rn_z,
                  count(*) OVER (PARTITION BY id) AS n FROM hist)
SELECT id, coalesce(CASE WHEN max(n) >= 2 THEN
         (max(amt) FILTER (WHERE rn_z = 1) - max(amt) FILTER (WHERE rn_a = 1))
         / nullif(max(amt) FILTER (WHERE rn_a = 1) + 1.0, 0) ELSE 0 END, 0) AS PREV_LOAN_AMOUNT_TREND
FROM r GROUP BY id""", ["hist"], rnd=["PREV_LOAN_AMOUNT_TREND"])


# ------------------------------------------------------------------ W4 / W5
@query("tail_head_mean_diff")
def tail_head_mean_diff(spark, d):
    b = O.with_order_ranks(_bal_entity(spark, d), "id", "month", BAL_TIE, joined_on_first=True)
    return finish(R.rollup(b, "id", [O.tail_head_diff("sev", 6, min_n=6).alias("PAYMENT_STATUS_TREND")]).fillna(0))


sql("tail_head_mean_diff", """
WITH r AS (SELECT id, sev, row_number() OVER (PARTITION BY id ORDER BY month, """ + SQL_BAL_TIE + """) AS rn,
                  count(*) OVER (PARTITION BY id) AS n FROM be)
SELECT id, coalesce(CASE WHEN max(n) >= 6 THEN avg(sev) FILTER (WHERE rn > n - 6) - avg(sev) FILTER (WHERE rn <= 6)
                         ELSE 0 END, 0) AS PAYMENT_STATUS_TREND
FROM r GROUP BY id""", ["bal", "hist"], rnd=["PAYMENT_STATUS_TREND"], ctes=_SQL_BAL_ENTITY)


@query("good_streak")
def good_streak(spark, d):
    b = O.with_order_ranks(_bal_entity(spark, d), "id", "month", BAL_TIE, joined_on_first=True)
    return finish(R.rollup(b, "id", [O.leading_streak(F.col("code").isin(*T.GOOD_CODES)).alias("CONSECUTIVE_GOOD_MONTHS")]))


sql("good_streak", """
WITH r AS (SELECT id, code, row_number() OVER (PARTITION BY id ORDER BY month DESC, """ + SQL_BAL_TIE + """) AS rn_d FROM be)
SELECT id, CAST(coalesce(min(rn_d) FILTER (WHERE code NOT IN ('C', 'X', '0')) - 1, count(*)) AS BIGINT)
         AS CONSECUTIVE_GOOD_MONTHS
FROM r GROUP BY id""", ["bal", "hist"], ctes=_SQL_BAL_ENTITY)


# ------------------------------------------------------------------ W6 / W7 / W8
@query("half_split_trend")
def half_split_trend(spark, d):
    i = O.with_order_ranks(_inst_delay(spark, d), "id", "due_day", INST_TIE, joined_on_first=True)
    return finish(R.rollup(i, "id", [O.half_split_diff("delay", 6).alias("PAYMENT_DELAY_TREND")]).fillna(0))


sql("half_split_trend", """
WITH r AS (SELECT id, entry_day - due_day AS delay,
                  row_number() OVER (PARTITION BY id ORDER BY due_day, """ + SQL_INST_TIE + """) AS rn,
                  count(*) OVER (PARTITION BY id) AS n FROM inst)
SELECT id, coalesce(CASE WHEN max(n) >= 6 THEN avg(delay) FILTER (WHERE rn > n // 2) - avg(delay) FILTER (WHERE rn <= n // 2)
                         ELSE 0 END, 0) AS PAYMENT_DELAY_TREND
FROM r GROUP BY id""", ["inst"], rnd=["PAYMENT_DELAY_TREND"])


@query("delay_consistency")
def delay_consistency(spark, d):
    i = _inst_delay(spark, d)
    return finish(R.rollup(i, "id", [F.stddev_samp("delay").alias("PAYMENT_DELAY_STD"),
                                     F.stddev_samp("paid").alias("PAID_STD")]).fillna(0))


sql("delay_consistency", """
SELECT id, coalesce(stddev_samp(entry_day - due_day), 0) AS PAYMENT_DELAY_STD,
       coalesce(stddev_samp(paid), 0) AS PAID_STD
FROM inst GROUP BY id""", ["inst"], rnd=["PAYMENT_DELAY_STD", "PAID_STD"])


@query("last_k_rate")
def last_k_rate(spark, d):
    i = O.with_order_ranks(_inst_delay(spark, d), "id", "due_day", INST_TIE, joined_on_first=True)
    return finish(R.rollup(i, "id", [O.last_k_mean("late", 3, 3).alias("LAST_3_PAYMENTS_LATE_RATE")]).fillna(0))


sql("last_k_rate", """
WITH r AS (SELECT id, CASE WHEN entry_day - due_day > 0 THEN 1 ELSE 0 END AS late,
                  row_number() OVER (PARTITION BY id ORDER BY due_day DESC, """ + SQL_INST_TIE + """) AS rn_d,
                  count(*) OVER (PARTITION BY id) AS n FROM inst)
SELECT id, coalesce(CASE WHEN max(n) >= 3 THEN avg(late) FILTER (WHERE rn_d <= 3) ELSE 0 END, 0)
         AS LAST_3_PAYMENTS_LATE_RATE
FROM r GROUP BY id""", ["inst"], rnd=["LAST_3_PAYMENTS_LATE_RATE"])


# ------------------------------------------------------------------ W9 / W10 / W11
def _monthly_ranked(spark, d):
    m = T.monthly(spark, d).withColumn("util", smooth_div("bal", "lim"))
    return O.with_order_ranks(m, "id", "period", ["u"])


_SQL_MON_RANKED = """r AS (
  SELECT id, draw, pay, dpd, bal / (lim + 1.0) AS util,
         row_number() OVER (PARTITION BY id ORDER BY period, u) AS rn_a,
         row_number() OVER (PARTITION BY id ORDER BY period DESC, u) AS rn_d,
         count(*) OVER (PARTITION BY id) AS n
  FROM monthly)"""


@query("spending_trend")
def spending_trend(spark, d):
    m = _monthly_ranked(spark, d)
    return finish(R.rollup(m, "id", [O.newest_oldest_rel_change("draw", 3, 3).alias("CC_SPENDING_TREND")]).fillna(0))


sql("spending_trend", """
SELECT id, coalesce(CASE WHEN max(n) >= 3 THEN
         (avg(draw) FILTER (WHERE rn_d <= 3) - avg(draw) FILTER (WHERE rn_a <= 3))
         / nullif(avg(draw) FILTER (WHERE rn_a <= 3) + 1.0, 0) ELSE 0 END, 0) AS CC_SPENDING_TREND
FROM r GROUP BY id""", ["monthly"], rnd=["CC_SPENDING_TREND"], ctes=_SQL_MON_RANKED)


@query("last_first_k_diff")
def last_first_k_diff(spark, d):
    m = _monthly_ranked(spark, d)
    return finish(R.rollup(m, "id", [O.tail_head_diff("util", 3, 3).alias("CC_UTILIZATION_TREND"),
                                     O.tail_head_diff("dpd", 3, 3).alias("CC_DPD_TREND")]).fillna(0))


sql("last_first_k_diff", """
SELECT id,
       coalesce(CASE WHEN max(n) >= 3 THEN avg(util) FILTER (WHERE rn_a > n - 3) - avg(util) FILTER (WHERE rn_a <= 3)
                     ELSE 0 END, 0) AS CC_UTILIZATION_TREND,
       coalesce(CASE WHEN max(n) >= 3 THEN avg(dpd) FILTER (WHERE rn_a > n - 3) - avg(dpd) FILTER (WHERE rn_a <= 3)
                     ELSE 0 END, 0) AS CC_DPD_TREND
FROM r GROUP BY id""", ["monthly"], rnd=["CC_UTILIZATION_TREND", "CC_DPD_TREND"], ctes=_SQL_MON_RANKED)


@query("ratio_trend")
def ratio_trend(spark, d):
    m = _monthly_ranked(spark, d)
    return finish(R.rollup(m, "id", [O.ratio_of_sums_trend("pay", "draw", 3, 3, 1.0).alias("CC_PAYMENT_DRAWING_TREND")])
                  .fillna(0))


sql("ratio_trend", """
SELECT id, coalesce(CASE WHEN max(n) < 3 THEN 1.0 ELSE
         coalesce(sum(pay) FILTER (WHERE rn_a > n - 3), 0) / nullif(coalesce(sum(draw) FILTER (WHERE rn_a > n - 3), 0) + 1.0, 0)
       - coalesce(sum(pay) FILTER (WHERE rn_a <= 3), 0) / nullif(coalesce(sum(draw) FILTER (WHERE rn_a <= 3), 0) + 1.0, 0)
       END, 0) AS CC_PAYMENT_DRAWING_TREND
FROM r GROUP BY id""", ["monthly"], rnd=["CC_PAYMENT_DRAWING_TREND"], ctes=_SQL_MON_RANKED)


# ------------------------------------------------------------------ W12 - W15 (application history on hist)
@query("avg_gap")
def avg_gap(spark, d):
    return finish(R.rollup(T.hist(spark, d), "id", [O.mean_abs_gap("day").alias("AVG_TIME_BETWEEN_APPS")]).fillna(0))


sql("avg_gap", """
WITH g AS (SELECT id, abs(day - lag(day) OVER (PARTITION BY id ORDER BY day, u)) AS gap,
                  count(*) OVER (PARTITION BY id) AS n FROM hist)
SELECT id, coalesce(CASE WHEN max(n) >= 2 THEN avg(gap) ELSE 0 END, 0) AS AVG_TIME_BETWEEN_APPS
FROM g GROUP BY id""", ["hist"], rnd=["AVG_TIME_BETWEEN_APPS"])


_SQL_HIST_RANKED = """r AS (
  SELECT id, status, amt,
         row_number() OVER (PARTITION BY id ORDER BY day, u) AS rn_a,
         row_number() OVER (PARTITION BY id ORDER BY day DESC, u) AS rn_d,
         count(*) OVER (PARTITION BY id) AS n
  FROM hist)"""


def _hist_ranked(spark, d):
    return O.with_order_ranks(T.hist(spark, d), "id", "day", ["u"])


@query("recent_success_rate")
def recent_success_rate(spark, d):
    return finish(R.rollup(_hist_ranked(spark, d), "id",
                           [O.newest_k_rate(F.col("status") == "F", 3).alias("RECENT_APPROVAL_RATE")]))


sql("recent_success_rate", """
SELECT id, count(*) FILTER (WHERE rn_d <= 3 AND status = 'F') / least(3, count(*)) AS RECENT_APPROVAL_RATE
FROM r GROUP BY id""", ["hist"], rnd=["RECENT_APPROVAL_RATE"], ctes=_SQL_HIST_RANKED)


@query("old_success_rate")
def old_success_rate(spark, d):
    return finish(R.rollup(_hist_ranked(spark, d), "id",
                           [O.older_rate(F.col("status") == "F", 3).alias("OLD_APPROVAL_RATE")]))


sql("old_success_rate", """
SELECT id, CASE WHEN count(*) <= 3 THEN 0.0
                ELSE avg(CASE WHEN status = 'F' THEN 1 ELSE 0 END) FILTER (WHERE rn_a <= n - 3) END AS OLD_APPROVAL_RATE
FROM r GROUP BY id""", ["hist"], rnd=["OLD_APPROVAL_RATE"], ctes=_SQL_HIST_RANKED)


@query("down_payment_trend")
def down_payment_trend(spark, d):
    h = _hist_ranked(spark, d).withColumn("down", F.when(F.col("status") != "P", F.col("amt")))
    return finish(R.rollup(h, "id", [O.newest_oldest_rel_change("down", 3, 2).alias("DOWN_PAYMENT_TREND")]).fillna(0))


sql("down_payment_trend", """
SELECT id, coalesce(CASE WHEN count(*) < 2 THEN 0.0 ELSE
         (avg(CASE WHEN status <> 'P' THEN amt END) FILTER (WHERE rn_d <= 3)
          - avg(CASE WHEN status <> 'P' THEN amt END) FILTER (WHERE rn_a <= 3))
         / nullif(avg(CASE WHEN status <> 'P' THEN amt END) FILTER (WHERE rn_a <= 3) + 1.0, 0) END, 0) AS DOWN_PAYMENT_TREND
FROM r GROUP BY id""", ["hist"], rnd=["DOWN_PAYMENT_TREND"], ctes=_SQL_HIST_RANKED)


# ------------------------------------------------------------------ W16 / W17
@query("running_best")
def running_best(spark, d):
    p = T.load(spark, d, "part").select("p_partkey", "p_retailprice")
    return finish(running_max(p, "p_partkey", "p_retailprice", out="running_max"))


sql("running_best", """
SELECT p_partkey, p_retailprice,
       max(p_retailprice) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max
FROM part""", rnd=["p_retailprice", "running_max"])


@query("roc_points")
def roc_points(spark, d):
    return finish(E.roc_points(T.scored(spark, d), "y", "s2"))


sql("roc_points", """
WITH g AS (SELECT s2 AS threshold, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY s2),
     c AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
                  sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / P AS tpr, fp / N AS fpr FROM c
""", ["scored"], rnd=["threshold", "tpr", "fpr"])


# ------------------------------------------------------------------ T3 / T4 / T5
@query("global_top_n")
def global_top_n(spark, d):
    o = T.hist(spark, d).select("u", "id", "amt")
    return finish(o.orderBy(F.desc("amt"), F.asc("u")).limit(20))


sql("global_top_n", "SELECT u, id, amt FROM hist ORDER BY amt DESC, u LIMIT 20", ["hist"], rnd=["amt"])


@query("global_bottom_n")
def global_bottom_n(spark, d):
    o = T.hist(spark, d).select("u", "id", "amt")
    return finish(o.orderBy(F.asc("amt"), F.asc("u")).limit(20))


sql("global_bottom_n", "SELECT u, id, amt FROM hist ORDER BY amt, u LIMIT 20", ["hist"], rnd=["amt"])


@query("top_k_per_entity")
def top_k_per_entity(spark, d):
    o = T.hist(spark, d).select("id", "u", "amt")
    return finish(O.top_k_per_group(o, "id", [F.desc("amt"), F.asc("u")], 3, salt_col="u"))


sql("top_k_per_entity", """
SELECT id, u, amt, rank FROM (
  SELECT id, u, amt, row_number() OVER (PARTITION BY id ORDER BY amt DESC, u) AS rank FROM hist) t
WHERE rank <= 3""", ["hist"], rnd=["amt"])
