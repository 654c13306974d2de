"""Catalogue part 1: scans/sinks, projections, entity rollups, slices, joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens.functions.exprs import count_if, flag, map_values, safe_div, smooth_div
from ledgerlens.operators import joins, rollup as R
from ledgerlens.operators.ordered import volatility
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import ORACLE, ROUNDED, finish, query
from ledgerlens.session import checkpoint_dir
from ledgerlens.sources import io, tables as T
from ledgerlens.sources.stored import store_by_key


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hist_rollup(h):
    return R.rollup(h, "id", [
        R.size_agg("HIST_COUNT"),
        *R.measure_aggs({"amt": ["sum", "mean", "max"], "day": ["min", "max"]}, prefix="HIST_"),
    ])


def _monthly_rollup(m):
    return R.rollup(m, "id", [
        R.size_agg("MON_COUNT"),
        *R.measure_aggs({"bal": ["mean", "max"], "draw": ["sum"]}, prefix="MON_"),
    ])


# ------------------------------------------------------------------ J1 (flagship)
@query("feature_spine_join")
def feature_spine_join(spark, d):
    sp = T.spine(spark, d).select("id", "seg", "income")
    return finish(joins.spine_join(sp, [_hist_rollup(T.hist(spark, d)), _monthly_rollup(T.monthly(spark, d))], "id"))


sql("feature_spine_join", """
SELECT s.id, s.seg, s.income, h.HIST_COUNT, h.HIST_amt_sum, h.HIST_amt_mean, h.HIST_amt_max,
       h.HIST_day_min, h.HIST_day_max, m.MON_COUNT, m.MON_bal_mean, m.MON_bal_max, m.MON_draw_sum
FROM spine s
LEFT JOIN (SELECT id, count(*) AS HIST_COUNT, coalesce(sum(amt), 0) AS HIST_amt_sum, avg(amt) AS HIST_amt_mean,
                  max(amt) AS HIST_amt_max, min(day) AS HIST_day_min, max(day) AS HIST_day_max
           FROM hist GROUP BY id) h ON s.id = h.id
LEFT JOIN (SELECT id, count(*) AS MON_COUNT, avg(bal) AS MON_bal_mean, max(bal) AS MON_bal_max,
                  coalesce(sum(draw), 0) AS MON_draw_sum
           FROM monthly GROUP BY id) m ON s.id = m.id
""", ["spine", "hist", "monthly"], rnd=["income", "HIST_amt_sum", "HIST_amt_mean", "HIST_amt_max",
                                       "MON_bal_mean", "MON_bal_max", "MON_draw_sum"])


# ------------------------------------------------------------------ J1 / IO2 over stored, bucketed feature tables
@query("stored_spine_join")
def stored_spine_join(spark, d):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames = [T.spine(spark, d).select("id", "seg", "income"), _hist_rollup(T.hist(spark, d)), _monthly_rollup(T.monthly(spark, d))]
    sp, *features = [store_by_key(f, _scratch(spark, "stored"), "id", buckets) for f in frames]
    return finish(joins.spine_join(sp, features, "id"))


ORACLE["stored_spine_join"], ROUNDED["stored_spine_join"] = ORACLE["feature_spine_join"], ROUNDED["feature_spine_join"]


# ------------------------------------------------------------------ IO
@query("csv_roundtrip")
def csv_roundtrip(spark, d):
    part = T.load(spark, d, "part")
    path = _scratch(spark, "csv_roundtrip")
    io.write_csv(part, path)
    back = io.read_csv(spark, path, schema=part.schema)
    return finish(back)


sql("csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part",
    rnd=["p_retailprice"])


@query("score_output")
def score_output(spark, d):
    sp = T.spine(spark, d).withColumn("score", F.coalesce(F.col("ext1"), F.lit(0.5)))
    path = _scratch(spark, "scores")
    io.write_scores(sp, "id", "score", path, fmt="parquet")
    return finish(io.read_table(spark, path))


sql("score_output", "SELECT id, coalesce(ext1, 0.5::DOUBLE) AS score FROM spine", ["spine"], rnd=["score"])


_SHAPES = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
           "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
           "conversations": 4}


@query("table_shape")
def table_shape(spark, d):
    out = None
    for t in T.TABLES:
        s = io.table_shape(T.load(spark, d, t), t)
        out = s if out is None else out.unionByName(s)
    return finish(out)


sql("table_shape", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS BIGINT) AS n_cols FROM {t}"
    for t, n in _SHAPES.items()))


# ------------------------------------------------------------------ P2/P3
@query("project_rename")
def project_rename(spark, d):
    h = T.hist(spark, d).select("id", "u", "amt", "day")
    return finish(h.withColumnsRenamed({"id": "SK_ID_CURR", "u": "SK_ID_PREV", "amt": "AMT_CREDIT",
                                        "day": "DAYS_DECISION"}))


sql("project_rename", "SELECT id AS SK_ID_CURR, u AS SK_ID_PREV, amt AS AMT_CREDIT, day AS DAYS_DECISION FROM hist",
    ["hist"], rnd=["AMT_CREDIT"])


# ------------------------------------------------------------------ A1/A2/A4
@query("entity_rollup")
def entity_rollup(spark, d):
    h = T.hist(spark, d)
    return finish(R.rollup(h, "id", [
        R.size_agg("HIST_size"),
        *R.measure_aggs({"u": ["count"], "day": ["min", "max", "mean", "sum"],
                         "amt": ["min", "max", "mean", "sum", "std"]}, prefix="HIST_"),
    ]))


sql("entity_rollup", """
SELECT id, count(*) AS HIST_size, count(u) AS HIST_u_count,
       min(day) AS HIST_day_min, max(day) AS HIST_day_max, avg(day) AS HIST_day_mean,
       CAST(coalesce(sum(day), 0) AS BIGINT) AS HIST_day_sum,
       min(amt) AS HIST_amt_min, max(amt) AS HIST_amt_max, avg(amt) AS HIST_amt_mean,
       coalesce(sum(amt), 0) AS HIST_amt_sum, stddev_samp(amt) AS HIST_amt_std
FROM hist GROUP BY id
""", ["hist"], rnd=["HIST_day_mean", "HIST_amt_min", "HIST_amt_max", "HIST_amt_mean", "HIST_amt_sum", "HIST_amt_std"])


# ------------------------------------------------------------------ A5
@query("category_diversity")
def category_diversity(spark, d):
    h = T.hist(spark, d)
    return finish(R.rollup(h, "id", [F.count_distinct("kind").alias("HIST_KIND_COUNT"),
                                     F.count_distinct("status").alias("HIST_STATUS_COUNT")]))


sql("category_diversity", """
SELECT id, count(DISTINCT kind) AS HIST_KIND_COUNT, count(DISTINCT status) AS HIST_STATUS_COUNT
FROM hist GROUP BY id""", ["hist"])


# ------------------------------------------------------------------ A6/J4/P5
_STATUS = {"HIST_FILLED_COUNT": "F", "HIST_OPEN_COUNT": "O", "HIST_PENDING_COUNT": "P"}


@query("status_counts")
def status_counts(spark, d):
    h = T.hist(spark, d)
    return finish(R.rollup(h, "id", [R.size_agg("HIST_COUNT"), *R.status_counts("status", _STATUS)]))


sql("status_counts", """
SELECT id, count(*) AS HIST_COUNT,
       nullif(count(*) FILTER (WHERE status = 'F'), 0) AS HIST_FILLED_COUNT,
       nullif(count(*) FILTER (WHERE status = 'O'), 0) AS HIST_OPEN_COUNT,
       nullif(count(*) FILTER (WHERE status = 'P'), 0) AS HIST_PENDING_COUNT
FROM hist GROUP BY id""", ["hist"])


# ------------------------------------------------------------------ A7
@query("status_rates")
def status_rates(spark, d):
    h = T.hist(spark, d)
    return finish(R.rollup(h, "id", R.status_rates("status", {"HIST_FILLED_RATE": "F", "HIST_PENDING_RATE": "P"})))


sql("status_rates", """
SELECT id,
       nullif(count(*) FILTER (WHERE status = 'F'), 0) / count(*) AS HIST_FILLED_RATE,
       nullif(count(*) FILTER (WHERE status = 'P'), 0) / count(*) AS HIST_PENDING_RATE
FROM hist GROUP BY id""", ["hist"], rnd=["HIST_FILLED_RATE", "HIST_PENDING_RATE"])


# ------------------------------------------------------------------ A8
@query("ratio_of_sums")
def ratio_of_sums(spark, d):
    i = R.rollup(T.inst(spark, d), "id", [R.ratio("INST_PAYMENT_RATIO", R.AGG_FUNCS["sum"]("paid"),
                                                  R.AGG_FUNCS["sum"]("due"))])
    m = R.rollup(T.monthly(spark, d), "id", [R.ratio("MON_DRAW_LIMIT_RATIO", R.AGG_FUNCS["sum"]("draw"),
                                                     R.AGG_FUNCS["sum"]("lim"))])
    return finish(joins.merge_features([i, m], "id"))


sql("ratio_of_sums", """
SELECT coalesce(i.id, m.id) AS id, i.INST_PAYMENT_RATIO, m.MON_DRAW_LIMIT_RATIO
FROM (SELECT id, coalesce(sum(paid), 0) / nullif(coalesce(sum(due), 0), 0) AS INST_PAYMENT_RATIO
      FROM inst GROUP BY id) i
FULL OUTER JOIN (SELECT id, coalesce(sum(draw), 0) / nullif(coalesce(sum(lim), 0), 0) AS MON_DRAW_LIMIT_RATIO
                 FROM monthly GROUP BY id) m ON i.id = m.id
""", ["inst", "monthly"], rnd=["INST_PAYMENT_RATIO", "MON_DRAW_LIMIT_RATIO"])


# ------------------------------------------------------------------ J2/J5/A10/A9 two-hop
def _bal_with_entity(spark, d):
    return joins.attach_key(T.bal(spark, d), T.hist(spark, d).withColumnRenamed("u", "parent"), "parent", "id")


@query("category_shares")
def category_shares(spark, d):
    b = _bal_with_entity(spark, d)
    return finish(R.rollup(b, "id", R.category_shares("code", T.BAL_CODES, prefix="BAL_STATUS_")))


sql("category_shares", """
SELECT h.id, """ + ",\n       ".join(
    f"count(*) FILTER (WHERE b.code = '{c}') / count(b.code) AS BAL_STATUS_{c}_RATIO" for c in
    ["0", "1", "2", "3", "4", "5", "C", "X"]) + """
FROM bal b JOIN hist h ON b.parent = h.u
GROUP BY h.id""", ["bal", "hist"], rnd=[f"BAL_STATUS_{c}_RATIO" for c in ["0", "1", "2", "3", "4", "5", "C", "X"]])


@query("two_hop_rollup")
def two_hop_rollup(spark, d):
    b = _bal_with_entity(spark, d).withColumn("sev", map_values("code", T.CODE_SEVERITY))
    bal_agg = R.rollup(b, "id", [
        *R.measure_aggs({"month": ["min", "max"]}, prefix="BAL_"),
        R.size_agg("BAL_MONTHS"),
        *R.measure_aggs({"sev": ["mean", "max", "sum"]}, prefix="BAL_"),
    ])
    loans = R.rollup(T.hist(spark, d), "id", [R.size_agg("LOAN_COUNT")])
    out = loans.join(bal_agg, "id", "left")
    return finish(out.fillna(0))


sql("two_hop_rollup", """
SELECT l.id, l.LOAN_COUNT,
       coalesce(b.BAL_month_min, 0) AS BAL_month_min, coalesce(b.BAL_month_max, 0) AS BAL_month_max,
       coalesce(b.BAL_MONTHS, 0) AS BAL_MONTHS,
       coalesce(b.BAL_sev_mean, 0) AS BAL_sev_mean, coalesce(b.BAL_sev_max, 0) AS BAL_sev_max,
       coalesce(b.BAL_sev_sum, 0) AS BAL_sev_sum
FROM (SELECT id, count(*) AS LOAN_COUNT FROM hist GROUP BY id) l
LEFT JOIN (
  SELECT h.id, min(b.month) AS BAL_month_min, max(b.month) AS BAL_month_max, count(*) AS BAL_MONTHS,
         avg(s.sev) AS BAL_sev_mean, max(s.sev) AS BAL_sev_max, CAST(coalesce(sum(s.sev), 0) AS BIGINT) AS BAL_sev_sum
  FROM bal b JOIN hist h ON b.parent = h.u
  CROSS JOIN LATERAL (SELECT CAST(CASE b.code WHEN 'C' THEN 0 WHEN 'X' THEN 0 WHEN '0' THEN 0 WHEN '1' THEN 1
                      WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 4 WHEN '5' THEN 5 END AS BIGINT) AS sev) s
  GROUP BY h.id) b ON l.id = b.id
""", ["hist", "bal"], rnd=["BAL_sev_mean"])


@query("mapped_status_agg")
def mapped_status_agg(spark, d):
    # history form: unmapped codes count as 0 (mapped then filled)
    b = _bal_with_entity(spark, d).withColumn("sev", F.coalesce(map_values("code", T.CODE_SEVERITY), F.lit(0)))
    recent = F.col("month") >= -6
    return finish(R.rollup(b, "id", [
        *R.measure_aggs({"sev": ["mean", "max", "sum"]}, prefix="STATUS_"),
        *R.measure_aggs({"sev": ["mean", "max", "sum"]}, prefix="RECENT_STATUS_", where=recent),
    ]))


sql("mapped_status_agg", """
SELECT id, avg(sev) AS STATUS_sev_mean, max(sev) AS STATUS_sev_max, CAST(sum(sev) AS BIGINT) AS STATUS_sev_sum,
       avg(sev) FILTER (WHERE month >= -6) AS RECENT_STATUS_sev_mean,
       max(sev) FILTER (WHERE month >= -6) AS RECENT_STATUS_sev_max,
       CAST(sum(sev) FILTER (WHERE month >= -6) AS BIGINT) AS RECENT_STATUS_sev_sum
FROM (SELECT h.id, b.month,
             CAST(CASE WHEN b.code IN ('C', 'X', '0') THEN 0 WHEN b.code IN ('1','2','3','4','5') THEN CAST(b.code AS INTEGER)
                  ELSE 0 END AS BIGINT) AS sev
      FROM bal b JOIN hist h ON b.parent = h.u) t
GROUP BY id""", ["bal", "hist"], rnd=["STATUS_sev_mean", "RECENT_STATUS_sev_mean"])


# ------------------------------------------------------------------ A11/A12/P6
@query("recent_vs_old_agg")
def recent_vs_old_agg(spark, d):
    h = T.hist(spark, d)
    recent, old = R.slice_pred("day", lo=-730), R.slice_pred("day", hi=-730)
    return finish(R.rollup(h, "id", [
        *R.measure_aggs({"amt": ["sum", "mean", "max"]}, prefix="RECENT_", where=recent),
        R.size_agg("RECENT_CREDIT_COUNT", where=recent, absent_when_empty=True),
        *R.measure_aggs({"amt": ["sum", "mean"]}, prefix="OLD_", where=old),
        R.size_agg("OLD_CREDIT_COUNT", where=old, absent_when_empty=True),
    ]))


sql("recent_vs_old_agg", """
SELECT id,
       sum(amt) FILTER (WHERE day >= -730) AS RECENT_amt_sum,
       avg(amt) FILTER (WHERE day >= -730) AS RECENT_amt_mean,
       max(amt) FILTER (WHERE day >= -730) AS RECENT_amt_max,
       nullif(count(*) FILTER (WHERE day >= -730), 0) AS RECENT_CREDIT_COUNT,
       sum(amt) FILTER (WHERE day < -730) AS OLD_amt_sum,
       avg(amt) FILTER (WHERE day < -730) AS OLD_amt_mean,
       nullif(count(*) FILTER (WHERE day < -730), 0) AS OLD_CREDIT_COUNT
FROM hist GROUP BY id""", ["hist"], rnd=["RECENT_amt_sum", "RECENT_amt_mean", "RECENT_amt_max", "OLD_amt_sum",
                                        "OLD_amt_mean"])


# ------------------------------------------------------------------ P7
def _with_util(m):
    return m.withColumn("util", smooth_div("bal", "lim"))


@query("band_window_agg")
def band_window_agg(spark, d):
    m = _with_util(T.monthly(spark, d))
    band = R.slice_pred("period", lo=-12, hi=-6)
    return finish(R.rollup(m, "id", [
        *R.measure_aggs({"draw": ["mean", "max"], "pay": ["mean"], "util": ["mean"], "dpd": ["mean"]},
                        prefix="CC_OLD_", where=band),
    ], having=count_if(band) > 0))


sql("band_window_agg", """
SELECT id, avg(draw) AS CC_OLD_draw_mean, max(draw) AS CC_OLD_draw_max, avg(pay) AS CC_OLD_pay_mean,
       avg(bal / (lim + 1.0)) AS CC_OLD_util_mean, avg(dpd) AS CC_OLD_dpd_mean
FROM monthly WHERE period >= -12 AND period < -6
GROUP BY id""", ["monthly"], rnd=["CC_OLD_draw_mean", "CC_OLD_draw_max", "CC_OLD_pay_mean", "CC_OLD_util_mean",
                                  "CC_OLD_dpd_mean"])


# ------------------------------------------------------------------ A13
@query("recent_base_entities")
def recent_base_entities(spark, d):
    m = _with_util(T.monthly(spark, d))
    recent = R.slice_pred("period", lo=-6)
    return finish(R.rollup(m, "id", [
        *R.measure_aggs({"draw": ["sum", "mean", "max"], "bal": ["mean", "max"], "util": ["mean", "max"],
                         "dpd": ["max", "sum", "mean"]}, prefix="CC_RECENT_", where=recent),
        R.size_agg("CC_RECENT_period_count", where=recent),
    ], having=count_if(recent) > 0))


sql("recent_base_entities", """
SELECT id, sum(draw) AS CC_RECENT_draw_sum, avg(draw) AS CC_RECENT_draw_mean, max(draw) AS CC_RECENT_draw_max,
       avg(bal) AS CC_RECENT_bal_mean, max(bal) AS CC_RECENT_bal_max,
       avg(bal / (lim + 1.0)) AS CC_RECENT_util_mean, max(bal / (lim + 1.0)) AS CC_RECENT_util_max,
       max(dpd) AS CC_RECENT_dpd_max, CAST(sum(dpd) AS BIGINT) AS CC_RECENT_dpd_sum, avg(dpd) AS CC_RECENT_dpd_mean,
       count(*) AS CC_RECENT_period_count
FROM monthly WHERE period >= -6
GROUP BY id""", ["monthly"], rnd=["CC_RECENT_draw_sum", "CC_RECENT_draw_mean", "CC_RECENT_draw_max",
                                  "CC_RECENT_bal_mean", "CC_RECENT_bal_max", "CC_RECENT_util_mean",
                                  "CC_RECENT_util_max", "CC_RECENT_dpd_mean"])


# ------------------------------------------------------------------ A14
@query("slice_improvement")
def slice_improvement(spark, d):
    h = T.hist(spark, d)
    recent, old = R.slice_pred("day", lo=-730), R.slice_pred("day", hi=-730)
    agg = R.rollup(h, "id", [
        F.avg(F.when(recent, F.col("amt"))).alias("_r_mean"), F.avg(F.when(old, F.col("amt"))).alias("_o_mean"),
        F.nullif(count_if(recent), F.lit(0)).alias("_r_n"), F.nullif(count_if(old), F.lit(0)).alias("_o_n"),
    ])
    out = agg.select(
        "id",
        (F.col("_o_mean") - F.col("_r_mean")).alias("AMOUNT_IMPROVEMENT"),
        (F.col("_r_mean") - F.col("_o_mean")).alias("AMOUNT_ACCELERATION"),
        smooth_div("_r_n", "_o_n").alias("RECENT_TO_OLD_RATIO"),
    )
    return finish(out.fillna(0))


sql("slice_improvement", """
SELECT id, coalesce(o_mean - r_mean, 0) AS AMOUNT_IMPROVEMENT, coalesce(r_mean - o_mean, 0) AS AMOUNT_ACCELERATION,
       coalesce(r_n / (o_n + 1.0), 0) AS RECENT_TO_OLD_RATIO
FROM (SELECT id, avg(amt) FILTER (WHERE day >= -730) AS r_mean, avg(amt) FILTER (WHERE day < -730) AS o_mean,
             nullif(count(*) FILTER (WHERE day >= -730), 0) AS r_n, nullif(count(*) FILTER (WHERE day < -730), 0) AS o_n
      FROM hist GROUP BY id) t""", ["hist"], rnd=["AMOUNT_IMPROVEMENT", "AMOUNT_ACCELERATION", "RECENT_TO_OLD_RATIO"])


# ------------------------------------------------------------------ A15
@query("amount_volatility")
def amount_volatility(spark, d):
    return finish(R.rollup(T.hist(spark, d), "id", [volatility("amt").alias("AMOUNT_VOLATILITY")]))


sql("amount_volatility", """
SELECT id, CASE WHEN count(*) < 2 THEN 0.0 ELSE stddev_samp(amt) / nullif(avg(amt) + 1.0, 0) END AS AMOUNT_VOLATILITY
FROM hist GROUP BY id""", ["hist"], rnd=["AMOUNT_VOLATILITY"])


# ------------------------------------------------------------------ J3
@query("outer_feature_merge")
def outer_feature_merge(spark, d):
    """recent ⟗ old ⟗ trend — entity-grain frames merged by full outer joins."""
    from ledgerlens.operators.ordered import first_last_change
    h = T.hist(spark, d)
    recent = R.rollup(h.filter(F.col("day") >= -730), "id",
                      [F.sum("amt").alias("RECENT_amt_sum"), R.size_agg("RECENT_COUNT")])
    old = R.rollup(h.filter(F.col("day") < -730), "id", [F.sum("amt").alias("OLD_amt_sum"), R.size_agg("OLD_COUNT")])
    trend = R.rollup(h, "id", [first_last_change("amt", "day", ["u"]).alias("AMOUNT_TREND")])
    return finish(joins.merge_features([recent, old, trend], "id").fillna(0))


sql("outer_feature_merge", """
WITH r AS (SELECT id, sum(amt) AS RECENT_amt_sum, count(*) AS RECENT_COUNT FROM hist WHERE day >= -730 GROUP BY id),
     o AS (SELECT id, sum(amt) AS OLD_amt_sum, count(*) AS OLD_COUNT FROM hist WHERE day < -730 GROUP BY id),
     ranked AS (SELECT id, amt, row_number() OVER (PARTITION BY id ORDER BY day, u) AS rn_a,
                       row_number() OVER (PARTITION BY id ORDER BY day DESC, u DESC) AS rn_z,
                       count(*) OVER (PARTITION BY id) AS n FROM hist),
     t AS (SELECT id, CASE WHEN max(n) >= 2 THEN max(CASE WHEN rn_z = 1 THEN amt END) - max(CASE WHEN rn_a = 1 THEN amt END)
                           ELSE 0.0 END AS AMOUNT_TREND FROM ranked GROUP BY id)
SELECT coalesce(r.id, o.id, t.id) AS id, coalesce(RECENT_amt_sum, 0) AS RECENT_amt_sum,
       coalesce(RECENT_COUNT, 0) AS RECENT_COUNT, coalesce(OLD_amt_sum, 0) AS OLD_amt_sum,
       coalesce(OLD_COUNT, 0) AS OLD_COUNT, coalesce(AMOUNT_TREND, 0) AS AMOUNT_TREND
FROM r FULL OUTER JOIN o ON r.id = o.id FULL OUTER JOIN t ON coalesce(r.id, o.id) = t.id
""", ["hist"], rnd=["RECENT_amt_sum", "OLD_amt_sum", "AMOUNT_TREND"])


# ------------------------------------------------------------------ J6
@query("cross_table_features")
def cross_table_features(spark, d):
    sp = T.spine(spark, d).select("id", "income", F.col("acctbal").alias("credit"))
    loans = R.rollup(T.hist(spark, d), "id", [R.size_agg("LOAN_COUNT"),
                                              *R.status_counts("status", {"ACTIVE_LOANS": "O"})])
    apps = R.rollup(T.monthly(spark, d), "id", [R.size_agg("APP_COUNT"),
                                                R.size_agg("APPROVED_COUNT", where=F.col("draw") > 0)])
    ins = T.inst(spark, d).withColumn("late", flag(F.col("entry_day") - F.col("due_day") > 0))
    inst_agg = R.rollup(ins, "id", [R.size_agg("INST_COUNT"), F.sum("late").alias("LATE_sum")])
    j = joins.spine_join(sp, [loans, apps, inst_agg], "id").fillna(0)
    exp = F.col("LOAN_COUNT") + F.col("APP_COUNT")
    return finish(j.select(
        "id",
        exp.alias("TOTAL_CREDIT_EXPERIENCE"),
        smooth_div("LOAN_COUNT", "APP_COUNT").alias("LOAN_TO_APP_RATIO"),
        smooth_div("LATE_sum", "INST_COUNT").alias("LATE_PAYMENT_RATIO"),
        (F.col("APPROVED_COUNT") + F.col("ACTIVE_LOANS")).alias("CREDIT_ACTIVITY_SCORE"),
        safe_div("credit", "income").alias("CREDIT_PER_INCOME"),
        safe_div(F.col("credit"), exp + F.lit(1)).alias("DEBT_PER_EXPERIENCE"),
    ))


sql("cross_table_features", """
WITH l AS (SELECT id, count(*) AS LOAN_COUNT, nullif(count(*) FILTER (WHERE status = 'O'), 0) AS ACTIVE_LOANS
           FROM hist GROUP BY id),
     a AS (SELECT id, count(*) AS APP_COUNT, count(*) FILTER (WHERE draw > 0) AS APPROVED_COUNT FROM monthly GROUP BY id),
     i AS (SELECT id, count(*) AS INST_COUNT,
                  sum(CASE WHEN entry_day - due_day > 0 THEN 1 ELSE 0 END) AS LATE_sum FROM inst GROUP BY id),
     j AS (SELECT s.id, coalesce(s.income, 0) AS income, coalesce(s.acctbal, 0) AS credit,
                  coalesce(LOAN_COUNT, 0) AS LOAN_COUNT, coalesce(ACTIVE_LOANS, 0) AS ACTIVE_LOANS,
                  coalesce(APP_COUNT, 0) AS APP_COUNT, coalesce(APPROVED_COUNT, 0) AS APPROVED_COUNT,
                  coalesce(INST_COUNT, 0) AS INST_COUNT, coalesce(LATE_sum, 0) AS LATE_sum
           FROM spine s LEFT JOIN l ON s.id = l.id LEFT JOIN a ON s.id = a.id LEFT JOIN i ON s.id = i.id)
SELECT id, CAST(LOAN_COUNT + APP_COUNT AS BIGINT) AS TOTAL_CREDIT_EXPERIENCE,
       LOAN_COUNT / (APP_COUNT + 1.0) AS LOAN_TO_APP_RATIO,
       LATE_sum / (INST_COUNT + 1.0) AS LATE_PAYMENT_RATIO,
       CAST(APPROVED_COUNT + ACTIVE_LOANS AS BIGINT) AS CREDIT_ACTIVITY_SCORE,
       credit / nullif(income, 0) AS CREDIT_PER_INCOME,
       credit / nullif(LOAN_COUNT + APP_COUNT + 1.0, 0) AS DEBT_PER_EXPERIENCE
FROM j""", ["spine", "hist", "monthly", "inst"], rnd=["LOAN_TO_APP_RATIO", "LATE_PAYMENT_RATIO", "CREDIT_PER_INCOME",
                                                     "DEBT_PER_EXPERIENCE"])


# ------------------------------------------------------------------ P11 / F12
@query("late_under_flags")
def late_under_flags(spark, d):
    i = T.inst(spark, d)
    diff = F.col("paid") - F.col("due")
    delay = F.col("entry_day") - F.col("due_day")
    return finish(i.select("u0", "u1", "u2", "u3", "u4", diff.alias("PAYMENT_DIFF"), delay.alias("PAYMENT_DELAY"),
                           flag(delay > 0).alias("LATE_PAYMENT"), flag(diff < 0).alias("UNDERPAYMENT"),
                           F.abs(diff).alias("ABS_PAYMENT_DIFF")))


sql("late_under_flags", """
SELECT u0, CAST(u1 AS BIGINT) AS u1, u2, u3, u4, paid - due AS PAYMENT_DIFF, entry_day - due_day AS PAYMENT_DELAY,
       CAST(CASE WHEN entry_day - due_day > 0 THEN 1 ELSE 0 END AS BIGINT) AS LATE_PAYMENT,
       CAST(CASE WHEN paid - due < 0 THEN 1 ELSE 0 END AS BIGINT) AS UNDERPAYMENT,
       abs(paid - due) AS ABS_PAYMENT_DIFF
FROM inst""", ["inst"], rnd=["u4", "PAYMENT_DIFF", "ABS_PAYMENT_DIFF"])
