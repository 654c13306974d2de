"""Catalogue part 6: the credit pack on reference-shaped views of the test
tables. Each of its five families has a query with an independent SQL oracle,
and the whole pack's oracle joins them to its own basic, missing, cross-table
and score features."""

from __future__ import annotations

from ledgerlens.plans import credit_pack as CP
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import ORACLE, ROUNDED, finish, query
from ledgerlens.sources import credit_tables as CT

INST_TIEBREAK = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "_tb_part", "_tb_supp", "_tb_price"]
BB_TIEBREAK = ["SK_ID_BUREAU", "_tb_line", "_tb_part", "_tb_supp", "_tb_price"]


def pack(spark, d, clean=True):
    t = CT.all_tables(spark, d)
    return CP.build(**t, clean=clean, inst_tiebreak=INST_TIEBREAK,
                    bb_tiebreak=BB_TIEBREAK, inst_joined_on_first=True)


@query("credit_pack")
def credit_pack(spark, d):
    return finish(pack(spark, d))


@query("credit_bureau_family")
def credit_bureau_family(spark, d):
    return finish(CP.bureau_features(CT.bureau(spark, d), CT.bureau_balance(spark, d), BB_TIEBREAK))


# ------------------------------------------------------------------ oracle for the bureau family
_REC, _OLD = "DAYS_CREDIT >= -730", "DAYS_CREDIT < -730"
_RM, _OM = "MONTHS_BALANCE >= -6", "MONTHS_BALANCE < -12"
_SEV = ("CASE STATUS WHEN 'C' THEN 0 WHEN 'X' THEN 0 WHEN '0' THEN 0 WHEN '1' THEN 1 WHEN '2' THEN 2 "
        "WHEN '3' THEN 3 WHEN '4' THEN 4 WHEN '5' THEN 5 END")


def _g(where: str, agg: str) -> str:
    """aggregate over a slice, missing when the slice is empty"""
    return f"CASE WHEN count(*) FILTER (WHERE {where}) > 0 THEN {agg} END"


_b_sel =["count(SK_ID_BUREAU) AS BUREAU_LOAN_COUNT",
          "min(DAYS_CREDIT) AS DAYS_CREDIT_min", "max(DAYS_CREDIT) AS DAYS_CREDIT_max",
          "avg(DAYS_CREDIT) AS DAYS_CREDIT_mean",
          "max(CREDIT_DAY_OVERDUE) AS CREDIT_DAY_OVERDUE_max", "avg(CREDIT_DAY_OVERDUE) AS CREDIT_DAY_OVERDUE_mean"]
for m in ["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE", "CNT_CREDIT_PROLONG"]:
    _b_sel += [f"coalesce(sum({m}), 0) AS {m}_sum", f"avg({m}) AS {m}_mean", f"max({m}) AS {m}_max"]
_b_sel += [
    "nullif(count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active'), 0) AS BUREAU_ACTIVE_LOANS",
    "nullif(count(*) FILTER (WHERE CREDIT_ACTIVE = 'Closed'), 0) AS BUREAU_CLOSED_LOANS",
    "count(DISTINCT CREDIT_TYPE) AS BUREAU_CREDIT_TYPE_COUNT",
    _g(_REC, f"coalesce(sum(AMT_CREDIT_SUM) FILTER (WHERE {_REC}), 0)") + " AS RECENT_AMT_CREDIT_SUM_sum",
    _g(_REC, f"avg(AMT_CREDIT_SUM) FILTER (WHERE {_REC})") + " AS RECENT_AMT_CREDIT_SUM_mean",
    _g(_REC, f"max(AMT_CREDIT_SUM) FILTER (WHERE {_REC})") + " AS RECENT_AMT_CREDIT_SUM_max",
    _g(_REC, f"max(CREDIT_DAY_OVERDUE) FILTER (WHERE {_REC})") + " AS RECENT_CREDIT_DAY_OVERDUE_max",
    _g(_REC, f"avg(CREDIT_DAY_OVERDUE) FILTER (WHERE {_REC})") + " AS RECENT_CREDIT_DAY_OVERDUE_mean",
    f"nullif(count(SK_ID_BUREAU) FILTER (WHERE {_REC}), 0) AS RECENT_CREDIT_COUNT",
    _g(_OLD, f"coalesce(sum(AMT_CREDIT_SUM) FILTER (WHERE {_OLD}), 0)") + " AS OLD_AMT_CREDIT_SUM_sum",
    _g(_OLD, f"avg(AMT_CREDIT_SUM) FILTER (WHERE {_OLD})") + " AS OLD_AMT_CREDIT_SUM_mean",
    f"nullif(count(SK_ID_BUREAU) FILTER (WHERE {_OLD}), 0) AS OLD_CREDIT_COUNT",
    "CASE WHEN count(*) >= 2 THEN max(AMT_CREDIT_SUM) FILTER (WHERE rn_z = 1) - max(AMT_CREDIT_SUM) FILTER (WHERE rn_a = 1)"
    " ELSE 0 END AS CREDIT_AMOUNT_TREND",
    "CASE WHEN count(*) >= 2 THEN max(CREDIT_DAY_OVERDUE) FILTER (WHERE rn_z = 1)"
    " - max(CREDIT_DAY_OVERDUE) FILTER (WHERE rn_a = 1) ELSE 0 END AS OVERDUE_TREND",
]
_codes = ["0", "1", "2", "3", "4", "5", "C", "X"]
_bb_sel = ["min(MONTHS_BALANCE) AS BUREAU_MONTHS_BALANCE_min", "max(MONTHS_BALANCE) AS BUREAU_MONTHS_BALANCE_max",
           "count(*) AS BUREAU_BALANCE_MONTHS", "avg(sev_raw) AS STATUS_NUMERIC_mean",
           "max(sev_raw) AS STATUS_NUMERIC_max", "coalesce(sum(sev_raw), 0) AS STATUS_NUMERIC_sum"]
_bb_sel += [f"count(*) FILTER (WHERE STATUS = '{c}') / count(STATUS) AS BUREAU_STATUS_{c}_RATIO" for c in _codes]
_bb_sel += [
    _g(_RM, f"avg(sev) FILTER (WHERE {_RM})") + " AS RECENT_STATUS_STATUS_NUM_mean",
    _g(_RM, f"max(sev) FILTER (WHERE {_RM})") + " AS RECENT_STATUS_STATUS_NUM_max",
    _g(_RM, f"coalesce(sum(sev) FILTER (WHERE {_RM}), 0)") + " AS RECENT_STATUS_STATUS_NUM_sum",
    f"nullif(count(MONTHS_BALANCE) FILTER (WHERE {_RM}), 0) AS RECENT_MONTHS_COUNT",
    _g(_OM, f"avg(sev) FILTER (WHERE {_OM})") + " AS OLD_STATUS_STATUS_NUM_mean",
    _g(_OM, f"max(sev) FILTER (WHERE {_OM})") + " AS OLD_STATUS_STATUS_NUM_max",
    f"nullif(count(MONTHS_BALANCE) FILTER (WHERE {_OM}), 0) AS OLD_MONTHS_COUNT",
    "CASE WHEN count(*) >= 6 THEN avg(sev) FILTER (WHERE rn_a > n - 6) - avg(sev) FILTER (WHERE rn_a <= 6)"
    " ELSE 0 END AS PAYMENT_STATUS_TREND",
    "coalesce(min(rn_d) FILTER (WHERE STATUS NOT IN ('C', 'X', '0')) - 1, count(*)) AS CONSECUTIVE_GOOD_MONTHS",
]
_alias = lambda e: e.rsplit(" AS ", 1)[1]
_OUT = [_alias(e) for e in _b_sel] + ["BUREAU_DEBT_CREDIT_RATIO", "BUREAU_ACTIVE_RATIO"] + \
    [_alias(e) for e in _bb_sel] + ["RECENT_TO_OLD_CREDIT_RATIO", "STATUS_IMPROVEMENT"]
_INTS = {"BUREAU_LOAN_COUNT", "DAYS_CREDIT_min", "DAYS_CREDIT_max", "CREDIT_DAY_OVERDUE_max", "CNT_CREDIT_PROLONG_sum",
         "CNT_CREDIT_PROLONG_max", "BUREAU_ACTIVE_LOANS", "BUREAU_CLOSED_LOANS", "BUREAU_CREDIT_TYPE_COUNT",
         "RECENT_CREDIT_DAY_OVERDUE_max", "RECENT_CREDIT_COUNT", "OLD_CREDIT_COUNT",
         "BUREAU_MONTHS_BALANCE_min", "BUREAU_MONTHS_BALANCE_max", "BUREAU_BALANCE_MONTHS", "STATUS_NUMERIC_max",
         "STATUS_NUMERIC_sum", "RECENT_STATUS_STATUS_NUM_max", "RECENT_STATUS_STATUS_NUM_sum", "RECENT_MONTHS_COUNT",
         "OLD_STATUS_STATUS_NUM_max", "OLD_MONTHS_COUNT", "CONSECUTIVE_GOOD_MONTHS"}
_final = ", ".join(
    f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" if c in _INTS
    else f"coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 0.0) AS {c}" for c in _OUT)

sql("credit_bureau_family", f"""
WITH bureau AS (
  SELECT u AS SK_ID_BUREAU, id AS SK_ID_CURR, day AS DAYS_CREDIT, u % 30 AS CREDIT_DAY_OVERDUE, amt AS AMT_CREDIT_SUM,
         CASE WHEN status = 'O' THEN amt / 3.0::DOUBLE WHEN status = 'F' THEN 0.0::DOUBLE END AS AMT_CREDIT_SUM_DEBT,
         CASE WHEN status = 'P' THEN amt / 7.0::DOUBLE ELSE 0.0::DOUBLE END AS AMT_CREDIT_SUM_OVERDUE,
         u % 3 AS CNT_CREDIT_PROLONG,
         CASE status WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE, kind AS CREDIT_TYPE
  FROM hist),
     br AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT, SK_ID_BUREAU) AS rn_a,
                   row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT DESC, SK_ID_BUREAU DESC) AS rn_z
            FROM bureau),
     b AS (SELECT SK_ID_CURR, {", ".join(_b_sel)} FROM br GROUP BY SK_ID_CURR),
     bb AS (SELECT b2.SK_ID_CURR, l.month AS MONTHS_BALANCE, l.code AS STATUS, {_SEV.replace("STATUS", "l.code")} AS sev_raw,
                   coalesce({_SEV.replace("STATUS", "l.code")}, 0) AS sev,
                   row_number() OVER (PARTITION BY b2.SK_ID_CURR ORDER BY l.month, l.parent, l.u1, l.u2, l.u3, l.u4) AS rn_a,
                   row_number() OVER (PARTITION BY b2.SK_ID_CURR ORDER BY l.month DESC, l.parent, l.u1, l.u2, l.u3, l.u4)
                     AS rn_d,
                   count(*) OVER (PARTITION BY b2.SK_ID_CURR) AS n
            FROM bal l JOIN bureau b2 ON l.parent = b2.SK_ID_BUREAU),
     a AS (SELECT SK_ID_CURR, {", ".join(_bb_sel)} FROM bb GROUP BY SK_ID_CURR),
     j AS (SELECT b.*, AMT_CREDIT_SUM_DEBT_sum / AMT_CREDIT_SUM_sum AS BUREAU_DEBT_CREDIT_RATIO,
                  BUREAU_ACTIVE_LOANS / BUREAU_LOAN_COUNT AS BUREAU_ACTIVE_RATIO,
                  a.* EXCLUDE (SK_ID_CURR),
                  RECENT_CREDIT_COUNT / (OLD_CREDIT_COUNT + 1.0) AS RECENT_TO_OLD_CREDIT_RATIO,
                  OLD_STATUS_STATUS_NUM_mean - RECENT_STATUS_STATUS_NUM_mean AS STATUS_IMPROVEMENT
           FROM b LEFT JOIN a ON b.SK_ID_CURR = a.SK_ID_CURR)
SELECT SK_ID_CURR, {_final} FROM j""", ["hist", "bal"],
    rnd=[c for c in _OUT if c not in _INTS])


# ------------------------------------------------------------------ instalment family + oracle
@query("credit_instalment_family")
def credit_instalment_family(spark, d):
    return finish(CP.inst_features(CT.installments(spark, d), INST_TIEBREAK, joined_on_first=True))


_RP, _OP = "DAYS_INSTALMENT >= -365", "DAYS_INSTALMENT < -365"
_ia = ["count(NUM_INSTALMENT_NUMBER) AS INST_COUNT", "max(NUM_INSTALMENT_NUMBER) AS NUM_INSTALMENT_NUMBER_max"]
for _f in ["mean", "max", "min", "sum", "std"]:
    _fn = {"mean": "avg", "std": "stddev_samp"}.get(_f, _f)
    _ia.append(f"{'coalesce(sum(PAYMENT_DIFF), 0)' if _f == 'sum' else f'{_fn}(PAYMENT_DIFF)'} AS PAYMENT_DIFF_{_f}")
_ia += ["avg(PAYMENT_DELAY) AS PAYMENT_DELAY_mean", "max(PAYMENT_DELAY) AS PAYMENT_DELAY_max",
        "min(PAYMENT_DELAY) AS PAYMENT_DELAY_min", "stddev_samp(PAYMENT_DELAY) AS INST_PAYMENT_DELAY_std",
        "sum(LATE_PAYMENT) AS LATE_PAYMENT_sum", "avg(LATE_PAYMENT) AS LATE_PAYMENT_mean",
        "sum(UNDERPAYMENT) AS UNDERPAYMENT_sum", "avg(UNDERPAYMENT) AS UNDERPAYMENT_mean",
        "coalesce(sum(AMT_PAYMENT), 0) AS AMT_PAYMENT_sum", "avg(AMT_PAYMENT) AS AMT_PAYMENT_mean",
        "max(AMT_PAYMENT) AS AMT_PAYMENT_max", "min(AMT_PAYMENT) AS AMT_PAYMENT_min",
        "coalesce(sum(AMT_INSTALMENT), 0) AS AMT_INSTALMENT_sum", "avg(AMT_INSTALMENT) AS AMT_INSTALMENT_mean",
        "max(AMT_INSTALMENT) AS AMT_INSTALMENT_max",
        f"count(*) FILTER (WHERE {_RP}) AS n_recent"]
_ib = [  # gated family, raw values
    _g(_RP, f"avg(PAYMENT_DIFF) FILTER (WHERE {_RP})") + " AS RECENT_PAY_PAYMENT_DIFF_mean",
    _g(_RP, f"stddev_samp(PAYMENT_DIFF) FILTER (WHERE {_RP})") + " AS RECENT_PAY_PAYMENT_DIFF_std",
    _g(_RP, f"min(PAYMENT_DIFF) FILTER (WHERE {_RP})") + " AS RECENT_PAY_PAYMENT_DIFF_min",
    _g(_RP, f"max(PAYMENT_DIFF) FILTER (WHERE {_RP})") + " AS RECENT_PAY_PAYMENT_DIFF_max",
    _g(_RP, f"avg(PAYMENT_DELAY) FILTER (WHERE {_RP})") + " AS RECENT_PAY_PAYMENT_DELAY_mean",
    _g(_RP, f"max(PAYMENT_DELAY) FILTER (WHERE {_RP})") + " AS RECENT_PAY_PAYMENT_DELAY_max",
    _g(_RP, f"coalesce(sum(PAYMENT_DELAY) FILTER (WHERE {_RP}), 0)") + " AS RECENT_PAY_PAYMENT_DELAY_sum",
    _g(_RP, f"sum(LATE_PAYMENT) FILTER (WHERE {_RP})") + " AS RECENT_PAY_LATE_PAYMENT_sum",
    _g(_RP, f"avg(LATE_PAYMENT) FILTER (WHERE {_RP})") + " AS RECENT_PAY_LATE_PAYMENT_mean",
    _g(_RP, f"sum(UNDERPAYMENT) FILTER (WHERE {_RP})") + " AS RECENT_PAY_UNDERPAYMENT_sum",
    _g(_RP, f"avg(UNDERPAYMENT) FILTER (WHERE {_RP})") + " AS RECENT_PAY_UNDERPAYMENT_mean",
    _g(_RP, f"count(NUM_INSTALMENT_NUMBER) FILTER (WHERE {_RP})") + " AS RECENT_PAY_NUM_INSTALMENT_NUMBER_count",
    _g(_OP, f"avg(PAYMENT_DELAY) FILTER (WHERE {_OP})") + " AS OLD_PAY_PAYMENT_DELAY_mean",
    _g(_OP, f"max(PAYMENT_DELAY) FILTER (WHERE {_OP})") + " AS OLD_PAY_PAYMENT_DELAY_max",
    _g(_OP, f"avg(LATE_PAYMENT) FILTER (WHERE {_OP})") + " AS OLD_PAY_LATE_PAYMENT_mean",
    _g(_OP, f"count(NUM_INSTALMENT_NUMBER) FILTER (WHERE {_OP})") + " AS OLD_PAY_NUM_INSTALMENT_NUMBER_count",
    "CASE WHEN count(*) >= 6 THEN avg(PAYMENT_DELAY) FILTER (WHERE rn_a > n // 2)"
    " - avg(PAYMENT_DELAY) FILTER (WHERE rn_a <= n // 2) ELSE 0 END AS PAYMENT_DELAY_TREND",
    "stddev_samp(PAYMENT_DELAY) AS PAYMENT_DELAY_STD",
    "CASE WHEN count(*) >= 3 THEN avg(LATE_PAYMENT) FILTER (WHERE rn_d <= 3) ELSE 0 END AS LAST_3_PAYMENTS_LATE_RATE",
]
_I_INTS = {"INST_COUNT", "NUM_INSTALMENT_NUMBER_max", "LATE_PAYMENT_sum", "UNDERPAYMENT_sum",
           "RECENT_PAY_LATE_PAYMENT_sum", "RECENT_PAY_UNDERPAYMENT_sum", "RECENT_PAY_NUM_INSTALMENT_NUMBER_count",
           "OLD_PAY_NUM_INSTALMENT_NUMBER_count"}
_I_A = [_alias(e) for e in _ia if not e.endswith("n_recent")] + ["INST_PAYMENT_RATIO"]
_I_B = [_alias(e) for e in _ib] + ["PAYMENT_IMPROVEMENT"]


def _cast(c):
    return f"CAST({c} AS BIGINT)" if c in _I_INTS else c


sql("credit_instalment_family", f"""
WITH ip AS (
  SELECT id AS SK_ID_CURR, u0 AS SK_ID_PREV, num AS NUM_INSTALMENT_NUMBER, due_day AS DAYS_INSTALMENT,
         CAST(entry_day AS DOUBLE) AS DAYS_ENTRY_PAYMENT, due AS AMT_INSTALMENT,
         CASE WHEN entry_day IS NOT NULL THEN paid END AS AMT_PAYMENT, u2, u3, u4
  FROM inst),
     x AS (SELECT *, AMT_PAYMENT - AMT_INSTALMENT AS PAYMENT_DIFF, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS PAYMENT_DELAY,
                  CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN 1 ELSE 0 END AS LATE_PAYMENT,
                  CASE WHEN AMT_PAYMENT - AMT_INSTALMENT < 0 THEN 1 ELSE 0 END AS UNDERPAYMENT,
                  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_INSTALMENT, SK_ID_PREV, NUM_INSTALMENT_NUMBER,
                                     u2, u3, u4) AS rn_a,
                  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_INSTALMENT DESC, SK_ID_PREV,
                                     NUM_INSTALMENT_NUMBER, u2, u3, u4) AS rn_d,
                  count(*) OVER (PARTITION BY SK_ID_CURR) AS n
           FROM ip),
     g AS (SELECT SK_ID_CURR, {", ".join(_ia + _ib)} FROM x GROUP BY SK_ID_CURR),
     h AS (SELECT *, AMT_PAYMENT_sum / AMT_INSTALMENT_sum AS INST_PAYMENT_RATIO,
                  OLD_PAY_PAYMENT_DELAY_mean - RECENT_PAY_PAYMENT_DELAY_mean AS PAYMENT_IMPROVEMENT FROM g)
SELECT SK_ID_CURR, {", ".join(f"{_cast(c)} AS {c}" for c in _I_A)},
       {", ".join(f"CASE WHEN n_recent > 0 THEN {_cast(f'coalesce({c}, 0)')} END AS {c}" for c in _I_B)}
FROM h""", ["inst"], rnd=[c for c in _I_A + _I_B if c not in _I_INTS])


# ------------------------------------------------------------------ card-velocity family + oracle
@query("credit_card_family")
def credit_card_family(spark, d):
    return finish(CP.cc_features(CT.credit_card(spark, d)))


_RC, _BC = "MONTHS_BALANCE >= -6", "MONTHS_BALANCE >= -12 AND MONTHS_BALANCE < -6"
_ca = ["min(MONTHS_BALANCE) AS CC_MONTHS_BALANCE_min", "max(MONTHS_BALANCE) AS CC_MONTHS_BALANCE_max",
       "count(*) AS CC_MONTHS_COUNT", "avg(AMT_BALANCE) AS AMT_BALANCE_mean", "max(AMT_BALANCE) AS AMT_BALANCE_max",
       "min(AMT_BALANCE) AS AMT_BALANCE_min", "coalesce(sum(AMT_BALANCE), 0) AS AMT_BALANCE_sum",
       "avg(AMT_CREDIT_LIMIT_ACTUAL) AS AMT_CREDIT_LIMIT_ACTUAL_mean",
       "max(AMT_CREDIT_LIMIT_ACTUAL) AS AMT_CREDIT_LIMIT_ACTUAL_max",
       "min(AMT_CREDIT_LIMIT_ACTUAL) AS AMT_CREDIT_LIMIT_ACTUAL_min"]
for _m, _p in [(m, "") for m in CP.CC_SUMS] + [("SK_DPD", "CC_"), ("SK_DPD_DEF", "CC_")]:
    _ca += [f"avg({_m}) AS {_p}{_m}_mean", f"max({_m}) AS {_p}{_m}_max", f"coalesce(sum({_m}), 0) AS {_p}{_m}_sum"]
_ca.append(f"count(*) FILTER (WHERE {_RC}) AS n_recent")
_cb = []
for _m, _fs in [("AMT_DRAWINGS_CURRENT", ["sum", "mean", "max"]), ("AMT_PAYMENT_CURRENT", ["sum", "mean", "max"]),
                ("AMT_BALANCE", ["mean", "max"]), ("UTILIZATION", ["mean", "max"]), ("SK_DPD", ["max", "sum", "mean"]),
                ("SK_DPD_DEF", ["max", "sum"]), ("MONTHS_BALANCE", ["count"])]:
    for _f in _fs:
        _e = {"sum": f"coalesce(sum({_m}) FILTER (WHERE {_RC}), 0)", "mean": f"avg({_m}) FILTER (WHERE {_RC})",
              "max": f"max({_m}) FILTER (WHERE {_RC})", "count": f"count({_m}) FILTER (WHERE {_RC})"}[_f]
        _cb.append(_g(_RC, _e) + f" AS CC_RECENT_{_m}_{_f}")
for _m, _f in [("AMT_DRAWINGS_CURRENT", "mean"), ("AMT_DRAWINGS_CURRENT", "max"), ("AMT_PAYMENT_CURRENT", "mean"),
               ("UTILIZATION", "mean"), ("SK_DPD", "mean")]:
    _fn = "avg" if _f == "mean" else _f
    _cb.append(_g(_BC, f"{_fn}({_m}) FILTER (WHERE {_BC})") + f" AS CC_OLD_{_m}_{_f}")
_cb += [
    "CASE WHEN count(*) >= 3 THEN (avg(AMT_DRAWINGS_CURRENT) FILTER (WHERE rn_d <= 3)"
    " - avg(AMT_DRAWINGS_CURRENT) FILTER (WHERE rn_a <= 3)) / (avg(AMT_DRAWINGS_CURRENT) FILTER (WHERE rn_a <= 3) + 1)"
    " ELSE 0 END AS CC_SPENDING_TREND",
    "CASE WHEN count(*) >= 3 THEN avg(UTILIZATION) FILTER (WHERE rn_a > n - 3)"
    " - avg(UTILIZATION) FILTER (WHERE rn_a <= 3) ELSE 0 END AS CC_UTILIZATION_TREND",
    "CASE WHEN count(*) < 3 THEN 1.0 ELSE"
    " coalesce(sum(AMT_PAYMENT_CURRENT) FILTER (WHERE rn_a > n - 3), 0)"
    " / (coalesce(sum(AMT_DRAWINGS_CURRENT) FILTER (WHERE rn_a > n - 3), 0) + 1)"
    " - coalesce(sum(AMT_PAYMENT_CURRENT) FILTER (WHERE rn_a <= 3), 0)"
    " / (coalesce(sum(AMT_DRAWINGS_CURRENT) FILTER (WHERE rn_a <= 3), 0) + 1) END AS CC_PAYMENT_DRAWING_TREND",
    "CASE WHEN count(*) >= 3 THEN avg(SK_DPD) FILTER (WHERE rn_a > n - 3)"
    " - avg(SK_DPD) FILTER (WHERE rn_a <= 3) ELSE 0 END AS CC_DPD_TREND",
]
_C_INTS = {"CC_MONTHS_BALANCE_min", "CC_MONTHS_BALANCE_max", "CC_MONTHS_COUNT", "CNT_DRAWINGS_CURRENT_max",
           "CNT_DRAWINGS_CURRENT_sum", "CC_SK_DPD_max", "CC_SK_DPD_sum", "CC_SK_DPD_DEF_max", "CC_SK_DPD_DEF_sum",
           "CC_RECENT_SK_DPD_max", "CC_RECENT_SK_DPD_sum", "CC_RECENT_SK_DPD_DEF_max", "CC_RECENT_SK_DPD_DEF_sum",
           "CC_RECENT_MONTHS_BALANCE_count"}
_C_A = [_alias(e) for e in _ca if not e.endswith("n_recent")] + ["CC_UTILIZATION_MEAN", "CC_UTILIZATION_MAX",
                                                                 "CC_PAYMENT_DRAWING_RATIO"]
_C_B = [_alias(e) for e in _cb] + ["CC_UTILIZATION_IMPROVEMENT", "CC_SPENDING_ACCELERATION"]


def _ccast(c):
    return f"CAST({c} AS BIGINT)" if c in _C_INTS else c


def _nan_null(e):
    return f"CASE WHEN isnan({e}) THEN NULL ELSE {e} END"


sql("credit_card_family", f"""
WITH cc AS (
  SELECT id AS SK_ID_CURR, u AS SK_ID_PREV, period AS MONTHS_BALANCE, bal AS AMT_BALANCE,
         lim AS AMT_CREDIT_LIMIT_ACTUAL, draw AS AMT_DRAWINGS_CURRENT, draw * 0.3 AS AMT_DRAWINGS_ATM_CURRENT,
         draw * 0.7 AS AMT_DRAWINGS_POS_CURRENT, pay AS AMT_PAYMENT_CURRENT,
         CAST(draw > 0 AS BIGINT) AS CNT_DRAWINGS_CURRENT, dpd AS SK_DPD, CAST(0 AS BIGINT) AS SK_DPD_DEF
  FROM monthly),
     x AS (SELECT *, AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 1) AS UTILIZATION,
                  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY MONTHS_BALANCE, SK_ID_PREV) AS rn_a,
                  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY MONTHS_BALANCE DESC, SK_ID_PREV) AS rn_d,
                  count(*) OVER (PARTITION BY SK_ID_CURR) AS n
           FROM cc),
     g AS (SELECT SK_ID_CURR, {", ".join(_ca + _cb)} FROM x GROUP BY SK_ID_CURR),
     h AS (SELECT *, {_nan_null("AMT_BALANCE_mean / AMT_CREDIT_LIMIT_ACTUAL_mean")} AS CC_UTILIZATION_MEAN,
                  {_nan_null("AMT_BALANCE_max / AMT_CREDIT_LIMIT_ACTUAL_max")} AS CC_UTILIZATION_MAX,
                  {_nan_null("AMT_PAYMENT_CURRENT_sum / AMT_DRAWINGS_CURRENT_sum")} AS CC_PAYMENT_DRAWING_RATIO,
                  CC_OLD_UTILIZATION_mean - CC_RECENT_UTILIZATION_mean AS CC_UTILIZATION_IMPROVEMENT,
                  CC_RECENT_AMT_DRAWINGS_CURRENT_mean - CC_OLD_AMT_DRAWINGS_CURRENT_mean AS CC_SPENDING_ACCELERATION
           FROM g)
SELECT SK_ID_CURR, {", ".join(f"{_ccast(c)} AS {c}" for c in _C_A)},
       {", ".join(f"CASE WHEN n_recent > 0 THEN {_ccast(f'coalesce({c}, 0)')} END AS {c}" for c in _C_B)}
FROM h""", ["monthly"], rnd=[c for c in _C_A + _C_B if c not in _C_INTS])


# ------------------------------------------------------------------ previous-application family + oracle
@query("credit_prev_family")
def credit_prev_family(spark, d):
    return finish(CP.prev_features(CT.previous_application(spark, d)))


_pa = ["count(SK_ID_PREV) AS PREV_APP_COUNT"]
for _m, _fs in [("AMT_CREDIT", ["mean", "max", "sum", "min"]), ("AMT_APPLICATION", ["mean", "max", "min"]),
                ("AMT_DOWN_PAYMENT", ["mean", "max"]), ("DAYS_DECISION", ["min", "max", "mean"]),
                ("CNT_PAYMENT", ["mean", "max", "sum"]), ("RATE_DOWN_PAYMENT", ["mean", "max"])]:
    for _f in _fs:
        _pa.append({"mean": f"avg({_m})", "sum": f"coalesce(sum({_m}), 0)"}.get(_f, f"{_f}({_m})") + f" AS {_m}_{_f}")
_pa += [f"nullif(count(*) FILTER (WHERE NAME_CONTRACT_STATUS = '{v}'), 0) AS PREV_{n}_COUNT"
        for n, v in [("APPROVED", "Approved"), ("REFUSED", "Refused"), ("CANCELED", "Canceled")]]
_pa += ["nullif(count(*) FILTER (WHERE NAME_CONTRACT_TYPE = 'Cash loans'), 0) AS PREV_CASH_LOAN_COUNT",
        "coalesce(CASE WHEN count(*) >= 2 THEN avg(gap) ELSE 0 END, 0) AS AVG_TIME_BETWEEN_APPS",
        "coalesce(CASE WHEN count(*) >= 2 THEN (max(AMT_CREDIT) FILTER (WHERE rn_z = 1) - max(AMT_CREDIT) FILTER"
        " (WHERE rn_a = 1)) / nullif(max(AMT_CREDIT) FILTER (WHERE rn_a = 1) + 1, 0) ELSE 0 END, 0)"
        " AS PREV_LOAN_AMOUNT_TREND",
        "count(*) FILTER (WHERE rn_d <= 3 AND NAME_CONTRACT_STATUS = 'Approved') / least(3, count(*))"
        " AS RECENT_APPROVAL_RATE",
        "coalesce(CASE WHEN count(*) <= 3 THEN 0.0 ELSE avg(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0"
        " END) FILTER (WHERE rn_a <= n - 3) END, 0) AS OLD_APPROVAL_RATE",
        "coalesce(CASE WHEN count(*) < 2 THEN 0.0 ELSE stddev_samp(AMT_APPLICATION)"
        " / nullif(avg(AMT_APPLICATION) + 1, 0) END, 0) AS PREV_AMOUNT_VOLATILITY",
        "coalesce(CASE WHEN count(*) < 2 THEN 0.0 ELSE (avg(AMT_DOWN_PAYMENT) FILTER (WHERE rn_d <= 3)"
        " - avg(AMT_DOWN_PAYMENT) FILTER (WHERE rn_a <= 3)) / nullif(avg(AMT_DOWN_PAYMENT) FILTER (WHERE rn_a <= 3) + 1, 0)"
        " END, 0) AS DOWN_PAYMENT_TREND"]
_P_INTS = {"PREV_APP_COUNT", "DAYS_DECISION_min", "DAYS_DECISION_max", "PREV_APPROVED_COUNT", "PREV_REFUSED_COUNT",
           "PREV_CANCELED_COUNT", "PREV_CASH_LOAN_COUNT"}
_P_OUT = [_alias(e) for e in _pa] + ["PREV_APPROVAL_RATE", "PREV_REFUSAL_RATE", "APPROVAL_RATE_IMPROVEMENT"]

sql("credit_prev_family", f"""
WITH pa AS (
  SELECT u AS SK_ID_PREV, id AS SK_ID_CURR, amt AS AMT_CREDIT, amt * 1.1 AS AMT_APPLICATION,
         CASE WHEN status <> 'P' THEN amt * 0.1 END AS AMT_DOWN_PAYMENT,
         CASE WHEN status <> 'P' THEN 0.1 END AS RATE_DOWN_PAYMENT, day AS DAYS_DECISION,
         CAST(u % 24 + 6 AS DOUBLE) AS CNT_PAYMENT,
         CASE status WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
         CASE WHEN kind LIKE '1%' THEN 'Cash loans' ELSE 'Consumer loans' END AS NAME_CONTRACT_TYPE
  FROM hist),
     x AS (SELECT *, abs(DAYS_DECISION - lag(DAYS_DECISION) OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION,
                                                                   SK_ID_PREV)) AS gap,
                  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION, SK_ID_PREV) AS rn_a,
                  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC, SK_ID_PREV) AS rn_d,
                  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC, SK_ID_PREV DESC) AS rn_z,
                  count(*) OVER (PARTITION BY SK_ID_CURR) AS n
           FROM pa),
     g AS (SELECT SK_ID_CURR, {", ".join(_pa)} FROM x GROUP BY SK_ID_CURR),
     h AS (SELECT *, PREV_APPROVED_COUNT / PREV_APP_COUNT AS PREV_APPROVAL_RATE,
                  PREV_REFUSED_COUNT / PREV_APP_COUNT AS PREV_REFUSAL_RATE,
                  coalesce(RECENT_APPROVAL_RATE - OLD_APPROVAL_RATE, 0.0) AS APPROVAL_RATE_IMPROVEMENT FROM g)
SELECT SK_ID_CURR, {", ".join((f"CAST({c} AS BIGINT) AS {c}" if c in _P_INTS else c) for c in _P_OUT)} FROM h
""", ["hist"], rnd=[c for c in _P_OUT if c not in _P_INTS])


# ------------------------------------------------------------------ POS family + oracle
@query("credit_pos_family")
def credit_pos_family(spark, d):
    return finish(CP.pos_features(CT.pos_cash(spark, d)))


_RPO, _OPO = "MONTHS_BALANCE >= -6", "MONTHS_BALANCE < -6"
_qa = ["min(MONTHS_BALANCE) AS POS_MONTHS_BALANCE_min", "max(MONTHS_BALANCE) AS POS_MONTHS_BALANCE_max",
       "count(*) AS POS_MONTHS_COUNT"]
for _m in ["SK_DPD", "SK_DPD_DEF"]:
    _qa += [f"avg({_m}) AS POS_{_m}_mean", f"max({_m}) AS POS_{_m}_max", f"coalesce(sum({_m}), 0) AS POS_{_m}_sum"]
_qa += ["avg(CNT_INSTALMENT) AS CNT_INSTALMENT_mean", "max(CNT_INSTALMENT) AS CNT_INSTALMENT_max",
        "avg(CNT_INSTALMENT_FUTURE) AS CNT_INSTALMENT_FUTURE_mean", "max(CNT_INSTALMENT_FUTURE) AS CNT_INSTALMENT_FUTURE_max",
        "coalesce(sum(CNT_INSTALMENT_FUTURE), 0) AS CNT_INSTALMENT_FUTURE_sum",
        "nullif(count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Active'), 0) AS POS_ACTIVE_COUNT",
        "nullif(count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Completed'), 0) AS POS_COMPLETED_COUNT",
        f"count(*) FILTER (WHERE {_RPO}) AS n_recent"]
_qb = [_g(_RPO, f"avg(SK_DPD) FILTER (WHERE {_RPO})") + " AS POS_RECENT_SK_DPD_mean",
       _g(_RPO, f"max(SK_DPD) FILTER (WHERE {_RPO})") + " AS POS_RECENT_SK_DPD_max",
       _g(_RPO, f"coalesce(sum(SK_DPD) FILTER (WHERE {_RPO}), 0)") + " AS POS_RECENT_SK_DPD_sum",
       _g(_RPO, f"avg(SK_DPD_DEF) FILTER (WHERE {_RPO})") + " AS POS_RECENT_SK_DPD_DEF_mean",
       _g(_RPO, f"max(SK_DPD_DEF) FILTER (WHERE {_RPO})") + " AS POS_RECENT_SK_DPD_DEF_max",
       _g(_RPO, f"avg(CNT_INSTALMENT_FUTURE) FILTER (WHERE {_RPO})") + " AS POS_RECENT_CNT_INSTALMENT_FUTURE_mean",
       _g(_OPO, f"avg(SK_DPD) FILTER (WHERE {_OPO})") + " AS POS_OLD_SK_DPD_mean",
       _g(_OPO, f"max(SK_DPD) FILTER (WHERE {_OPO})") + " AS POS_OLD_SK_DPD_max",
       _g(_OPO, f"avg(SK_DPD_DEF) FILTER (WHERE {_OPO})") + " AS POS_OLD_SK_DPD_DEF_mean",
       "CASE WHEN count(*) >= 3 THEN avg(SK_DPD) FILTER (WHERE rn_a > n - 3) - avg(SK_DPD) FILTER (WHERE rn_a <= 3)"
       " ELSE 0 END AS POS_DPD_TREND"]
_Q_INTS = {"POS_MONTHS_BALANCE_min", "POS_MONTHS_BALANCE_max", "POS_MONTHS_COUNT", "POS_SK_DPD_max", "POS_SK_DPD_sum",
           "POS_SK_DPD_DEF_max", "POS_SK_DPD_DEF_sum", "POS_ACTIVE_COUNT", "POS_COMPLETED_COUNT",
           "POS_RECENT_SK_DPD_max", "POS_RECENT_SK_DPD_sum", "POS_RECENT_SK_DPD_DEF_max", "POS_OLD_SK_DPD_max"}
_Q_A = [_alias(e) for e in _qa if not e.endswith("n_recent")] + ["POS_COMPLETION_RATE"]
_Q_B = [_alias(e) for e in _qb] + ["POS_DPD_IMPROVEMENT"]


def _qcast(c):
    return f"CAST({c} AS BIGINT)" if c in _Q_INTS else c


sql("credit_pos_family", f"""
WITH pc AS (
  SELECT m.id AS SK_ID_CURR, m.u AS SK_ID_PREV, m.period AS MONTHS_BALANCE, m.dpd * 5 AS SK_DPD, m.dpd AS SK_DPD_DEF,
         m.bal AS CNT_INSTALMENT, m.bal / 2.0 AS CNT_INSTALMENT_FUTURE,
         CASE WHEN e.event_type = 'view' THEN 'Completed' ELSE 'Active' END AS NAME_CONTRACT_STATUS
  FROM monthly m JOIN events e ON m.u = e.event_id),
     x AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY MONTHS_BALANCE, SK_ID_PREV) AS rn_a,
                  count(*) OVER (PARTITION BY SK_ID_CURR) AS n FROM pc),
     g AS (SELECT SK_ID_CURR, {", ".join(_qa + _qb)} FROM x GROUP BY SK_ID_CURR),
     h AS (SELECT *, POS_COMPLETED_COUNT / POS_MONTHS_COUNT AS POS_COMPLETION_RATE,
                  POS_OLD_SK_DPD_mean - POS_RECENT_SK_DPD_mean AS POS_DPD_IMPROVEMENT FROM g)
SELECT SK_ID_CURR, {", ".join(f"{_qcast(c)} AS {c}" for c in _Q_A)},
       {", ".join(f"CASE WHEN n_recent > 0 THEN {_qcast(f'coalesce({c}, 0)')} END AS {c}" for c in _Q_B)}
FROM h""", ["monthly"], rnd=[c for c in _Q_A + _Q_B if c not in _Q_INTS])


# ------------------------------------------------------------------ the whole pack
_APP_INTS = ["TARGET", "DAYS_BIRTH", "DAYS_EMPLOYED", "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_MOBIL", "FLAG_EMAIL", "FLAG_PHONE",
             "REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY", "DAYS_EMPLOYED_ANOMALY", "DOCUMENT_COUNT", "CONTACT_INFO_COUNT",
             "REGION_RISK_SCORE", "TOTAL_CREDIT_EXPERIENCE", "CREDIT_ACTIVITY_SCORE"] + [f"{c}_MISSING" for c in CP.MISSING_FLAG_COLS]
_APP_FLOATS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", *CP.EXT, "CNT_FAM_MEMBERS", "OWN_CAR_AGE",
               "APARTMENTS_AVG", "YEARS_BUILD_AVG", "AGE_YEARS", "EMPLOYMENT_YEARS", "INCOME_CREDIT_RATIO", "ANNUITY_INCOME_RATIO",
               "CREDIT_GOODS_RATIO", "EXT_SOURCE_MEAN", "EXT_SOURCE_MAX", "EXT_SOURCE_MIN", "EXT_SOURCE_PROD", "EXT_SOURCE_WEIGHTED",
               "INCOME_PER_FAMILY_MEMBER", "CREDIT_INCOME_PERCENT", "ANNUITY_CREDIT_PERCENT", "WORKING_AGE_RATIO", "INCOME_PER_AGE",
               "AVG_CREDIT_PER_BUREAU_LOAN", "APPROVAL_SUCCESS_RATE", "BUREAU_TO_PREV_RATIO", "LATE_PAYMENT_RATIO", "CREDIT_PER_INCOME",
               "DEBT_PER_EXPERIENCE", "RISK_SCORE_1", "RISK_SCORE_2", "EXT_SOURCE_INCOME_INTERACTION", "EXT_SOURCE_CREDIT_INTERACTION"]
_APP_FLOATS += [f"{c}_{k}" for c in CP.EXT for k in ("SQUARED", "CUBED", "SQRT", "LOG")]
_FAMILY = [(_OUT, _INTS), (_P_OUT, _P_INTS), (_I_A + _I_B, _I_INTS), (_Q_A + _Q_B, _Q_INTS), (_C_A + _C_B, _C_INTS)]
_PACK_INTS = _APP_INTS + [c for cols, ints in _FAMILY for c in cols if c in ints]
_PACK_FLOATS = _APP_FLOATS + [c for cols, ints in _FAMILY for c in cols if c not in ints]


def _log1p(e):
    return f"CASE WHEN {e} > -1 THEN ln(1 + {e}) END"


_ext0 = "coalesce(EXT_SOURCE_MEAN, 0.5)"
_scores = ", ".join(f"power(coalesce({c}, 0.0), 2) AS {c}_SQUARED, power(coalesce({c}, 0.0), 3) AS {c}_CUBED, "
                    f"CASE WHEN coalesce({c}, 0.0) >= 0 THEN sqrt(coalesce({c}, 0.0)) END AS {c}_SQRT, "
                    f"{_log1p(f'coalesce({c}, 0.0)')} AS {c}_LOG" for c in CP.EXT)


def _zero_one(c, default):
    return f"coalesce(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, 0.0), 1.0) END, {default})"


_pack_families = {"fb": "credit_bureau_family", "fp": "credit_prev_family", "fi": "credit_instalment_family", "fo": "credit_pos_family",
                  "fc": "credit_card_family"}
ROUNDED["credit_pack"] = tuple(_PACK_FLOATS)
ORACLE["credit_pack"] = f"""
WITH raw AS (
  SELECT c_custkey AS k, c_acctbal AS bal, CAST(c_nationkey AS BIGINT) AS nat, c_mktsegment AS seg,
         CAST(c_nationkey + 1 AS DOUBLE) * 10000.0::DOUBLE + abs(c_acctbal) AS credit FROM customer),
app AS (
  SELECT k AS SK_ID_CURR, CAST(k % 10 = 0 AS BIGINT) AS TARGET, abs(bal) * 10.0::DOUBLE + 1000.0::DOUBLE AS AMT_INCOME_TOTAL,
         credit AS AMT_CREDIT, CASE WHEN k % 11 <> 0 THEN credit / 20.0::DOUBLE END AS AMT_ANNUITY,
         CASE WHEN k % 17 <> 0 THEN credit * 0.9::DOUBLE END AS AMT_GOODS_PRICE, -(7000 + k % 15000) AS DAYS_BIRTH,
         CASE WHEN k % 13 = 0 THEN 365243 ELSE -(k % 5000) END AS DAYS_EMPLOYED,
         CASE WHEN k % 3 <> 0 THEN abs(bal) / 10000.0::DOUBLE END AS EXT_SOURCE_1,
         CASE WHEN k % 5 <> 0 THEN CAST(k % 100 AS DOUBLE) / 100.0::DOUBLE END AS EXT_SOURCE_2,
         CASE WHEN k % 7 <> 0 THEN CAST(nat AS DOUBLE) / 25.0::DOUBLE END AS EXT_SOURCE_3,
         CASE WHEN k % 19 <> 0 THEN CAST(nat % 5 + 1 AS DOUBLE) END AS CNT_FAM_MEMBERS,
         k % 2 AS FLAG_DOCUMENT_2, CAST(k % 3 = 0 AS BIGINT) AS FLAG_DOCUMENT_3, 1 AS FLAG_MOBIL,
         CAST(k % 4 = 0 AS BIGINT) AS FLAG_EMAIL, CAST(k % 5 = 0 AS BIGINT) AS FLAG_PHONE,
         nat % 3 + 1 AS REGION_RATING_CLIENT, (nat + k) % 3 + 1 AS REGION_RATING_CLIENT_W_CITY,
         CASE WHEN k % 4 = 0 THEN CAST(k % 20 AS DOUBLE) END AS OWN_CAR_AGE, CASE WHEN k % 6 <> 0 THEN seg END AS OCCUPATION_TYPE,
         CASE WHEN k % 8 <> 0 THEN abs(bal) / 10000.0::DOUBLE END AS APARTMENTS_AVG,
         CASE WHEN k % 9 <> 0 THEN CAST(k % 40 AS DOUBLE) / 40.0::DOUBLE END AS YEARS_BUILD_AVG
  FROM raw),
bas AS (
  SELECT *, -DAYS_BIRTH / 365.0::DOUBLE AS AGE_YEARS, -DAYS_EMPLOYED / 365.0::DOUBLE AS EMPLOYMENT_YEARS,
         AMT_INCOME_TOTAL / AMT_CREDIT AS INCOME_CREDIT_RATIO, AMT_ANNUITY / AMT_INCOME_TOTAL AS ANNUITY_INCOME_RATIO,
         AMT_CREDIT / AMT_GOODS_PRICE AS CREDIT_GOODS_RATIO,
         list_avg([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS EXT_SOURCE_MEAN,
         greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3) AS EXT_SOURCE_MAX,
         least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3) AS EXT_SOURCE_MIN,
         CAST(DAYS_EMPLOYED = 365243 AS BIGINT) AS DAYS_EMPLOYED_ANOMALY
  FROM app),
{", ".join(f"{a} AS ({ORACLE[n]})" for a, n in _pack_families.items())},
med AS (SELECT REGION_RATING_CLIENT AS r, median(APARTMENTS_AVG) AS ma, median(YEARS_BUILD_AVG) AS my FROM app GROUP BY 1),
j AS (
  SELECT bas.* REPLACE (coalesce(OWN_CAR_AGE, 0.0) AS OWN_CAR_AGE, coalesce(APARTMENTS_AVG, ma) AS APARTMENTS_AVG,
                        coalesce(YEARS_BUILD_AVG, my) AS YEARS_BUILD_AVG),
         {", ".join(f"CAST({c} IS NULL AS BIGINT) AS {c}_MISSING" for c in CP.MISSING_FLAG_COLS)},
         {", ".join(f"{a}.* EXCLUDE (SK_ID_CURR)" for a in _pack_families)}
  FROM bas LEFT JOIN med ON med.r = bas.REGION_RATING_CLIENT
  {" ".join(f"LEFT JOIN {a} ON {a}.SK_ID_CURR = bas.SK_ID_CURR" for a in _pack_families)}),
x AS (
  SELECT *, EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3 AS EXT_SOURCE_PROD,
         0.4 * coalesce(EXT_SOURCE_1, 0) + 0.4 * coalesce(EXT_SOURCE_2, 0) + 0.2 * coalesce(EXT_SOURCE_3, 0) AS EXT_SOURCE_WEIGHTED,
         AMT_INCOME_TOTAL / (CNT_FAM_MEMBERS + 1) AS INCOME_PER_FAMILY_MEMBER, AMT_CREDIT / AMT_INCOME_TOTAL AS CREDIT_INCOME_PERCENT,
         AMT_ANNUITY / AMT_CREDIT AS ANNUITY_CREDIT_PERCENT, EMPLOYMENT_YEARS / AGE_YEARS AS WORKING_AGE_RATIO,
         AMT_INCOME_TOTAL / AGE_YEARS AS INCOME_PER_AGE, FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3 AS DOCUMENT_COUNT,
         FLAG_MOBIL + FLAG_PHONE + FLAG_EMAIL AS CONTACT_INFO_COUNT,
         REGION_RATING_CLIENT * REGION_RATING_CLIENT_W_CITY AS REGION_RISK_SCORE,
         AMT_CREDIT / (BUREAU_LOAN_COUNT + 1) AS AVG_CREDIT_PER_BUREAU_LOAN, PREV_APPROVAL_RATE AS APPROVAL_SUCCESS_RATE,
         coalesce(BUREAU_LOAN_COUNT, 0) + coalesce(PREV_APP_COUNT, 0) AS TOTAL_CREDIT_EXPERIENCE,
         coalesce(BUREAU_LOAN_COUNT, 0) / (coalesce(PREV_APP_COUNT, 0) + 1) AS BUREAU_TO_PREV_RATIO,
         coalesce(LATE_PAYMENT_sum, 0) / (coalesce(INST_COUNT, 0) + 1) AS LATE_PAYMENT_RATIO,
         coalesce(PREV_APPROVED_COUNT, 0) + coalesce(BUREAU_ACTIVE_LOANS, 0) AS CREDIT_ACTIVITY_SCORE,
         AMT_CREDIT / AMT_INCOME_TOTAL AS CREDIT_PER_INCOME,
         AMT_CREDIT / (coalesce(BUREAU_LOAN_COUNT, 0) + coalesce(PREV_APP_COUNT, 0) + 1) AS DEBT_PER_EXPERIENCE,
         0.5 * {_ext0} + 0.3 * (AGE_YEARS / 100.0) + 0.2 * (1.0 - {_zero_one("ANNUITY_INCOME_RATIO", 0.2)}) AS RISK_SCORE_1,
         0.4 * {_ext0} + 0.3 * (1.0 - {_zero_one("BUREAU_DEBT_CREDIT_RATIO", 0.3)})
           + 0.3 * (1.0 - {_zero_one("LATE_PAYMENT_mean", 0.0)}) AS RISK_SCORE_2,
         {_scores}, {_ext0} * {_log1p("AMT_INCOME_TOTAL")} AS EXT_SOURCE_INCOME_INTERACTION,
         {_ext0} * {_log1p("AMT_CREDIT")} AS EXT_SOURCE_CREDIT_INTERACTION
  FROM j)
SELECT SK_ID_CURR, OCCUPATION_TYPE, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in _PACK_INTS)},
       {", ".join(f"CAST(coalesce(CASE WHEN isnan({c}::DOUBLE) OR isinf({c}::DOUBLE) THEN NULL ELSE {c} END, 0.0) AS DOUBLE) AS {c}" for c in _PACK_FLOATS)}
FROM x"""
