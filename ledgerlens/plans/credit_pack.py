"""Credit pack: the reference's complete feature contract.

Input: seven reference-shaped tables (application spine + six fact tables).
Output: the spine with 271 derived features (162 "enhanced" + 109
"optimized"), i.e. 391 features for a 120-column application table.

Design
------
* One aggregation per fact table: the rollup family, its recency slices and
  its ordered trends are conditional aggregates of a single
  ``groupBy(SK_ID_CURR)``; ordered trends read the row numbers of
  ``ordered.with_order_ranks`` (the history of a very large entity is not sorted
  by one task). bureau_balance reaches the customer through a two-hop key lookup.
* Rows go to their customer once, with raw columns only, and are numbered and
  aggregated there: aggregation buffers, several times as wide as a row, are not
  exchanged. Every feature frame stays hash-partitioned on the key for the spine join.
* Semantics of the reference are kept where they are observable: pandas sums
  of empty groups are 0, conditional counts of an absent status are missing,
  ratios divide IEEE-style (±inf until the final clean-up, which clipped
  scores can see), each family is filled with 0 exactly where the reference
  fills it, and a slice-based family only covers entities with recent rows.
* Name collisions of the reference (merge suffixes ``_x``/``_y`` and one
  case-only clash) are resolved with source prefixes; ``REFERENCE_NAMES`` maps
  them back.

Deliberate deviations: NULL instead of NaN; unique tiebreaks for ties; the
eight bureau status shares are always emitted; missing indicators are always
emitted; cross-table features of a spine use that spine's own rollups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators import ordered as O, prep as P, rollup as R
from ledgerlens.operators.joins import attach_key, spine_join

KEY = "SK_ID_CURR"

# ---------------------------------------------------------------- fixed values
# (must equal the reference)
STATUS_CODES = ["0", "1", "2", "3", "4", "5", "C", "X"]
STATUS_SEVERITY = {"C": 0, "X": 0, "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5}
GOOD_STATUS = ["C", "X", "0"]
EMPLOYED_SENTINEL = 365243
CONTACT_FLAGS = ["FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"]
MISSING_FLAG_COLS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_ANNUITY", "OWN_CAR_AGE", "OCCUPATION_TYPE"]
BUILDING_PATTERNS = ["APARTMENTS", "YEARS_BUILD", "ELEVATORS", "FLOORSMAX"]
EXT = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
RECENT_CREDIT_DAYS = -730
RECENT_PAYMENT_DAYS = -365
RECENT_MONTHS = -6
OLD_STATUS_MONTHS = -12

# our collision-safe name -> the reference's column name
REFERENCE_NAMES = {
    "BUREAU_MONTHS_BALANCE_min": "MONTHS_BALANCE_min_x", "BUREAU_MONTHS_BALANCE_max": "MONTHS_BALANCE_max_x",
    "POS_MONTHS_BALANCE_min": "MONTHS_BALANCE_min_y", "POS_MONTHS_BALANCE_max": "MONTHS_BALANCE_max_y",
    "CC_MONTHS_BALANCE_min": "MONTHS_BALANCE_min", "CC_MONTHS_BALANCE_max": "MONTHS_BALANCE_max",
    **{f"POS_{m}_{f}": f"{m}_{f}_x" for m in ("SK_DPD", "SK_DPD_DEF") for f in ("mean", "max", "sum")},
    **{f"CC_{m}_{f}": f"{m}_{f}_y" for m in ("SK_DPD", "SK_DPD_DEF") for f in ("mean", "max", "sum")},
    "INST_PAYMENT_DELAY_std": "PAYMENT_DELAY_std",
}


def _aggs(spec, prefix="", where=None, rename=None):
    return R.measure_aggs(spec, prefix=prefix, where=where, rename=rename)


def _gated(cols: Sequence[str], gate: Column) -> list[Column]:
    """A family that exists only for entities passing ``gate`` and is filled
    with 0 inside it (reference: family frame built on the gated base, then
    fillna(0); entities outside stay missing until the final clean-up)."""
    return [F.when(gate, F.coalesce(F.col(c), F.lit(0))).alias(c) for c in cols]


# ---------------------------------------------------------------- stage A rows
def basic_features(app: DataFrame) -> DataFrame:
    return app.withColumns({
        "AGE_YEARS": X.days_to_years("DAYS_BIRTH"),
        "EMPLOYMENT_YEARS": X.days_to_years("DAYS_EMPLOYED"),
        "INCOME_CREDIT_RATIO": X.ieee_div("AMT_INCOME_TOTAL", "AMT_CREDIT"),
        "ANNUITY_INCOME_RATIO": X.ieee_div("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "CREDIT_GOODS_RATIO": X.ieee_div("AMT_CREDIT", "AMT_GOODS_PRICE"),
        "EXT_SOURCE_MEAN": X.row_mean(*EXT),
        "EXT_SOURCE_MAX": X.row_max(*EXT),
        "EXT_SOURCE_MIN": X.row_min(*EXT),
        "DAYS_EMPLOYED_ANOMALY": X.sentinel_flag("DAYS_EMPLOYED", EMPLOYED_SENTINEL),
    })


# ---------------------------------------------------------------- bureau (+balance)
def bureau_features(bureau: DataFrame, bureau_balance: DataFrame,
                    bb_tiebreak: Sequence[str] = ("SK_ID_BUREAU",)) -> DataFrame:
    """37 rollup + 22 history features, one row per customer in bureau."""
    recent = F.col("DAYS_CREDIT") >= RECENT_CREDIT_DAYS
    old = F.col("DAYS_CREDIT") < RECENT_CREDIT_DAYS
    b = R.rollup(O.clustered(bureau, KEY), KEY, [
        F.count("SK_ID_BUREAU").alias("BUREAU_LOAN_COUNT"),
        *_aggs({"DAYS_CREDIT": ["min", "max", "mean"], "CREDIT_DAY_OVERDUE": ["max", "mean"],
                "AMT_CREDIT_SUM": ["sum", "mean", "max"], "AMT_CREDIT_SUM_DEBT": ["sum", "mean", "max"],
                "AMT_CREDIT_SUM_OVERDUE": ["sum", "mean", "max"], "CNT_CREDIT_PROLONG": ["sum", "mean", "max"]}),
        *R.status_counts("CREDIT_ACTIVE", {"BUREAU_ACTIVE_LOANS": "Active", "BUREAU_CLOSED_LOANS": "Closed"}),
        F.count_distinct("CREDIT_TYPE").alias("BUREAU_CREDIT_TYPE_COUNT"),
        # history (stage B)
        *_aggs({"AMT_CREDIT_SUM": ["sum", "mean", "max"], "CREDIT_DAY_OVERDUE": ["max", "mean"]}, "RECENT_", recent),
        F.nullif(F.count(F.when(recent, F.col("SK_ID_BUREAU"))), F.lit(0)).alias("RECENT_CREDIT_COUNT"),
        *_aggs({"AMT_CREDIT_SUM": ["sum", "mean"]}, "OLD_", old),
        F.nullif(F.count(F.when(old, F.col("SK_ID_BUREAU"))), F.lit(0)).alias("OLD_CREDIT_COUNT"),
        O.first_last_change("AMT_CREDIT_SUM", "DAYS_CREDIT", ["SK_ID_BUREAU"]).alias("CREDIT_AMOUNT_TREND"),
        O.first_last_change("CREDIT_DAY_OVERDUE", "DAYS_CREDIT", ["SK_ID_BUREAU"]).alias("OVERDUE_TREND"),
    ]).withColumns({
        "BUREAU_DEBT_CREDIT_RATIO": X.ieee_div("AMT_CREDIT_SUM_DEBT_sum", "AMT_CREDIT_SUM_sum"),
        "BUREAU_ACTIVE_RATIO": X.ieee_div("BUREAU_ACTIVE_LOANS", "BUREAU_LOAN_COUNT"),
    })

    bb = attach_key(bureau_balance, bureau.select("SK_ID_BUREAU", KEY), "SK_ID_BUREAU", KEY)
    tb = [c for c in bb_tiebreak if c in bb.columns]
    bb = O.with_order_ranks(bb, KEY, "MONTHS_BALANCE", tb, joined_on_first=tb[0] == "SK_ID_BUREAU")
    bb = bb.withColumns({"STATUS_NUMERIC": X.map_values("STATUS", STATUS_SEVERITY),
                         "STATUS_NUM": F.coalesce(X.map_values("STATUS", STATUS_SEVERITY), F.lit(0))})
    rec_m = F.col("MONTHS_BALANCE") >= RECENT_MONTHS
    old_m = F.col("MONTHS_BALANCE") < OLD_STATUS_MONTHS
    bal = R.rollup(bb, KEY, [
        *_aggs({"MONTHS_BALANCE": ["min", "max"]}, "BUREAU_"),
        R.size_agg("BUREAU_BALANCE_MONTHS"),
        *_aggs({"STATUS_NUMERIC": ["mean", "max", "sum"]}),
        *R.category_shares("STATUS", STATUS_CODES, "BUREAU_STATUS_"),
        *_aggs({"STATUS_NUM": ["mean", "max", "sum"]}, "RECENT_STATUS_", rec_m),
        F.nullif(F.count(F.when(rec_m, F.col("MONTHS_BALANCE"))), F.lit(0)).alias("RECENT_MONTHS_COUNT"),
        *_aggs({"STATUS_NUM": ["mean", "max"]}, "OLD_STATUS_", old_m),
        F.nullif(F.count(F.when(old_m, F.col("MONTHS_BALANCE"))), F.lit(0)).alias("OLD_MONTHS_COUNT"),
        O.tail_head_diff("STATUS_NUM", 6, 6).alias("PAYMENT_STATUS_TREND"),
        O.leading_streak(F.col("STATUS").isin(*GOOD_STATUS)).alias("CONSECUTIVE_GOOD_MONTHS"),
    ])
    out = b.join(bal, KEY, "left").withColumns({
        "RECENT_TO_OLD_CREDIT_RATIO": X.smooth_div("RECENT_CREDIT_COUNT", "OLD_CREDIT_COUNT"),
        "STATUS_IMPROVEMENT": F.col("OLD_STATUS_STATUS_NUM_mean") - F.col("RECENT_STATUS_STATUS_NUM_mean"),
    })
    return out.fillna(0)   # both bureau families are filled with 0 (inf is kept)


# ---------------------------------------------------------------- previous applications
def prev_features(prev: DataFrame) -> DataFrame:
    """24 rollup features (no fill) + 7 application-history features (filled)."""
    p = O.with_order_ranks(prev, KEY, "DAYS_DECISION", ["SK_ID_PREV"])
    approved = F.col("NAME_CONTRACT_STATUS") == "Approved"
    agg = R.rollup(p, KEY, [
        F.count("SK_ID_PREV").alias("PREV_APP_COUNT"),
        *_aggs({"AMT_CREDIT": ["mean", "max", "sum", "min"], "AMT_APPLICATION": ["mean", "max", "min"],
                "AMT_DOWN_PAYMENT": ["mean", "max"], "DAYS_DECISION": ["min", "max", "mean"],
                "CNT_PAYMENT": ["mean", "max", "sum"], "RATE_DOWN_PAYMENT": ["mean", "max"]}),
        *R.status_counts("NAME_CONTRACT_STATUS", {"PREV_APPROVED_COUNT": "Approved", "PREV_REFUSED_COUNT": "Refused",
                                                  "PREV_CANCELED_COUNT": "Canceled"}),
        *R.status_counts("NAME_CONTRACT_TYPE", {"PREV_CASH_LOAN_COUNT": "Cash loans"}),
        O.mean_abs_gap("DAYS_DECISION").alias("AVG_TIME_BETWEEN_APPS"),
        O.relative_change("AMT_CREDIT", "DAYS_DECISION", ["SK_ID_PREV"]).alias("PREV_LOAN_AMOUNT_TREND"),
        O.newest_k_rate(approved, 3).alias("RECENT_APPROVAL_RATE"),
        O.older_rate(approved, 3).alias("OLD_APPROVAL_RATE"),
        O.volatility("AMT_APPLICATION").alias("PREV_AMOUNT_VOLATILITY"),
        O.newest_oldest_rel_change("AMT_DOWN_PAYMENT", 3, 2).alias("DOWN_PAYMENT_TREND"),
    ])
    hist = ["AVG_TIME_BETWEEN_APPS", "PREV_LOAN_AMOUNT_TREND", "RECENT_APPROVAL_RATE", "OLD_APPROVAL_RATE",
            "PREV_AMOUNT_VOLATILITY", "DOWN_PAYMENT_TREND"]
    agg = agg.withColumns({
        "PREV_APPROVAL_RATE": X.ieee_div("PREV_APPROVED_COUNT", "PREV_APP_COUNT"),
        "PREV_REFUSAL_RATE": X.ieee_div("PREV_REFUSED_COUNT", "PREV_APP_COUNT"),
    }).fillna(0, subset=hist)
    return agg.withColumn("APPROVAL_RATE_IMPROVEMENT",
                          F.coalesce(F.col("RECENT_APPROVAL_RATE") - F.col("OLD_APPROVAL_RATE"), F.lit(0.0)))


# ---------------------------------------------------------------- instalments
def inst_features(inst: DataFrame, tiebreak: Sequence[str] = ("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"),
                  joined_on_first: bool = False) -> DataFrame:
    """23 rollup features + 20 payment-behaviour features (base: recent payers).
    ``joined_on_first``: see ``ordered.with_order_ranks``."""
    tb = [c for c in tiebreak if c in inst.columns]
    i = O.with_order_ranks(inst, KEY, "DAYS_INSTALMENT", tb, joined_on_first=joined_on_first)
    i = i.withColumns({
        "PAYMENT_DIFF": F.col("AMT_PAYMENT") - F.col("AMT_INSTALMENT"),
        "PAYMENT_DELAY": F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"),
    }).withColumns({
        "LATE_PAYMENT": X.flag(F.col("PAYMENT_DELAY") > 0),
        "UNDERPAYMENT": X.flag(F.col("PAYMENT_DIFF") < 0),
    })
    recent = F.col("DAYS_INSTALMENT") >= RECENT_PAYMENT_DAYS
    old = F.col("DAYS_INSTALMENT") < RECENT_PAYMENT_DAYS
    agg = R.rollup(i, KEY, [
        F.count("NUM_INSTALMENT_NUMBER").alias("INST_COUNT"),
        *_aggs({"NUM_INSTALMENT_NUMBER": ["max"], "PAYMENT_DIFF": ["mean", "max", "min", "sum", "std"],
                "PAYMENT_DELAY": ["mean", "max", "min", "std"], "LATE_PAYMENT": ["sum", "mean"],
                "UNDERPAYMENT": ["sum", "mean"], "AMT_PAYMENT": ["sum", "mean", "max", "min"],
                "AMT_INSTALMENT": ["sum", "mean", "max"]}, rename={"PAYMENT_DELAY_std": "INST_PAYMENT_DELAY_std"}),
        X.count_if(recent).alias("_n_recent"),
        *_aggs({"PAYMENT_DIFF": ["mean", "std", "min", "max"], "PAYMENT_DELAY": ["mean", "max", "sum"],
                "LATE_PAYMENT": ["sum", "mean"], "UNDERPAYMENT": ["sum", "mean"],
                "NUM_INSTALMENT_NUMBER": ["count"]}, "RECENT_PAY_", recent),
        *_aggs({"PAYMENT_DELAY": ["mean", "max"], "LATE_PAYMENT": ["mean"], "NUM_INSTALMENT_NUMBER": ["count"]},
               "OLD_PAY_", old),
        O.half_split_diff("PAYMENT_DELAY", 6).alias("PAYMENT_DELAY_TREND"),
        F.stddev_samp("PAYMENT_DELAY").alias("PAYMENT_DELAY_STD"),
        O.last_k_mean("LATE_PAYMENT", 3, 3).alias("LAST_3_PAYMENTS_LATE_RATE"),
    ]).withColumns({
        "INST_PAYMENT_RATIO": X.ieee_div("AMT_PAYMENT_sum", "AMT_INSTALMENT_sum"),
        "PAYMENT_IMPROVEMENT": F.col("OLD_PAY_PAYMENT_DELAY_mean") - F.col("RECENT_PAY_PAYMENT_DELAY_mean"),
    })
    fam = [c for c in agg.columns if c.startswith(("RECENT_PAY_", "OLD_PAY_"))] + [
        "PAYMENT_DELAY_TREND", "PAYMENT_DELAY_STD", "LAST_3_PAYMENTS_LATE_RATE", "PAYMENT_IMPROVEMENT"]
    keep = [c for c in agg.columns if c not in fam and c != "_n_recent"]
    return agg.select(*keep, *_gated(fam, F.col("_n_recent") > 0))


# ---------------------------------------------------------------- POS cash
def pos_features(pos: DataFrame, tiebreak: Sequence[str] = ("SK_ID_PREV",)) -> DataFrame:
    """17 rollup features + 11 trend features (base: active in the last 6 months)."""
    tb = [c for c in tiebreak if c in pos.columns]
    p = O.with_order_ranks(pos, KEY, "MONTHS_BALANCE", tb)
    recent = F.col("MONTHS_BALANCE") >= RECENT_MONTHS
    old = F.col("MONTHS_BALANCE") < RECENT_MONTHS
    agg = R.rollup(p, KEY, [
        *_aggs({"MONTHS_BALANCE": ["min", "max"]}, "POS_"),
        R.size_agg("POS_MONTHS_COUNT"),
        *_aggs({"SK_DPD": ["mean", "max", "sum"], "SK_DPD_DEF": ["mean", "max", "sum"]}, "POS_"),
        *_aggs({"CNT_INSTALMENT": ["mean", "max"], "CNT_INSTALMENT_FUTURE": ["mean", "max", "sum"]}),
        *R.status_counts("NAME_CONTRACT_STATUS", {"POS_ACTIVE_COUNT": "Active", "POS_COMPLETED_COUNT": "Completed"}),
        X.count_if(recent).alias("_n_recent"),
        *_aggs({"SK_DPD": ["mean", "max", "sum"], "SK_DPD_DEF": ["mean", "max"], "CNT_INSTALMENT_FUTURE": ["mean"]},
               "POS_RECENT_", recent),
        *_aggs({"SK_DPD": ["mean", "max"], "SK_DPD_DEF": ["mean"]}, "POS_OLD_", old),
        O.tail_head_diff("SK_DPD", 3, 3).alias("POS_DPD_TREND"),
    ]).withColumns({
        "POS_COMPLETION_RATE": X.ieee_div("POS_COMPLETED_COUNT", "POS_MONTHS_COUNT"),
        "POS_DPD_IMPROVEMENT": F.col("POS_OLD_SK_DPD_mean") - F.col("POS_RECENT_SK_DPD_mean"),
    })
    fam = [c for c in agg.columns if c.startswith(("POS_RECENT_", "POS_OLD_"))] + ["POS_DPD_TREND",
                                                                                 "POS_DPD_IMPROVEMENT"]
    keep = [c for c in agg.columns if c not in fam and c != "_n_recent"]
    return agg.select(*keep, *_gated(fam, F.col("_n_recent") > 0))


# ---------------------------------------------------------------- credit card
CC_SUMS = ["AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_POS_CURRENT", "AMT_PAYMENT_CURRENT",
           "CNT_DRAWINGS_CURRENT"]


def cc_features(cc: DataFrame, tiebreak: Sequence[str] = ("SK_ID_PREV",)) -> DataFrame:
    """34 rollup features + 27 velocity features (base: active in the last 6 months)."""
    tb = [c for c in tiebreak if c in cc.columns]
    c = O.with_order_ranks(cc, KEY, "MONTHS_BALANCE", tb)
    c = c.withColumn("UTILIZATION", X.ieee_div(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL") + F.lit(1)))
    recent = F.col("MONTHS_BALANCE") >= RECENT_MONTHS
    band = R.slice_pred("MONTHS_BALANCE", OLD_STATUS_MONTHS, RECENT_MONTHS)
    agg = R.rollup(c, KEY, [
        *_aggs({"MONTHS_BALANCE": ["min", "max"]}, "CC_"),
        R.size_agg("CC_MONTHS_COUNT"),
        *_aggs({"AMT_BALANCE": ["mean", "max", "min", "sum"], "AMT_CREDIT_LIMIT_ACTUAL": ["mean", "max", "min"],
                **{m: ["mean", "max", "sum"] for m in CC_SUMS}}),
        *_aggs({"SK_DPD": ["mean", "max", "sum"], "SK_DPD_DEF": ["mean", "max", "sum"]}, "CC_"),
        X.count_if(recent).alias("_n_recent"),
        *_aggs({"AMT_DRAWINGS_CURRENT": ["sum", "mean", "max"], "AMT_PAYMENT_CURRENT": ["sum", "mean", "max"],
                "AMT_BALANCE": ["mean", "max"], "UTILIZATION": ["mean", "max"], "SK_DPD": ["max", "sum", "mean"],
                "SK_DPD_DEF": ["max", "sum"], "MONTHS_BALANCE": ["count"]}, "CC_RECENT_", recent),
        *_aggs({"AMT_DRAWINGS_CURRENT": ["mean", "max"], "AMT_PAYMENT_CURRENT": ["mean"], "UTILIZATION": ["mean"],
                "SK_DPD": ["mean"]}, "CC_OLD_", band),
        O.newest_oldest_rel_change("AMT_DRAWINGS_CURRENT", 3, 3).alias("CC_SPENDING_TREND"),
        O.tail_head_diff("UTILIZATION", 3, 3).alias("CC_UTILIZATION_TREND"),
        O.ratio_of_sums_trend("AMT_PAYMENT_CURRENT", "AMT_DRAWINGS_CURRENT", 3, 3, 1.0).alias("CC_PAYMENT_DRAWING_TREND"),
        O.tail_head_diff("SK_DPD", 3, 3).alias("CC_DPD_TREND"),
    ]).withColumns({
        "CC_UTILIZATION_MEAN": X.ieee_div("AMT_BALANCE_mean", "AMT_CREDIT_LIMIT_ACTUAL_mean"),
        "CC_UTILIZATION_MAX": X.ieee_div("AMT_BALANCE_max", "AMT_CREDIT_LIMIT_ACTUAL_max"),
        "CC_PAYMENT_DRAWING_RATIO": X.ieee_div("AMT_PAYMENT_CURRENT_sum", "AMT_DRAWINGS_CURRENT_sum"),
        "CC_UTILIZATION_IMPROVEMENT": F.col("CC_OLD_UTILIZATION_mean") - F.col("CC_RECENT_UTILIZATION_mean"),
        "CC_SPENDING_ACCELERATION": F.col("CC_RECENT_AMT_DRAWINGS_CURRENT_mean") - F.col("CC_OLD_AMT_DRAWINGS_CURRENT_mean"),
    })
    fam = [c for c in agg.columns if c.startswith(("CC_RECENT_", "CC_OLD_"))] + [
        "CC_SPENDING_TREND", "CC_UTILIZATION_TREND", "CC_PAYMENT_DRAWING_TREND", "CC_DPD_TREND",
        "CC_UTILIZATION_IMPROVEMENT", "CC_SPENDING_ACCELERATION"]
    keep = [c for c in agg.columns if c not in fam and c != "_n_recent"]
    return agg.select(*keep, *_gated(fam, F.col("_n_recent") > 0))


# ---------------------------------------------------------------- stage A row features after joins
def advanced_features(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    new = {}
    if set(EXT) <= cols:
        new["EXT_SOURCE_PROD"] = X.product(*EXT)
        new["EXT_SOURCE_WEIGHTED"] = X.weighted_sum0({"EXT_SOURCE_1": 0.4, "EXT_SOURCE_2": 0.4, "EXT_SOURCE_3": 0.2})
    if "CNT_FAM_MEMBERS" in cols:
        new["INCOME_PER_FAMILY_MEMBER"] = X.ieee_div(F.col("AMT_INCOME_TOTAL"), F.col("CNT_FAM_MEMBERS") + F.lit(1))
    new["CREDIT_INCOME_PERCENT"] = X.ieee_div("AMT_CREDIT", "AMT_INCOME_TOTAL")
    if "AMT_ANNUITY" in cols:
        new["ANNUITY_CREDIT_PERCENT"] = X.ieee_div("AMT_ANNUITY", "AMT_CREDIT")
    new["WORKING_AGE_RATIO"] = X.ieee_div("EMPLOYMENT_YEARS", "AGE_YEARS")
    new["INCOME_PER_AGE"] = X.ieee_div("AMT_INCOME_TOTAL", "AGE_YEARS")
    docs = [c for c in df.columns if "FLAG_DOCUMENT" in c]
    if docs:
        new["DOCUMENT_COUNT"] = X.row_sum0(*docs)
    contact = [c for c in CONTACT_FLAGS if c in cols]
    if contact:
        new["CONTACT_INFO_COUNT"] = X.row_sum0(*contact)
    if {"REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY"} <= cols:
        new["REGION_RISK_SCORE"] = F.col("REGION_RATING_CLIENT") * F.col("REGION_RATING_CLIENT_W_CITY")
    if "BUREAU_LOAN_COUNT" in cols:
        new["AVG_CREDIT_PER_BUREAU_LOAN"] = X.ieee_div(F.col("AMT_CREDIT"), F.col("BUREAU_LOAN_COUNT") + F.lit(1))
    if "PREV_APP_COUNT" in cols:
        new["APPROVAL_SUCCESS_RATE"] = F.col("PREV_APPROVAL_RATE") if "PREV_APPROVAL_RATE" in cols else F.lit(0)
    return df.withColumns(new)


def missing_handling(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Indicators, car-age fill and per-region building medians.

    The medians are statistics of raw application columns; ``fit_on`` (the
    application spine) gives the same rows and values as the joined frame
    without making the median job depend on every fact-table aggregation."""
    flags = [c for c in MISSING_FLAG_COLS if c in df.columns]
    out = P.missing_indicators(df, flags)
    if "OWN_CAR_AGE" in out.columns:
        out = out.fillna({"OWN_CAR_AGE": 0})
    building = [c for c in df.columns if any(p in c for p in BUILDING_PATTERNS)]
    if building and "REGION_RATING_CLIENT" in df.columns:
        src = fit_on if fit_on is not None and set(building) <= set(fit_on.columns) else out
        stats = P.fit_medians(src, building, by=["REGION_RATING_CLIENT"])
        out = P.apply_medians(out, stats, building, by=["REGION_RATING_CLIENT"])
    return out


# ---------------------------------------------------------------- stage B
def cross_table_features(df: DataFrame) -> DataFrame:
    need = ["BUREAU_LOAN_COUNT", "BUREAU_ACTIVE_LOANS", "PREV_APP_COUNT", "PREV_APPROVED_COUNT", "INST_COUNT",
            "LATE_PAYMENT_sum", "AMT_INCOME_TOTAL", "AMT_CREDIT"]
    z = {c: F.coalesce(F.col(c), F.lit(0)) for c in need}
    exp = z["BUREAU_LOAN_COUNT"] + z["PREV_APP_COUNT"]
    return df.withColumns({
        "TOTAL_CREDIT_EXPERIENCE": exp,
        "BUREAU_TO_PREV_RATIO": X.ieee_div(z["BUREAU_LOAN_COUNT"], z["PREV_APP_COUNT"] + F.lit(1)),
        "LATE_PAYMENT_RATIO": X.ieee_div(z["LATE_PAYMENT_sum"], z["INST_COUNT"] + F.lit(1)),
        "CREDIT_ACTIVITY_SCORE": z["PREV_APPROVED_COUNT"] + z["BUREAU_ACTIVE_LOANS"],
        "CREDIT_PER_INCOME": X.ieee_div(z["AMT_CREDIT"], z["AMT_INCOME_TOTAL"]),
        "DEBT_PER_EXPERIENCE": X.ieee_div(z["AMT_CREDIT"], exp + F.lit(1)),
    })


def score_features(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    new = {}
    ext = X.fill("EXT_SOURCE_MEAN", 0.5)
    if {"EXT_SOURCE_MEAN", "AGE_YEARS", "ANNUITY_INCOME_RATIO"} <= cols:
        new["RISK_SCORE_1"] = (F.lit(0.5) * ext + F.lit(0.3) * (F.col("AGE_YEARS") / F.lit(100.0))
                               + F.lit(0.2) * (F.lit(1.0) - X.fill(X.clip("ANNUITY_INCOME_RATIO", 0.0, 1.0), 0.2)))
    if {"EXT_SOURCE_MEAN", "BUREAU_DEBT_CREDIT_RATIO", "LATE_PAYMENT_mean"} <= cols:
        new["RISK_SCORE_2"] = (F.lit(0.4) * ext
                               + F.lit(0.3) * (F.lit(1.0) - X.fill(X.clip("BUREAU_DEBT_CREDIT_RATIO", 0.0, 1.0), 0.3))
                               + F.lit(0.3) * (F.lit(1.0) - X.fill(X.clip("LATE_PAYMENT_mean", 0.0, 1.0), 0.0)))
    for c in EXT:
        if c in cols:
            v = X.fill(c, 0.0)
            new[f"{c}_SQUARED"] = F.pow(v, 2)
            new[f"{c}_CUBED"] = F.pow(v, 3)
            new[f"{c}_SQRT"] = X.safe_sqrt(v)
            new[f"{c}_LOG"] = X.safe_log1p(v)
    if {"EXT_SOURCE_MEAN", "AMT_INCOME_TOTAL"} <= cols:
        new["EXT_SOURCE_INCOME_INTERACTION"] = ext * X.safe_log1p("AMT_INCOME_TOTAL")
    if {"EXT_SOURCE_MEAN", "AMT_CREDIT"} <= cols:
        new["EXT_SOURCE_CREDIT_INTERACTION"] = ext * X.safe_log1p("AMT_CREDIT")
    return df.withColumns(new)


def final_clean(df: DataFrame, keep: Sequence[str] = (KEY, "TARGET")) -> DataFrame:
    """±inf -> NULL -> 0 on every numeric feature (reference's last step).
    One ``selectExpr`` over the wide table (one JVM call, not one per column)."""
    from pyspark.sql import types as T
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if f.name in keep or not isinstance(f.dataType, T.NumericType):
            exprs.append(q)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(f"coalesce(CASE WHEN isnan({q}) OR abs({q}) = double('Infinity') THEN NULL "
                         f"ELSE {q} END, 0.0D) AS {q}")
        else:
            exprs.append(f"coalesce({q}, 0) AS {q}")
    return df.selectExpr(*exprs)


def build(app: DataFrame, bureau: DataFrame, bureau_balance: DataFrame, prev: DataFrame, pos: DataFrame,
          cc: DataFrame, inst: DataFrame, clean: bool = True,
          inst_tiebreak: Sequence[str] = ("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"),
          bb_tiebreak: Sequence[str] = ("SK_ID_BUREAU",), inst_joined_on_first: bool = False) -> DataFrame:
    """The full pack on one spine (train and test can be one spine with a split column)."""
    # each fact table: one aggregation holding both its rollup and its
    # history family, joined to the spine once (a second join of a pruned
    # copy would make Spark aggregate the fact table twice)
    families = [bureau_features(bureau, bureau_balance, bb_tiebreak), prev_features(prev),
                inst_features(inst, inst_tiebreak, inst_joined_on_first), pos_features(pos), cc_features(cc)]
    a = spine_join(basic_features(app), families, KEY)
    a = missing_handling(advanced_features(a), fit_on=app)
    out = score_features(cross_table_features(a))
    return final_clean(out) if clean else out


def derived_feature_names(df: DataFrame, app: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in set(app.columns)]
