"""Credit pack contract (feature count, names, no NULLs) and a pandas
recomputation of a sample of features, following the reference's rules with
the library's tiebreaks."""

import collections

import numpy as np
import pandas as pd
import pytest

from conftest import SF0001
from ledgerlens.plans import credit_pack as CP, q_pack
from ledgerlens.sources import credit_tables as CT


@pytest.fixture(scope="module")
def built(spark):
    t = CT.all_tables(spark, SF0001)
    out = q_pack.pack(spark, SF0001).toPandas().set_index("SK_ID_CURR")
    raw = {k: v.toPandas() for k, v in t.items()}
    return out, raw


def test_contract(built):
    out, raw = built
    derived = [c for c in out.columns if c not in set(raw["app"].columns)]
    assert len(derived) == 271
    low = collections.Counter(c.lower() for c in out.columns)
    assert all(n == 1 for n in low.values())
    num = out.select_dtypes(include=[np.number])
    assert not num.isna().any().any() and np.isfinite(num.to_numpy(dtype=float)).all()
    assert set(CP.REFERENCE_NAMES) <= set(out.columns)
    fam = lambda p: [c for c in out.columns if c.startswith(p)]
    assert len(fam("RECENT_PAY_")) + len(fam("OLD_PAY_")) == 16
    assert len(fam("CC_RECENT_")) + len(fam("CC_OLD_")) == 21
    assert len(fam("POS_RECENT_")) + len(fam("POS_OLD_")) == 9
    assert len(fam("BUREAU_STATUS_")) == 8


def _bureau_expect(raw):
    b, bb = raw["bureau"], raw["bureau_balance"]
    bb = bb.merge(b[["SK_ID_BUREAU", "SK_ID_CURR"]], on="SK_ID_BUREAU", how="inner")
    sev = bb["STATUS"].map(CP.STATUS_SEVERITY).fillna(0)
    bb = bb.assign(SEV=sev)
    exp = {}
    for k, g in bb.groupby("SK_ID_CURR"):
        order = ["MONTHS_BALANCE"] + q_pack.BB_TIEBREAK
        g = g.sort_values(order, kind="mergesort")
        trend = g.tail(6)["SEV"].mean() - g.head(6)["SEV"].mean() if len(g) >= 6 else 0.0
        newest = g.sort_values(order, ascending=[False] + [True] * len(q_pack.BB_TIEBREAK), kind="mergesort")
        streak = 0
        for s in newest["STATUS"]:
            if s in CP.GOOD_STATUS:
                streak += 1
            else:
                break
        share_c = (g["STATUS"] == "C").sum() / g["STATUS"].notna().sum()
        exp[k] = (trend, streak, share_c)
    return exp


def test_bureau_balance_features(built):
    out, raw = built
    for k, (trend, streak, share_c) in _bureau_expect(raw).items():
        assert out.loc[k, "PAYMENT_STATUS_TREND"] == pytest.approx(trend, abs=1e-9)
        assert out.loc[k, "CONSECUTIVE_GOOD_MONTHS"] == streak
        assert out.loc[k, "BUREAU_STATUS_C_RATIO"] == pytest.approx(share_c, abs=1e-9)


def test_instalment_features(built):
    out, raw = built
    i = raw["inst"].copy()
    i["DELAY"] = i["DAYS_ENTRY_PAYMENT"] - i["DAYS_INSTALMENT"]
    i["LATE"] = (i["DELAY"] > 0).astype(int)
    order = ["DAYS_INSTALMENT", "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "_tb_part", "_tb_supp", "_tb_price"]
    for k, g in i.groupby("SK_ID_CURR"):
        g = g.sort_values(order, kind="mergesort")
        mid = len(g) // 2
        trend = g.iloc[mid:]["DELAY"].mean() - g.iloc[:mid]["DELAY"].mean() if len(g) >= 6 else 0.0
        top = g.sort_values(order, ascending=[False] + [True] * 5, kind="mergesort").head(3)
        last3 = top["LATE"].mean() if len(g) >= 3 else 0.0
        has_recent = (g["DAYS_INSTALMENT"] >= -365).any()
        exp_trend = (0.0 if pd.isna(trend) else trend) if has_recent else 0.0
        exp_last3 = (0.0 if pd.isna(last3) else last3) if has_recent else 0.0
        assert out.loc[k, "PAYMENT_DELAY_TREND"] == pytest.approx(exp_trend, abs=1e-9)
        assert out.loc[k, "LAST_3_PAYMENTS_LATE_RATE"] == pytest.approx(exp_last3, abs=1e-9)
        assert out.loc[k, "INST_COUNT"] == g["NUM_INSTALMENT_NUMBER"].notna().sum()


def test_previous_application_features(built):
    out, raw = built
    p = raw["prev"]
    for k, g in p.groupby("SK_ID_CURR"):
        g = g.sort_values(["DAYS_DECISION", "SK_ID_PREV"], kind="mergesort")
        newest = g.sort_values(["DAYS_DECISION", "SK_ID_PREV"], ascending=[False, True], kind="mergesort")
        rec = (newest.head(min(3, len(g)))["NAME_CONTRACT_STATUS"] == "Approved").mean()
        old = 0.0 if len(g) <= 3 else (g.head(len(g) - 3)["NAME_CONTRACT_STATUS"] == "Approved").mean()
        gap = g["DAYS_DECISION"].diff().abs().mean() if len(g) >= 2 else 0.0
        assert out.loc[k, "RECENT_APPROVAL_RATE"] == pytest.approx(rec, abs=1e-9)
        assert out.loc[k, "APPROVAL_RATE_IMPROVEMENT"] == pytest.approx(rec - old, abs=1e-9)
        assert out.loc[k, "AVG_TIME_BETWEEN_APPS"] == pytest.approx(0.0 if pd.isna(gap) else gap, abs=1e-9)
        assert out.loc[k, "PREV_APP_COUNT"] == len(g)


def test_card_trends(built):
    out, raw = built
    c = raw["cc"].copy()
    c["UTIL"] = c["AMT_BALANCE"] / (c["AMT_CREDIT_LIMIT_ACTUAL"] + 1)
    for k, g in c.groupby("SK_ID_CURR"):
        if not (g["MONTHS_BALANCE"] >= -6).any():
            assert out.loc[k, "CC_UTILIZATION_TREND"] == 0.0
            continue
        g = g.sort_values(["MONTHS_BALANCE", "SK_ID_PREV"], kind="mergesort")
        ut = g.iloc[-3:]["UTIL"].mean() - g.iloc[:3]["UTIL"].mean() if len(g) >= 3 else 0.0
        r = (g.iloc[-3:]["AMT_PAYMENT_CURRENT"].sum() / (g.iloc[-3:]["AMT_DRAWINGS_CURRENT"].sum() + 1)
             - g.iloc[:3]["AMT_PAYMENT_CURRENT"].sum() / (g.iloc[:3]["AMT_DRAWINGS_CURRENT"].sum() + 1)) \
            if len(g) >= 3 else 1.0
        assert out.loc[k, "CC_UTILIZATION_TREND"] == pytest.approx(ut, abs=1e-9)
        assert out.loc[k, "CC_PAYMENT_DRAWING_TREND"] == pytest.approx(r, abs=1e-9)


FAMILIES = ["credit_bureau_family", "credit_prev_family", "credit_instalment_family", "credit_pos_family", "credit_card_family"]


@pytest.mark.parametrize("name", FAMILIES)
def test_rows_meet_before_they_are_aggregated(spark, name):
    """A buffer of dozens of aggregates is several times as wide as a row: only rows, or one buffer
    per entity, may be exchanged, never a buffer for every few rows."""
    from ledgerlens.plans import catalog
    p = catalog.QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString().split("\n")
    below = [p[i + 1] for i, line in enumerate(p[:-1]) if "Exchange hashpartitioning" in line]
    assert below and not [line[:200] for line in below if line.count("partial_") + line.count("merge_") > 3]


def test_families_of_hot_customers(spark, monkeypatch):
    """Customers whose rows are too many for one task get the same features."""
    from ledgerlens.operators import ordered as O
    from ledgerlens.plans import catalog
    for name in FAMILIES:
        out = []
        for most in (1 << 20, 12):
            monkeypatch.setattr(O, "HOT_ROWS", most)
            out.append(catalog.QUERIES[name](spark, SF0001).toPandas().sort_values("SK_ID_CURR").reset_index(drop=True))
        pd.testing.assert_frame_equal(*out, rtol=1e-9, atol=1e-9)
