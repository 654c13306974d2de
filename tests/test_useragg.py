"""User aggregates against whole histories in pandas; a hot key travels as states."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import useragg as U

SCHEMA = "k string, g int, t int, u long, f boolean, v double"


def _rows():
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 50}", i % 2, rng.choice([None, rng.randint(0, 90)]), i, rng.random() < .4,
             rng.choice([None, 0.0, rng.gauss(5, 2)])) for i in range(3000)]
    return rows + [(None, 1, 1, 9000, True, 1.0), ("x", None, 1, 9001, True, 1.0), ("one", 1, None, 9002, None, None)] + [("two", 1, 4, 9003, True, 2.0)] * 2


AGGS = {"share": U.last_k_share("t", "u", "f", 3), "gap": U.mean_gap("t"), "var": U.variation("v")}


@pytest.mark.parametrize("most", [2, 50_000])
@pytest.mark.parametrize("parts", [1, 7])
def test_against_whole_histories(spark, most, parts):
    df = spark.createDataFrame(_rows(), SCHEMA).withColumn("state", F.lit(1)).withColumn("k0", F.lit(2)).repartition(parts)
    got = {(r["k"], r["g"]): r for r in U.aggregate(df, ["k", "g"], AGGS, most).collect()}
    pdf = pd.DataFrame(_rows(), columns=["k", "g", "t", "u", "f", "v"]).dropna(subset=["k", "g"])
    assert set(got) == set(zip(pdf["k"], pdf["g"].astype(int)))
    for (k, g), h in pdf.groupby(["k", "g"]):
        r, timed, v = got[k, int(g)], h.dropna(subset=["t"]), h["v"].dropna()
        last = timed.sort_values(["t", "u"], ascending=False).head(3)["f"]
        want = [last.astype(bool).mean() if len(last) else None,
                (timed["t"].max() - timed["t"].min()) / (len(timed) - 1) if len(timed) > 1 else None,
                v.std() / v.mean() if len(v) > 1 and v.mean() else None]
        for name, w in zip(AGGS, want):
            assert r[name] == (None if w is None else pytest.approx(w)), (k, g, name)


def test_states_not_rows_meet(spark):
    """A hot entity reaches the merge as one state per task, whatever its rows."""
    seen = U.UserAggregate(("u",), lambda: [0, 1], lambda s, u: [s[0] + len(u), 1], lambda a, b: [a[0] + b[0], a[1] + b[1]],
                           lambda s: s, "array<long>")
    for n in (1_000, 100_000):
        df = spark.range(0, n, 1, 6).select(F.lit("hot").alias("k"), F.col("id").alias("u"))
        assert U.aggregate(df, "k", {"s": seen}).first()["s"] == [n, 6]


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert U.aggregate(df, "k", AGGS).collect() == []
    with pytest.raises(ValueError):
        U.aggregate(df, "k", {"k": AGGS["gap"]})


def test_entities_share_a_stream(spark):
    """No call per entity: states meet in sorted streams, and finished values keep their type beside NULLs."""
    big = U.UserAggregate(("u",), lambda: 0, lambda s, u: s + int(u.max()), lambda a, b: max(a, b), lambda s: s if s > 5 else None, "long")
    df = spark.range(0, 3000, 1, 3).select((F.col("id") % 1000).alias("k"), F.when(F.col("id") % 1000 < 5, F.lit(1)).otherwise(F.lit((1 << 60) + 1)).alias("u"))
    got = U.aggregate(df, "k", {"s": big})
    assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: r["s"] for r in got.collect()} == {k: None if k < 5 else (1 << 60) + 1 for k in range(1000)}
