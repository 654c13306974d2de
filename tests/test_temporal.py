"""As-of join, sessions and range frames against brute force: one key with a third
of the rows, equal times, NULL keys and times, cells narrow and wide."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import temporal as X

KIND = "id long, k string, t long, v double"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(6)
    out = [(i, "hot" if r.random() < 0.4 else f"k{r.randint(0, 12)}", r.choice([r.randint(-50, 400), 7 * r.randint(0, 40)]), float(r.randint(0, 99)))
           for i in range(400)]
    return out + [(900, None, 5, 1.0), (901, "hot", None, 2.0), (902, None, None, 3.0), (903, "alone", 10, 4.0)]


@pytest.mark.parametrize("width", [1, 13, 10_000])
@pytest.mark.parametrize("within", [None, 9])
def test_asof_join(spark, rows, width, within):
    left = [x for x in rows if x[0] % 2]
    right = [x for x in rows if not x[0] % 2]
    df = X.asof_join(spark.createDataFrame(left, KIND), spark.createDataFrame(right, KIND).withColumnRenamed("id", "rid"), "k", "t",
                     ["rid", "v"], width, "rid", within)
    got = {r["id"]: (r["k"], r["t"], r["v"], r["rid"], r["right_v"]) for r in df.collect()}
    assert len(got) == len(left)
    for i, k, t, v in left:
        m = [(y[2], y[0], y[3]) for y in right if k is not None and t is not None and y[1] == k and y[2] is not None and y[2] <= t
             and (within is None or t - y[2] <= within)]
        assert got[i] == (k, t, v, *(max(m)[1:] if m else (None, None)))


@pytest.mark.parametrize("width", [1, 13, 10_000])
def test_sessions(spark, rows, width):
    s = X.with_session(spark.createDataFrame(rows, KIND), "k", "t", 5, width, "id")
    got = {r["id"]: r["session"] for r in s.collect()}
    want, keys = {}, {x[1] for x in rows if x[1] and x[2] is not None}
    for k in keys:
        n, prev = 0, None
        for _, t, i in sorted((0, x[2], x[0]) for x in rows if x[1] == k and x[2] is not None):
            n += prev is None or t - prev > 5
            want[i], prev = n, t
    assert got == want
    summary = X.session_summary(spark.createDataFrame(rows, KIND), "k", "t", 5, width, "id", {"total": F.sum("v")}).collect()
    assert len(summary) == len({(k, want[i]) for i, k, t, _ in rows if i in want}) and sum(r["n_rows"] for r in summary) == len(want)
    assert sum(r["total"] for r in summary) == sum(x[3] for x in rows if x[0] in want)


@pytest.mark.parametrize("span", [1, 20, 1000])
def test_range_frame(spark, rows, span):
    got = {r["id"]: (r["n"], r["top"]) for r in X.range_frame(spark.createDataFrame(rows, KIND), "k", "t", span,
                                                             {"n": F.count("v"), "top": F.max("v")}).collect()}
    assert len(got) == len(rows)
    for i, k, t, _ in rows:
        m = [y[3] for y in rows if k is not None and t is not None and y[1] == k and y[2] is not None and t - span <= y[2] <= t]
        assert got[i] == ((len(m), max(m)) if m else (None, None))


def test_windows_never_hold_a_whole_key(spark, rows):
    """Every window that orders rows is partitioned by the cell too; those by key alone see one row per cell."""
    df = spark.createDataFrame(rows, KIND)
    plan = X.with_session(df, "k", "t", 5, 13, "id")._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window [" in x]
    assert windows and all("_cell#" in x or "_bk#" in x for x in windows), windows


def test_empty_tables(spark):
    e = spark.createDataFrame([], KIND)
    assert X.asof_join(e, e, "k", "t", ["v"], 5, "id").count() == 0
    assert X.session_summary(e, "k", "t", 5, 5, "id", {}).count() == 0
    assert X.range_frame(e, "k", "t", 5, {"n": F.count("v")}).count() == 0
