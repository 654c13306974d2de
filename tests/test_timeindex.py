"""Slices from the dyadic index against direct aggregates and exact sketch targets."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import timeindex as X


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_nodes_cover_each_unit_once(levels):
    rng = random.Random(1)
    for _ in range(300):
        lo, hi = sorted((rng.randint(-50, 50), rng.randint(-50, 50)))
        for a, b in ((lo, hi), (None, hi), (lo, None), (None, None)):
            got = X.nodes(a, b, levels)
            for u in range(-60, 60):
                n = sum(j <= levels and (f is None or u >> j >= f) and (t is None or u >> j < t) for j, f, t in got)
                assert n == ((a is None or u >= a) and (b is None or u < b)), (a, b, u, got)
            assert len(got) <= 2 * levels + 1


def _data():
    rng = random.Random(2)
    rows = [("hot", rng.randint(-400, 30), rng.gauss(0, 9), rng.randint(0, 12)) for _ in range(1500)]
    rows += [(f"e{i % 40}", rng.choice([None, rng.randint(-400, 30)]), rng.choice([None, rng.gauss(0, 9)]), i % 5) for i in range(900)]
    return rows + [("untimed", None, 1.0, 1), (None, -3, 1.0, 1), ("null measure", -3, None, None)] + [("e1", -7, 2.0, 2)] * 3


SCHEMA = "id string, day int, v double, c int"


@pytest.mark.parametrize("unit,levels", [(1, 10), (7, 3)])
def test_slices_equal_direct_aggregates(spark, tmp_path, unit, levels):
    # columns named like those of the index may be in the table
    df = spark.createDataFrame(_data(), SCHEMA).withColumn("node", F.lit("x")).withColumn("n", F.lit(9)).withColumn("level", F.lit(1))
    index = X.store(X.time_index(df, "id", "day", ["v"], distinct=["c"], unit=unit, levels=levels), str(tmp_path / "index"))
    bands = {"a": (-27 * 7, None), "b": (None, -27 * 7), "c": (-12 * 7, -6 * 7), "none": (700, 1400)}
    fns = ["size", "count", "sum", "mean", "min", "max"]
    aggs = {b: [("v", f, f"{b}_{f}") for f in fns] + [("c", "distinct", f"{b}_distinct")] for b in bands}
    got = {r["id"]: r for r in X.slices(index, "id", bands, aggs, unit, levels).collect()}
    rows = [r for r in _data() if r[0] is not None]
    assert set(got) == {r[0] for r in rows}
    for e, r in got.items():
        for b, (lo, hi) in bands.items():
            part = [x for x in rows if x[0] == e and x[1] is not None and (lo is None or x[1] >= lo) and (hi is None or x[1] < hi)]
            vals = [x[2] for x in part if x[2] is not None]
            assert r[f"{b}_size"] == (len(part) or None) and r[f"{b}_count"] == len(vals)
            assert r[f"{b}_min"] == min(vals, default=None) and r[f"{b}_max"] == max(vals, default=None)
            assert r[f"{b}_sum"] == (pytest.approx(sum(vals)) if vals else None)
            assert r[f"{b}_mean"] == (pytest.approx(sum(vals) / len(vals)) if vals else None)
            assert (r[f"{b}_distinct"] or 0) == len({x[3] for x in part if x[3] is not None})
    only = X.slices(index, "id", {"c": bands["c"]}, {"c": aggs["c"]}, unit, levels, every_entity=False)
    assert {r["id"] for r in only.collect()} == {e for e, r in got.items() if r["c_size"]}


def test_a_band_reads_its_levels_only(spark, tmp_path):
    index = X.store(X.time_index(spark.createDataFrame(_data(), SCHEMA), "id", "day", ["v"]), str(tmp_path / "index"))
    d = X.slices(index, "id", {"a": (-8, -4)}, {"a": [("v", "sum", "s")]}, every_entity=False)
    assert "PartitionFilters: [" in d._jdf.queryExecution().toString() and "level" in d._jdf.queryExecution().toString()
    assert {j for j, _, _ in X.nodes(-8, -4, X.LEVELS)} == {2}


def test_sketches_stay_within_their_errors(spark):
    df = spark.range(60_000).select(F.lit("e").alias("id"), (F.col("id") % 300).alias("day"),
                                    F.col("id").alias("c"), ((F.col("id") * 7919) % 60_000).cast("double").alias("v"))
    index = X.time_index(df, "id", "day", ["v"], distinct=["c"], quantiles=["v"], levels=9)
    r = X.slices(index, "id", {"a": (30, 270)}, {"a": [("c", "distinct", "d"), ("v", "0.5", "q"), ("v", "0.9", "p")]}, levels=9).first()
    assert abs(r["d"] / 48_000 - 1) < 0.05
    band = [((i * 7919) % 60_000) for i in range(60_000) if 30 <= i % 300 < 270]
    for got, want in ((r["q"], 0.5), (r["p"], 0.9)):
        assert abs(sum(x <= got for x in band) / len(band) - want) < 0.04


def test_empty_table_and_bad_cutoffs(spark):
    df = spark.createDataFrame([], SCHEMA)
    index = X.time_index(df, "id", "day", ["v"], distinct=["c"], quantiles=["v"], unit=5, levels=4)
    wanted = {"a": [("v", "sum", "s"), ("c", "distinct", "d"), ("v", "0.5", "q")]}
    assert X.slices(index, "id", {"a": (None, 10)}, wanted, 5, 4).collect() == []
    with pytest.raises(ValueError):
        X.slices(index, "id", {"a": (None, 11)}, wanted, 5, 4)
