"""Bucketed feature tables: joins without an exchange, and reopening them."""

import pytest

from conftest import SF001
from ledgerlens.operators.joins import spine_join
from ledgerlens.plans import catalog
from ledgerlens.sources.stored import open_by_key, store_by_key


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stored_spine_join_has_no_exchange(spark, no_broadcast):
    got = catalog.QUERIES["stored_spine_join"](spark, SF001)
    want = catalog.QUERIES["feature_spine_join"](spark, SF001)
    assert "Exchange" not in executed(got) and "SortMergeJoin" in executed(got)
    assert "Exchange" in executed(want)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_reopened_tables_join_without_exchange(spark, no_broadcast, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, None), (None, "z")], "id long, `odd name` string")
    b = spark.createDataFrame([(2, 5.0), (None, 7.0), (9, 1.0)], "id long, v double")
    for f, n in ((a, "a"), (b, "it's")):
        store_by_key(f, str(tmp_path / n), "id", 4)
    ra, rb = (open_by_key(spark, str(tmp_path / n), f.schema, "id", 4) for f, n in ((a, "a"), (b, "it's")))
    assert sorted(map(str, ra.collect())) == sorted(map(str, a.collect()))
    j = spine_join(ra, [rb], "id")
    assert {tuple(r) for r in j.collect()} == {(1, "x", None), (2, None, 5.0), (None, "z", None)}
    assert "Exchange" not in executed(j)


def test_empty_stored_table(spark, tmp_path):
    e = spark.createDataFrame([], "id long, v double")
    assert store_by_key(e, str(tmp_path / "e"), "id", 4).count() == 0
    with pytest.raises(Exception, match="non-empty directory"):
        store_by_key(e, str(tmp_path / "e"), "id", 4)
