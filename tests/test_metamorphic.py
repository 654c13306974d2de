"""Metamorphic checks: permuting / repartitioning the input and
adding an orphan child row leave pipeline results unchanged."""

from pyspark.sql import functions as F

from conftest import SF0001
from ledgerlens.operators import ordered as O, rollup as R
from ledgerlens.operators.joins import attach_key
from ledgerlens.sources import tables as T

TIE = ["parent", "u1", "u2", "u3", "u4"]


def _pipeline(bal, hist):
    b = attach_key(bal, hist.select(F.col("u").alias("parent"), "id"), "parent", "id")
    b = O.with_order_ranks(b.withColumn("bad", F.col("code").isin("C", "X", "0")), "id", "month", TIE)
    return R.rollup(b, "id", [
        O.tail_head_diff("month", 6, 6).alias("trend"),
        O.leading_streak(F.col("bad")).alias("streak"),
        O.last_k_mean(F.col("bad").cast("int"), 3, 3).alias("last3"),
        *R.category_shares("code", T.BAL_CODES, "S_"),
    ])


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_permutation_and_repartition_invariance(spark):
    bal, hist = T.bal(spark, SF0001), T.hist(spark, SF0001)
    base = _rows(_pipeline(bal, hist))
    shuffled = _rows(_pipeline(bal.repartition(7).orderBy(F.rand(3)), hist.repartition(3, "u")))
    assert base == shuffled


def test_orphan_child_changes_nothing(spark):
    bal, hist = T.bal(spark, SF0001), T.hist(spark, SF0001)
    orphan = spark.createDataFrame([(10 ** 12, 1, 1, 1, 1.0, -1, "5")], bal.schema)
    assert _rows(_pipeline(bal, hist)) == _rows(_pipeline(bal.unionByName(orphan), hist))
