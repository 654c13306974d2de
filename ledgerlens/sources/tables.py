"""Test-table loader and the role adapters.

The feature operators are generic in (entity, time, tiebreak, measures). The
adapters below give the TPC-H-ish test tables the roles the operators are
written for:

=========  =========================  ===========================================
adapter    role                       source
=========  =========================  ===========================================
spine      one row per entity         customer
hist       dated history per entity   orders
bal        child rows, no entity key  lineitem (parent = order)
inst       instalment rows            lineitem joined to orders
monthly    periodic account rows      events
scored     labelled scores            lineitem
=========  =========================  ===========================================

Each adapter is a projection over a scan, so Catalyst prunes columns and
pushes filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values shared with the oracle SQL (plans/oracle.py).
HIST_ANCHOR = "2001-08-02"
BAL_ANCHOR = "2001-12-01"
EVENTS_ANCHOR = "2024-01-31"
DUE_OFFSET_DAYS = 60
BAL_CODES = ["0", "1", "2", "3", "4", "5", "C", "X"]
GOOD_CODES = ["C", "X", "0"]
CODE_SEVERITY = {"C": 0, "X": 0, "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(ts_col: str, anchor: str):
    return F.datediff(F.col(ts_col), F.lit(anchor).cast("date"))


def ext_scores():
    """The three external-score columns of the spine, from customer columns."""
    k, bal, nat = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
    return [F.when(k % 3 != 0, F.abs(bal) / F.lit(10000.0)),
            F.when(k % 5 != 0, (k % 100).cast("double") / F.lit(100.0)),
            F.when(k % 7 != 0, nat.cast("double") / F.lit(25.0))]


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    e1, e2, e3 = ext_scores()
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("seg"),
        F.col("c_nationkey").cast("long").alias("region"),
        F.col("c_acctbal").alias("acctbal"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("income"),
        e1.alias("ext1"), e2.alias("ext2"), e3.alias("ext3"),
    )


def hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("u"),
        _days("o_orderdate", HIST_ANCHOR).cast("long").alias("day"),
        F.col("o_totalprice").alias("amt"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("kind"),
    )


def bal(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    code = (F.when(F.col("l_returnflag") == "N", F.lit("C"))
            .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit("0"))
            .when(F.col("l_returnflag") == "A", F.lit("X"))
            .otherwise((F.col("l_linenumber") % 5 + 1).cast("string")))
    return li.select(
        F.col("l_orderkey").alias("parent"),
        F.col("l_linenumber").alias("u1"), F.col("l_partkey").alias("u2"),
        F.col("l_suppkey").alias("u3"), F.col("l_extendedprice").alias("u4"),
        F.floor(_days("l_shipdate", BAL_ANCHOR) / F.lit(30)).cast("long").alias("month"),
        code.alias("code"),
    )


def inst(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what the join does not need is computed before it, so that fewer and narrower columns travel
    li = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("u0"), F.col("l_linenumber").alias("u1"),
        F.col("l_partkey").alias("u2"), F.col("l_suppkey").alias("u3"),
        F.col("l_extendedprice").alias("u4"),
        F.when(F.col("l_linenumber") != 7, _days("l_shipdate", HIST_ANCHOR)).cast("long").alias("entry_day"),
        (F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax") - F.col("l_discount"))).alias("paid"),
    )
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("id"),
        (_days("o_orderdate", HIST_ANCHOR) + F.lit(DUE_OFFSET_DAYS)).cast("long").alias("due_day"),
    )
    j = li.join(o, F.col("u0") == F.col("o_orderkey"), "inner")
    return j.select("id", "u0", "u1", "u2", "u3", "u4", F.col("u1").cast("long").alias("num"), "due_day", "entry_day",
                    F.col("u4").alias("due"), "paid")


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("u"),
        _days("ts", EVENTS_ANCHOR).cast("long").alias("period"),
        F.col("value").alias("bal"),
        F.when(et == "signup", F.lit(0.0)).otherwise(F.lit(500.0)).alias("lim"),
        F.when(et == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("draw"),
        F.when(et == "click", F.col("value")).alias("pay"),
        F.when(et == "error", F.lit(1)).otherwise(F.lit(0)).cast("long").alias("dpd"),
        et.alias("etype"),
    )


SCORED_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        *SCORED_KEYS,
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_extendedprice") / F.lit(105000.0)).alias("s1"),
        (F.col("l_discount") * F.lit(10.0)).alias("s2"),
        (F.col("l_quantity") / F.lit(50.0)).alias("s3"),
    )


def scored_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scored plus one string id built from its five key columns."""
    s = scored(spark, sf_dir)
    return s.withColumn("rid", F.concat_ws("|", *[F.col(k).cast("string") for k in SCORED_KEYS]))
