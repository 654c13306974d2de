"""Reference-shaped views over the test tables, for the credit pack.

Each view is a projection of one test table (plus the orders join for the
instalments), so every pack feature is computed from the given data and grows
with it. The mapping is a role assignment, not data generation:

=====================  ==========================================
reference table        test table
=====================  ==========================================
application            customer
bureau                 orders
bureau_balance         lineitem (SK_ID_BUREAU = order key)
previous_application   orders
installments_payments  lineitem joined to orders
POS_CASH_balance       events
credit_card_balance    events
=====================  ==========================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources import tables as T


def application(spark: SparkSession, d: str) -> DataFrame:
    c = T.load(spark, d, "customer")
    k, bal, nat = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
    credit = (nat + F.lit(1)).cast("double") * F.lit(10000.0) + F.abs(bal)
    e1, e2, e3 = T.ext_scores()
    c = c.select("*", e1.alias("ext1"), e2.alias("ext2"), e3.alias("ext3"))
    return c.select(
        k.alias("SK_ID_CURR"),
        (k % 10 == 0).cast("int").alias("TARGET"),
        (F.abs(bal) * F.lit(10.0) + F.lit(1000.0)).alias("AMT_INCOME_TOTAL"),
        credit.alias("AMT_CREDIT"),
        F.when(k % 11 != 0, credit / F.lit(20.0)).alias("AMT_ANNUITY"),
        F.when(k % 17 != 0, credit * F.lit(0.9)).alias("AMT_GOODS_PRICE"),
        (-(F.lit(7000) + k % 15000)).alias("DAYS_BIRTH"),
        F.when(k % 13 == 0, F.lit(365243)).otherwise(-(k % 5000)).alias("DAYS_EMPLOYED"),
        F.col("ext1").alias("EXT_SOURCE_1"), F.col("ext2").alias("EXT_SOURCE_2"), F.col("ext3").alias("EXT_SOURCE_3"),
        F.when(k % 19 != 0, (nat % 5 + 1).cast("double")).alias("CNT_FAM_MEMBERS"),
        (k % 2).cast("int").alias("FLAG_DOCUMENT_2"), (k % 3 == 0).cast("int").alias("FLAG_DOCUMENT_3"),
        F.lit(1).alias("FLAG_MOBIL"), (k % 4 == 0).cast("int").alias("FLAG_EMAIL"),
        (k % 5 == 0).cast("int").alias("FLAG_PHONE"),
        (nat % 3 + 1).alias("REGION_RATING_CLIENT"), ((nat + k) % 3 + 1).alias("REGION_RATING_CLIENT_W_CITY"),
        F.when(k % 4 == 0, (k % 20).cast("double")).alias("OWN_CAR_AGE"),
        F.when(k % 6 != 0, F.col("c_mktsegment")).alias("OCCUPATION_TYPE"),
        F.when(k % 8 != 0, F.abs(bal) / F.lit(10000.0)).alias("APARTMENTS_AVG"),
        F.when(k % 9 != 0, (k % 40).cast("double") / F.lit(40.0)).alias("YEARS_BUILD_AVG"),
    )


def bureau(spark: SparkSession, d: str) -> DataFrame:
    h = T.hist(spark, d)
    st = F.col("status")
    return h.select(
        F.col("u").alias("SK_ID_BUREAU"), F.col("id").alias("SK_ID_CURR"), F.col("day").alias("DAYS_CREDIT"),
        (F.col("u") % 30).alias("CREDIT_DAY_OVERDUE"), F.col("amt").alias("AMT_CREDIT_SUM"),
        F.when(st == "O", F.col("amt") / F.lit(3.0)).when(st == "F", F.lit(0.0)).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(st == "P", F.col("amt") / F.lit(7.0)).otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        (F.col("u") % 3).alias("CNT_CREDIT_PROLONG"),
        F.when(st == "O", F.lit("Active")).when(st == "F", F.lit("Closed")).otherwise(F.lit("Sold")).alias("CREDIT_ACTIVE"),
        F.col("kind").alias("CREDIT_TYPE"),
    )


def bureau_balance(spark: SparkSession, d: str) -> DataFrame:
    b = T.bal(spark, d)
    # (SK_ID_BUREAU, MONTHS_BALANCE) is not unique here (several line items of
    # one order share a month), so the line-item key travels along as tiebreak
    return b.select(F.col("parent").alias("SK_ID_BUREAU"), F.col("month").alias("MONTHS_BALANCE"),
                    F.col("code").alias("STATUS"), F.col("u1").alias("_tb_line"), F.col("u2").alias("_tb_part"),
                    F.col("u3").alias("_tb_supp"), F.col("u4").alias("_tb_price"))


def previous_application(spark: SparkSession, d: str) -> DataFrame:
    h = T.hist(spark, d)
    st = F.col("status")
    return h.select(
        F.col("u").alias("SK_ID_PREV"), F.col("id").alias("SK_ID_CURR"), F.col("amt").alias("AMT_CREDIT"),
        (F.col("amt") * F.lit(1.1)).alias("AMT_APPLICATION"),
        F.when(st != "P", F.col("amt") * F.lit(0.1)).alias("AMT_DOWN_PAYMENT"),
        F.when(st != "P", F.lit(0.1)).alias("RATE_DOWN_PAYMENT"),
        F.col("day").alias("DAYS_DECISION"), (F.col("u") % 24 + 6).cast("double").alias("CNT_PAYMENT"),
        F.when(st == "F", F.lit("Approved")).when(st == "O", F.lit("Refused")).otherwise(F.lit("Canceled"))
        .alias("NAME_CONTRACT_STATUS"),
        F.when(F.col("kind").startswith("1"), F.lit("Cash loans")).otherwise(F.lit("Consumer loans"))
        .alias("NAME_CONTRACT_TYPE"),
    )


def installments(spark: SparkSession, d: str) -> DataFrame:
    i = T.inst(spark, d)
    return i.select(
        F.col("id").alias("SK_ID_CURR"), F.col("u0").alias("SK_ID_PREV"),
        F.col("num").alias("NUM_INSTALMENT_NUMBER"), F.col("due_day").alias("DAYS_INSTALMENT"),
        F.col("entry_day").cast("double").alias("DAYS_ENTRY_PAYMENT"), F.col("due").alias("AMT_INSTALMENT"),
        F.when(F.col("entry_day").isNotNull(), F.col("paid")).alias("AMT_PAYMENT"),
        # (u1..u4 keep the row order unique within an order)
        F.col("u2").alias("_tb_part"), F.col("u3").alias("_tb_supp"), F.col("u4").alias("_tb_price"),
    )


def pos_cash(spark: SparkSession, d: str) -> DataFrame:
    m = T.monthly(spark, d)
    return m.select(
        F.col("id").alias("SK_ID_CURR"), F.col("u").alias("SK_ID_PREV"), F.col("period").alias("MONTHS_BALANCE"),
        (F.col("dpd") * F.lit(5)).alias("SK_DPD"), F.col("dpd").alias("SK_DPD_DEF"),
        F.col("bal").alias("CNT_INSTALMENT"), (F.col("bal") / F.lit(2.0)).alias("CNT_INSTALMENT_FUTURE"),
        F.when(F.col("etype") == "view", F.lit("Completed")).otherwise(F.lit("Active")).alias("NAME_CONTRACT_STATUS"),
    )


def credit_card(spark: SparkSession, d: str) -> DataFrame:
    m = T.monthly(spark, d)
    return m.select(
        F.col("id").alias("SK_ID_CURR"), F.col("u").alias("SK_ID_PREV"), F.col("period").alias("MONTHS_BALANCE"),
        F.col("bal").alias("AMT_BALANCE"), F.col("lim").alias("AMT_CREDIT_LIMIT_ACTUAL"),
        F.col("draw").alias("AMT_DRAWINGS_CURRENT"), (F.col("draw") * F.lit(0.3)).alias("AMT_DRAWINGS_ATM_CURRENT"),
        (F.col("draw") * F.lit(0.7)).alias("AMT_DRAWINGS_POS_CURRENT"), F.col("pay").alias("AMT_PAYMENT_CURRENT"),
        (F.col("draw") > 0).cast("long").alias("CNT_DRAWINGS_CURRENT"), F.col("dpd").alias("SK_DPD"),
        F.lit(0).cast("long").alias("SK_DPD_DEF"),
    )


def all_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"app": application(spark, d), "bureau": bureau(spark, d), "bureau_balance": bureau_balance(spark, d),
            "prev": previous_application(spark, d), "pos": pos_cash(spark, d), "cc": credit_card(spark, d),
            "inst": installments(spark, d)}
