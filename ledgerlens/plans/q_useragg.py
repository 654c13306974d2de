"""Aggregates written by a user, over the order history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import useragg as U
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import finish, query
from ledgerlens.sources import tables as T


@query("user_aggregates")
def user_aggregates(spark, d):
    h = T.hist(spark, d).withColumn("done", F.col("status") == "F")
    return finish(U.aggregate(h, "id", {
        "last3_done": U.last_k_share("day", "u", "done", 3),
        "mean_gap": U.mean_gap("day"),
        "amt_variation": U.variation("amt")}))


sql("user_aggregates", """
SELECT id, avg(CASE WHEN status = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (WHERE day IS NOT NULL AND rn <= 3) AS last3_done,
       CASE WHEN count(day) > 1 THEN CAST(max(day) - min(day) AS DOUBLE) / (count(day) - 1) END AS mean_gap,
       stddev_samp(amt) / nullif(avg(amt), 0) AS amt_variation
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day DESC NULLS LAST, u DESC, status = 'F' DESC) AS rn FROM hist)
WHERE id IS NOT NULL GROUP BY id""", ["hist"], rnd=["last3_done", "mean_gap", "amt_variation"])
