"""Feature selection on metadata-sized tables: importance percentile filter,
correlation filter (order-dependent, non-greedy) and partner lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.profile import corr_pairs, percentiles_wide


def percentile_filter(importance: DataFrame, value: str, q: float = 0.25) -> DataFrame:
    """Keep rows whose ``value`` is strictly above the q-th (interpolated) percentile."""
    thr = percentiles_wide(importance, value, [q], ["_thr"]).withColumn("_g", F.lit(0))
    d = importance.withColumn("_g", F.lit(0)).join(F.broadcast(thr), "_g")   # one row: bounded
    return d.filter(F.col(value) > F.col("_thr")).drop("_g", "_thr")


def correlated_columns(df: DataFrame, ordered_cols: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Columns to drop: column j is dropped when any EARLIER column i (in the
    given importance order) has |r(i, j)| > threshold — dropped columns still
    count as earlier partners (the reference's non-greedy rule).

    Returns ``(feature, n_partners, partners)`` with partners in order.
    """
    order = {c: i for i, c in enumerate(ordered_cols)}
    pairs = corr_pairs(df, list(ordered_cols))          # (a, b) with a before b
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    hit = pairs.filter(F.abs(F.col("r")) > F.lit(threshold))
    return hit.groupBy(F.col("b").alias("feature")).agg(
        F.count(F.lit(1)).alias("n_partners"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct(pos[F.col("a")].alias("i"), F.col("a")))),
                                     lambda s: s["a"])).alias("partners"))
