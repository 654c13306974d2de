"""Slices from a stored time index: A11, A12, P6, P7 for any cutoff, A5 and D9 by mergeable sketches."""

from __future__ import annotations

import uuid

from ledgerlens.functions.exprs import smooth_div
from ledgerlens.operators import timeindex as X
from ledgerlens.plans import q_rollup  # noqa: F401 (its SQL is used below)
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import ORACLE, ROUNDED, finish, query
from ledgerlens.session import checkpoint_dir
from ledgerlens.sources import tables as T


def _stored(spark, index):
    return X.store(index, f"{checkpoint_dir(spark)}/time-index-{uuid.uuid4().hex}")


@query("recent_vs_old_indexed")
def recent_vs_old_indexed(spark, d):
    index = _stored(spark, X.time_index(T.hist(spark, d), "id", "day", ["amt"]))
    bands = {"RECENT": (-730, None), "OLD": (None, -730)}
    aggs = {b: [("amt", f, f"{b}_amt_{f}") for f in fs] + [("amt", "size", f"{b}_CREDIT_COUNT")]
            for b, fs in (("RECENT", ("sum", "mean", "max")), ("OLD", ("sum", "mean")))}
    return finish(X.slices(index, "id", bands, aggs))


@query("band_window_indexed")
def band_window_indexed(spark, d):
    m = T.monthly(spark, d).withColumn("util", smooth_div("bal", "lim"))
    index = _stored(spark, X.time_index(m, "id", "period", ["draw", "pay", "util", "dpd"]))
    wanted = [("draw", "mean"), ("draw", "max"), ("pay", "mean"), ("util", "mean"), ("dpd", "mean")]
    return finish(X.slices(index, "id", {"b": (-12, -6)}, {"b": [(c, f, f"CC_OLD_{c}_{f}") for c, f in wanted]},
                           every_entity=False))


# the same results as the direct aggregates, so their SQL holds for both
for _direct, _indexed in (("recent_vs_old_agg", "recent_vs_old_indexed"), ("band_window_agg", "band_window_indexed")):
    ORACLE[_indexed], ROUNDED[_indexed] = ORACLE[_direct], ROUNDED[_direct]


@query("sketch_slices")
def sketch_slices(spark, d):
    """Distinct kinds and the median amount of two bands from sketches by entity and 30 days.
    Both are exact here: no entity comes near the sizes at which the sketches begin to estimate."""
    index = _stored(spark, X.time_index(T.hist(spark, d), "id", "day", ["amt"], distinct=["kind"], quantiles=["amt"],
                                        unit=30, levels=8))
    bands = {"recent": (-720, None), "middle": (-1500, -720)}
    aggs = {b: [("amt", "size", f"{b}_rows"), ("kind", "distinct", f"{b}_kinds"), ("amt", "0.5", f"{b}_median"),
                ("amt", "min", f"{b}_min")] for b in bands}
    return finish(X.slices(index, "id", bands, aggs, unit=30, levels=8))


_BANDS = (("recent", "day >= -720"), ("middle", "day >= -1500 AND day < -720"))
sql("sketch_slices", "SELECT id, " + ", ".join(
    f"""nullif(count(*) FILTER (WHERE {p}), 0) AS {b}_rows,
        CASE WHEN count(*) FILTER (WHERE {p}) > 0 THEN count(DISTINCT kind) FILTER (WHERE {p}) END AS {b}_kinds,
        quantile_disc(amt, 0.5) FILTER (WHERE {p}) AS {b}_median, min(amt) FILTER (WHERE {p}) AS {b}_min"""
    for b, p in _BANDS) + " FROM hist GROUP BY id", ["hist"],
    rnd=[f"{b}_{c}" for b, _ in _BANDS for c in ("median", "min")])
