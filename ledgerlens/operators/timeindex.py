"""Slices for any cutoff from one stored index of merged aggregates.

``time_index`` rolls an entity's rows up to time units, then pairs of units, pairs
of pairs and so on: node ``n`` of level ``j`` covers the units ``[n * 2^j, (n + 1) * 2^j)``.
A row holds what merges: counts, sums, minima, maxima and, if asked for, a distinct
sketch (HyperLogLog) or a quantile sketch (KLL) of a measure. ``slices`` reads a band
``lo <= time < hi`` as at most two nodes a level (an open side adds all nodes of the top
level beyond it), so new cutoffs never read the fact table again, and minima and maxima,
which can't be subtracted, cost no more than sums.

Each level is a partial aggregation of the level below, by (entity, node): a hot entity is
one row per map task and node, not its history. Stored by level, a band reads the folders of
its levels only. Exact parts equal the direct conditional aggregates; sketches are opt-in and
carry the errors of their kind (at the default sizes about 1.6% of a distinct count, one
standard error, and 1.3% of rank; counts far below the sketch size are exact).

Rows with a NULL entity are dropped, rows without a time are in no slice (level -1 keeps their
entity), NULL measures count nowhere but in the number of rows. An empty table gives no rows.
Measure columns are read by name only, so further columns of the table can't clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import safe_div

LEVELS = 12          # the top level covers 4,096 units
UNTIMED = -1
Band = tuple[int | None, int | None]


def time_index(df: DataFrame, key: str, time: str, measures: Sequence[str], distinct: Sequence[str] = (),
               quantiles: Sequence[str] = (), unit: int = 1, levels: int = LEVELS) -> DataFrame:
    """(key, level, node, n, and per measure m: ``m_n m_sum m_min m_max``; ``c_hll``, ``c_kll`` for sketches)."""
    if unit < 1 or not 1 <= levels <= 40:
        raise ValueError("unit is a positive whole number, levels are 1 to 40")
    t = F.floor(F.col(time) / F.lit(unit)).cast("long")
    base = df.filter(F.col(key).isNotNull()).select(
        F.col(key), F.when(F.col(time).isNull(), UNTIMED).otherwise(0).alias("level"),
        F.coalesce(t, F.lit(0)).alias("node"), *[F.col(c).alias(f"_v_{c}") for c in dict.fromkeys([*measures, *distinct, *quantiles])])
    level = base.groupBy(key, "level", "node").agg(
        F.count(F.lit(1)).alias("n"),
        *[a for m in measures for a in (
            F.count(f"_v_{m}").alias(f"{m}_n"), F.sum(f"_v_{m}").alias(f"{m}_sum"),
            F.min(f"_v_{m}").alias(f"{m}_min"), F.max(f"_v_{m}").alias(f"{m}_max"))],
        *[F.hll_sketch_agg(f"_v_{c}").alias(f"{c}_hll") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(f"_v_{c}").cast("double")).alias(f"{c}_kll") for c in quantiles])
    merged = [F.sum("n").alias("n")] + [f(c).alias(c) for c, f in _merges(level.columns[4:])]
    out, timed = level, level.filter(F.col("level") >= 0)
    for j in range(1, levels + 1):
        timed = (timed.withColumn("level", F.lit(j)).withColumn("node", F.shiftright("node", 1))
                      .groupBy(key, "level", "node").agg(*merged))
        out = out.unionByName(timed)
    return out


def _merges(columns: Sequence[str]):
    ends = {"_n": F.sum, "_sum": F.sum, "_min": F.min, "_max": F.max, "_hll": F.hll_union_agg, "_kll": F.kll_merge_agg_double}
    return [(c, next(f for e, f in ends.items() if c.endswith(e))) for c in columns]


def store(index: DataFrame, path: str) -> DataFrame:
    """Writes the index by level and reads it back (a table in a shared folder, not a local one)."""
    index.write.mode("overwrite").partitionBy("level").parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def nodes(lo: int | None, hi: int | None, levels: int) -> list[tuple[int, int | None, int | None]]:
    """The fewest (level, first node, node after the last) that cover ``[lo, hi)``; None is open."""
    out = []
    for j in range(levels):
        if lo is not None and hi is not None and lo >= hi:
            return out
        if lo is not None and lo & 1:
            out.append((j, lo, lo + 1))
            lo += 1
        if hi is not None and hi & 1 and (lo is None or lo < hi):
            hi -= 1
            out.append((j, hi, hi + 1))
        lo, hi = (None if lo is None else lo >> 1), (None if hi is None else hi >> 1)
    if lo is None or hi is None or lo < hi:
        out.append((levels, lo, hi))
    return out


def _inside(band: Band, unit: int, levels: int) -> Column:
    if any(b is not None and b % unit for b in band):
        raise ValueError(f"cutoffs {band} are not multiples of the unit {unit}")
    lo, hi = (None if b is None else b // unit for b in band)
    pred = F.lit(False)
    for j, first, last in nodes(lo, hi, levels):
        p = F.col("level") == j
        if first is not None:
            p = p & (F.col("node") >= first)
        if last is not None:
            p = p & (F.col("node") < last)
        pred = pred | p
    return pred


def slices(index: DataFrame, key: str, bands: Mapping[str, Band], aggs: Mapping[str, Sequence[tuple[str, str, str]]],
           unit: int = 1, levels: int = LEVELS, every_entity: bool = True) -> DataFrame:
    """One row per entity with, for each band, its ``aggs``: (measure, function, output name).

    Functions: ``size`` (rows, measure unused, NULL when there are none), ``count sum mean min max``,
    ``distinct`` (NULL without rows) and a number in 0..1 as text (a quantile). With ``every_entity`` entities without a row in
    any band are kept, else they are left out. ``unit`` and ``levels`` are those of the index."""
    preds = {b: _inside(band, unit, levels) for b, band in bands.items()}
    used = F.lit(False)
    for p in preds.values():
        used = used | p
    cols = []
    for b, wanted in aggs.items():
        at = lambda c, p=preds[b]: F.when(p, F.col(c))
        for m, fn, name in wanted:
            if fn == "size":
                e = F.sum(at("n"))
            elif fn == "count":
                e = F.coalesce(F.sum(at(f"{m}_n")), F.lit(0))
            elif fn == "mean":
                e = safe_div(F.sum(at(f"{m}_sum")), F.sum(at(f"{m}_n")))
            elif fn in ("sum", "min", "max"):
                e = getattr(F, fn)(at(f"{m}_{fn}"))
            elif fn == "distinct":
                e = F.when(F.sum(at("n")) > 0, F.hll_sketch_estimate(F.hll_union_agg(at(f"{m}_hll"))))
            else:
                sketch = F.kll_merge_agg_double(at(f"{m}_kll"))
                e = F.when(F.coalesce(F.sum(F.when(preds[b], F.kll_sketch_get_n_double(F.col(f"{m}_kll")))), F.lit(0)) > 0,
                           F.kll_sketch_get_quantile_double(sketch, F.lit(float(fn))))
            cols.append(e.alias(name))
    keep = used | F.col("level").isin(levels, UNTIMED) if every_entity else used
    return index.filter(keep).groupBy(key).agg(*cols)
