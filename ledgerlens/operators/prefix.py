"""Global-order computations (running sums, row numbers, cumulative maxima)
without an un-partitioned window.

A window with no PARTITION BY runs in one task. Instead the ordered rows are
cut into contiguous buckets by a bucket expression that is monotone in the
order: bucket totals (a small table) get an exclusive prefix, and a window
partitioned by bucket adds the running part inside each bucket.

Buckets are given (e.g. a hash-string prefix), or they are the cells of a prefix
tree: ``order_key`` turns the order column into a long of the same order, and
the cells of a level are its leading bits. A cell has at most 2^20 children
(2^24 below the root), so no window partition grows with the data; more rows
fill more cells. Cells depend on the values alone: nothing is sampled, no split
points are collected, no job runs while a plan is built, and a cell computed
twice is the same cell. ``quantile_bucketed`` (approximate quantiles, one job)
is for callers that ask for a number of buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INF = float("inf")


def quantile_bucketed(df: DataFrame, order_col: str, n_buckets: int = 256, out: str = "_bk",
                      rel_err: float | None = None) -> DataFrame:
    """Adds a bucket id that is monotone in ``order_col`` (equal values share a bucket).

    Split points come from approximate quantiles of ``order_col`` (any split points
    keep the result exact; they only steer how evenly the buckets fill).
    """
    if n_buckets <= 1:
        return df.withColumn(out, F.lit(0.0))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.select(F.col(order_col).cast("double").alias("_q")).filter(
        F.col("_q").isNotNull() & ~F.isnan("_q")).approxQuantile("_q", probs, rel_err or 1.0 / (4 * n_buckets))
    splits = sorted({q for q in qs if q == q and abs(q) != INF})
    splits = [-INF] + splits + [INF]
    d = df.withColumn("_bq", F.col(order_col).cast("double"))
    b = Bucketizer(splits=splits, inputCol="_bq", outputCol=out, handleInvalid="keep")
    return b.transform(d).drop("_bq")


def prefix_before(df: DataFrame, by: Sequence[str], order: Sequence[Column], bucket: Column,
                  measures: Mapping[str, Column], agg: str = "sum",
                  broadcast_totals: bool = False) -> DataFrame:
    """For each row, ``agg`` (sum or max) of each measure over the rows strictly
    before it in ``order`` within ``by``. ``order`` must be unique within ``by``
    and ``bucket`` monotone non-decreasing along it.

    ``broadcast_totals``: the bucket-total table has (#by groups x #buckets)
    rows; pass True only when both are bounded (e.g. 2 classes x 4096).
    """
    by = list(by)
    f = F.sum if agg == "sum" else F.max
    zero = F.lit(0) if agg == "sum" else F.lit(None)
    d = df.withColumn("_bk", bucket)
    for name, m in measures.items():
        d = d.withColumn(f"_m_{name}", m)
    tot = d.groupBy(*by, "_bk").agg(*[f(f"_m_{n}").alias(f"_t_{n}") for n in measures])
    w_b = (Window.partitionBy(*by).orderBy("_bk") if by else Window.orderBy("_bk")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*by, "_bk", *[f(f"_t_{n}").over(w_b).alias(f"_o_{n}") for n in measures])
    if broadcast_totals:
        tot = F.broadcast(tot)
    d = d.join(tot, by + ["_bk"], "inner")
    w_in = Window.partitionBy(*by, "_bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for n in measures:
        inner = f(f"_m_{n}").over(w_in)
        if agg == "sum":
            val = F.coalesce(F.col(f"_o_{n}"), zero) + F.coalesce(inner, zero)
        else:
            val = F.greatest(F.col(f"_o_{n}"), inner)
        d = d.withColumn(n, val)
    return d.drop("_bk", *[f"_m_{n}" for n in measures], *[f"_o_{n}" for n in measures])


SHIFTS = (20, 40)       # bits below the cells of each level, leaves first


def order_key(df: DataFrame, order_col: str) -> Column:
    """A long in the order of a numeric column: integers as they are, other numbers by the
    IEEE layout of their double (exponent, then mantissa; -0.0 is 0.0, NaN comes last).

    Powers of two are exact in ``pow`` and division by them is exact, so the logarithm
    is only a guess that two comparisons set right."""
    c = F.col(order_col)
    if df.schema[order_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        return c.cast("long")
    x = c.cast("double")
    a = F.when((F.abs(x) < INF) & (x != 0), F.abs(x)).otherwise(F.lit(1.0))
    bits = _bind(a, lambda v: _bind(
        F.greatest(F.floor(F.log2(v)), F.lit(-1022)).cast("double"), lambda g: _bind(
            F.pow(F.lit(2.0), g), lambda low: _bind(
                F.greatest(F.when(v < low, g - 1).when(v / low >= 2, g + 1).otherwise(g), F.lit(-1022.0)),
                lambda e: ((e + 1022).cast("long") * F.lit(1 << 52)
                           + (v / F.pow(F.lit(2.0), e) * F.lit(float(1 << 52))).cast("long"))))))
    top = F.lit(2047 << 52)
    return (F.when(F.isnan(x), top + 1).when(x == INF, top).when(x == -INF, -top)
             .when(x == 0, F.lit(0)).otherwise(F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)) * bits))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: expressions that nest several uses grow fast."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cell(key: str, shift: int) -> Column:
    return F.shiftright(F.col(key), shift)


def prefix_tree(df: DataFrame, by: Sequence[str], order_col: str, measures: Mapping[str, Column],
                agg: str = "sum", shifts: Sequence[int] = SHIFTS) -> DataFrame:
    """``prefix_before`` along ``order_col`` (numeric, not NULL, unique within ``by``) through the
    prefix tree: totals go up by levels, the part before a cell comes down by levels, and each
    level is a window over the children of one cell."""
    by = list(by)
    f = F.sum if agg == "sum" else F.max
    names = list(measures)
    cells = [f"_c{i}" for i in range(len(shifts))]
    d = df.withColumn("_key", order_key(df, order_col))
    for c, s in zip(cells, shifts):
        d = d.withColumn(c, _cell("_key", s))
    d = d.select("*", *[m.alias(f"_m_{n}") for n, m in measures.items()])
    tables, cur = [], d
    for i in range(len(cells)):
        cur = cur.groupBy(*by, *cells[i:]).agg(*[f(f"_m_{n}").alias(f"_m_{n}") for n in names])
        tables.append(cur)
    offsets = None
    for t, own, above in reversed(list(zip([d] + tables, ["_key"] + cells, cells + [None]))):
        w = (Window.partitionBy(*by, *([above] if above else [])).orderBy(own)
             .rowsBetween(Window.unboundedPreceding, -1))
        if offsets is not None:
            t = t.join(offsets, by + [above], "inner")
        for n in names:
            inner = f(f"_m_{n}").over(w)
            if agg == "sum":
                val = F.coalesce(inner, F.lit(0)) + (F.col(f"_o_{n}") if offsets is not None else F.lit(0))
            else:
                val = F.greatest(inner, F.col(f"_o_{n}")) if offsets is not None else inner
            t = t.withColumn(f"_v_{n}", val)
        offsets = t.select(*by, own, *[F.col(f"_v_{n}").alias(f"_o_{n}") for n in names])
    drop = ["_key", *cells, *[f"_m_{n}" for n in names], *[f"_o_{n}" for n in names]]
    return t.drop(*drop).withColumnsRenamed({f"_v_{n}": n for n in names})


def pairs_below(t: DataFrame, by: Sequence[str], order_col: str, high: str, low: str,
                shifts: Sequence[int] = SHIFTS) -> DataFrame:
    """Per group: ``pairs`` = sum over rows of high * (low of all rows below + low / 2), with the
    totals of both. Rows have distinct ``order_col`` within ``by`` (at least one column).

    Two rows meet in the lowest cell that holds both, as two children of it; each level
    counts the pairs of its cells and hands their totals up, in one pass without a join."""
    by = list(by)
    cur = t.select(*by, order_key(t, order_col).alias("_key"), F.col(high).alias("_h"), F.col(low).alias("_l"),
                   (F.col(high).cast("double") * F.col(low) / F.lit(2.0)).alias("_n"))
    done = 0
    for shift in [*shifts, None]:
        up = [] if shift is None else ["_up"]
        if up:
            cur = cur.withColumn("_up", _cell("_key", shift - done))
        w = Window.partitionBy(*by, *up).orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
        cur = (cur.withColumn("_n", F.col("_n") + F.col("_h").cast("double") * F.coalesce(F.sum("_l").over(w), F.lit(0)))
                  .groupBy(*by, *up).agg(F.sum("_h").alias("_h"), F.sum("_l").alias("_l"), F.sum("_n").alias("_n")))
        if up:
            cur, done = cur.withColumnRenamed("_up", "_key"), shift
    return cur.select(*by, F.col("_n").alias("pairs"), F.col("_h").alias("high"), F.col("_l").alias("low"))


def running_max(df: DataFrame, order_col: str, value_col: str, out: str = "running_max",
                n_buckets: int | None = None) -> DataFrame:
    """``cummax`` along a unique global order, inclusive of the current row."""
    if n_buckets is None:
        d = prefix_tree(df, [], order_col, {"_prev_max": F.col(value_col)}, agg="max")
        return d.withColumn(out, F.greatest(F.col("_prev_max"), F.col(value_col))).drop("_prev_max")
    d = quantile_bucketed(df, order_col, n_buckets, out="_qb")
    d = prefix_before(d, [], [F.col(order_col)], F.col("_qb"), {"_prev_max": F.col(value_col)},
                      agg="max", broadcast_totals=True)
    return d.withColumn(out, F.greatest(F.col("_prev_max"), F.col(value_col))).drop("_prev_max", "_qb")
