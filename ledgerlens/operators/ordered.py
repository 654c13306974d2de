"""Ordered per-entity analytics without per-entity sorting of whole histories.

Every ordered feature of the reference (first-vs-last, head/tail means,
streaks, half splits, last-k rates, gaps, percentile ranks) reduces to
conditional aggregates over two row numbers per entity:

* ``_rn_a``  position in (time asc,  tiebreak asc)   -- pandas ``iloc`` / ``nsmallest``
* ``_rn_d``  position in (time desc, tiebreak asc)   -- pandas ``nlargest(keep='first')``
* ``_n``     rows of the entity

Rows of an entity meet in one task, which numbers them in one sort; only the
columns that are read later travel there. So that one entity holding a large share
of all rows is never sorted by one task, the keys of more than ``HOT_ROWS`` rows
are found first (a count by key; at most rows / HOT_ROWS keys reach the driver),
and the rows of these keys alone are numbered in two levels:

1. a histogram ``(entity, time, cell) -> rows`` (partial aggregation, skew-safe)
   gives for every time value the number of rows before / after it; cells cut the
   rows of one time (or without a time) by the leading bits of the first tiebreak;
2. a window partitioned by ``(entity, time, cell)`` numbers the rows that share
   all three by the tiebreak.

``_rn_a = before + rn_within`` and ``_rn_d = after + rn_within``; both use the
same within-time order (tiebreak asc), matching pandas' keep-first ties.
A numeric first tiebreak has at most 2^CELL_BITS values in a cell, so an entity with
one time for all rows is split as well; one of another type leaves a time whole.

Wide aggregates follow: a row in an aggregation buffer is several times as large as
the row, so partial aggregation pays only where the rows of an entity lie together.
They do after the ranks; ``clustered`` brings them together for aggregates without ranks.

First/last values (W2/W3) need no ranks at all: ``max_by/min_by`` over
``struct(time, tiebreak)`` are algebraic aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerlens.functions.exprs import col, flag, safe_div, sum0
from ledgerlens.operators.prefix import order_key

N, RN_A, RN_D = "_n", "_rn_a", "_rn_d"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


CELL_BITS = 20
HOT_ROWS = 1 << 20          # rows of an entity that one task may hold
SALTS = 256


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def _hot_keys(base: DataFrame, keys: Sequence[str], hot_rows: int | None) -> DataFrame | None:
    """The keys of more than ``hot_rows`` (HOT_ROWS) rows as a small frame with ``_hot``, or None."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    big = (base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > hot_rows)
               .select(*keys))
    found = big.collect()
    if not found:
        return None
    return F.broadcast(base.sparkSession.createDataFrame(found, big.schema).withColumn("_hot", F.lit(True)))


def clustered(df: DataFrame, key, hot_rows: int | None = None) -> DataFrame:
    """The rows with the keys' rows together, for wide aggregates by key; the rows of a key
    of more than ``hot_rows`` are spread over ``SALTS`` parts. NULL keys are dropped."""
    keys = _keys(key)
    base = _keyed(df, keys)
    hot = _hot_keys(base, keys, hot_rows)
    if hot is None:
        return base.repartition(*keys)
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*base.columns), F.lit(SALTS))).otherwise(F.lit(0))
    return base.join(hot, keys, "left").withColumn("_salt", salt).repartition(*keys, "_salt").select(*df.columns)


def with_order_ranks(df: DataFrame, key, time: str, tiebreak: Sequence[str], cell_bits: int = CELL_BITS,
                     hot_rows: int | None = None, joined_on_first: bool = False) -> DataFrame:
    """Adds ``_n``, ``_rn_a``, ``_rn_d`` (see module doc). NULL keys are dropped.

    ``time`` is a numeric offset; rows with a NULL time are kept and rank after
    all timed rows in both directions (pandas ``na_position='last'``, and
    ``nlargest``, which takes them only when timed rows run out). A NULL tiebreak ranks first.
    ``joined_on_first``: the rows come out of a join on ``tiebreak[0]`` and lie together by it;
    their position there replaces the other tiebreak columns on the way to the entity.
    """
    keys = _keys(key)
    base = _keyed(df, keys)
    hot = _hot_keys(base, keys, hot_rows)
    tk = F.coalesce(F.col(time).cast("double"), F.lit(float("inf")))
    if hot is None:
        tie = list(tiebreak)
        if joined_on_first and len(tie) > 2:
            w = Window.partitionBy(*keys, tie[0]).orderBy(*[F.col(c).asc() for c in tie[1:]])
            base, tie = base.withColumn("_tp", F.row_number().over(w)), [tie[0], "_tp"]
        rows, part = base.repartition(*keys).withColumn("_tk", tk), keys
    else:
        tie, part = tiebreak, [*keys, "_ct", "_cc"]
        cell = (F.coalesce(F.shiftright(order_key(df, tie[0]), cell_bits), F.lit(-(1 << 63)))
                if isinstance(df.schema[tie[0]].dataType, NumericType) else F.lit(0).cast("long"))
        base = base.withColumn("_tk", tk).withColumn("_tc", cell)
        hist = _histogram(base.join(hot.drop("_hot"), keys, "left_semi"), keys)
        rows = (base.join(hot, keys, "left")
                    .withColumn("_ct", F.when(F.col("_hot"), F.col("_tk")).otherwise(F.lit(0.0)))
                    .withColumn("_cc", F.when(F.col("_hot"), F.col("_tc")).otherwise(F.lit(0)))
                    .join(hist, part, "left"))
    # one sort serves both orders
    w_rows = Window.partitionBy(*part).orderBy("_tk", *[F.col(c).asc() for c in tie])
    w_all = w_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_time = Window.partitionBy(*part).orderBy("_tk")
    untimed = F.col("_tk") == F.lit(float("inf"))
    rows = (rows.withColumn("_rn", F.row_number().over(w_rows).cast("long"))
                .withColumn("_pn", F.count(F.lit(1)).over(w_all))
                .withColumn("_pt", F.count(F.when(~untimed, F.lit(1))).over(w_all))
                .withColumn("_pb", F.rank().over(w_time).cast("long") - F.lit(1))
                .withColumn("_pu", F.count(F.lit(1)).over(w_time.rangeBetween(Window.unboundedPreceding,
                                                                             Window.currentRow))))
    n, timed, before, through, rn = (F.col(c) for c in ("_pn", "_pt", "_pb", "_pu", "_rn"))
    if hot is not None:     # a row of a hot key saw the rows of its cell only
        split = F.col("_hn").isNotNull()
        rn = F.when(split, F.col("_hb") + F.col("_hi") + rn).otherwise(rn)
        n, timed, before, through = (F.when(split, F.col(h)).otherwise(c) for h, c in
                                     (("_hn", n), ("_ht", timed), ("_hb", before), ("_hu", through)))
    rows = rows.withColumns({N: n, RN_A: rn,
                             RN_D: rn - before + F.when(untimed, timed).otherwise(timed - through)})
    return rows.select(*df.columns, N, RN_A, RN_D)


def _histogram(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (key, time, cell): rows of the key, timed ones, those before the time, in the time before
    the cell, and up to the end of the time."""
    hist = rows.groupBy(*keys, "_tk", "_tc").agg(F.count(F.lit(1)).alias("_cn"))
    # one ordered spec for all sums, so the histogram is sorted once
    w_all = Window.partitionBy(*keys).orderBy("_tk", "_tc").rowsBetween(Window.unboundedPreceding,
                                                                        Window.unboundedFollowing)
    w_run = Window.partitionBy(*keys).orderBy("_tk", "_tc").rowsBetween(Window.unboundedPreceding, -1)
    w_time = Window.partitionBy(*keys, "_tk").orderBy("_tc").rowsBetween(Window.unboundedPreceding, -1)
    w_times = Window.partitionBy(*keys, "_tk").orderBy("_tc").rowsBetween(Window.unboundedPreceding,
                                                                          Window.unboundedFollowing)
    untimed = F.col("_tk") == F.lit(float("inf"))
    hist = (hist.withColumn("_hn", F.sum("_cn").over(w_all))
                .withColumn("_ht", F.coalesce(F.sum(F.when(~untimed, F.col("_cn"))).over(w_all), F.lit(0)))
                .withColumn("_before", F.coalesce(F.sum("_cn").over(w_run), F.lit(0)))
                .withColumn("_hi", F.coalesce(F.sum("_cn").over(w_time), F.lit(0)))
                .withColumn("_tn", F.sum("_cn").over(w_times))
                .withColumn("_hb", F.col("_before") - F.col("_hi"))
                .withColumn("_hu", F.col("_hb") + F.col("_tn")))
    return hist.select(*keys, F.col("_tk").alias("_ct"), F.col("_tc").alias("_cc"), "_hn", "_ht", "_hb", "_hi", "_hu")


def pct_rank(df: DataFrame, key, time: str, out: str = "pct_rank") -> DataFrame:
    """pandas ``groupby(key)[time].rank(pct=True)``: average rank of ties divided
    by the number of non-NULL values; NULL time -> NULL. Histogram based."""
    keys = _keys(key)
    base = df
    for k in keys:
        base = base.filter(F.col(k).isNotNull())
    hist = base.filter(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_tn"))
    w_ent = Window.partitionBy(*keys)
    w_run = w_ent.orderBy(time).rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.select(*keys, time, (
        (F.coalesce(F.sum("_tn").over(w_run), F.lit(0)) + (F.col("_tn") + F.lit(1)) / F.lit(2.0))
        / F.sum("_tn").over(w_ent)).alias(out))
    return base.join(hist, keys + [time], "left")


# ---------------------------------------------------------------- aggregates
# All builders below return aggregate Columns for ``groupBy(entity).agg`` on a
# frame produced by ``with_order_ranks``.

def n_rows() -> Column:
    return F.count(F.lit(1))


def _order(time: str, tiebreak: Sequence[str]) -> Column:
    # rows without a time come last, as in the ranks
    return F.struct(F.col(time).isNull(), F.col(time), *[F.col(c) for c in tiebreak])


def first_value(v, time, tiebreak) -> Column:
    return F.min_by(col(v), _order(time, tiebreak))


def last_value(v, time, tiebreak) -> Column:
    return F.max_by(col(v), _order(time, tiebreak))


def first_last_change(v, time, tiebreak, min_n: int = 2, default: float = 0.0) -> Column:
    """Last - first when n >= min_n else default (NULL endpoint -> NULL)."""
    return F.when(n_rows() >= min_n, last_value(v, time, tiebreak) - first_value(v, time, tiebreak)) \
        .otherwise(F.lit(default))


def relative_change(v, time, tiebreak, min_n: int = 2, default: float = 0.0) -> Column:
    """(last - first) / (first + 1)."""
    first = first_value(v, time, tiebreak)
    return F.when(n_rows() >= min_n, safe_div(last_value(v, time, tiebreak) - first, first + F.lit(1.0))) \
        .otherwise(F.lit(default))


def head_mean(v, k: int) -> Column:
    """mean of the k oldest rows (iloc[:k] / nsmallest)."""
    return F.avg(F.when(F.col(RN_A) <= k, col(v)))


def tail_mean(v, k: int) -> Column:
    """mean of the k last rows in ascending order (iloc[-k:] / tail(k))."""
    return F.avg(F.when(F.col(RN_A) > F.col(N) - k, col(v)))


def newest_mean(v, k: int) -> Column:
    """mean of nlargest(k, time) with keep='first'."""
    return F.avg(F.when(F.col(RN_D) <= k, col(v)))


def tail_head_diff(v, k: int, min_n: int, default: float = 0.0) -> Column:
    """tail(k).mean() - head(k).mean(), default when n < min_n."""
    return F.when(n_rows() >= min_n, tail_mean(v, k) - head_mean(v, k)).otherwise(F.lit(default))


def leading_streak(good: Column) -> Column:
    """Consecutive ``good`` rows from the newest back (NULL counts as not good)."""
    bad_first = F.min(F.when(~F.coalesce(good, F.lit(False)), F.col(RN_D)))
    return F.coalesce(bad_first - F.lit(1), n_rows()).cast("long")


def half_split_diff(v, min_n: int = 6, default: float = 0.0) -> Column:
    """mean(iloc[mid:]) - mean(iloc[:mid]) with mid = n // 2."""
    mid = F.floor(F.col(N) / F.lit(2))
    second = F.avg(F.when(F.col(RN_A) > mid, col(v)))
    first = F.avg(F.when(F.col(RN_A) <= mid, col(v)))
    return F.when(n_rows() >= min_n, second - first).otherwise(F.lit(default))


def last_k_mean(v, k: int = 3, min_n: int = 3, default: float = 0.0) -> Column:
    """nlargest(k, time)[v].mean(), default when n < min_n."""
    return F.when(n_rows() >= min_n, newest_mean(v, k)).otherwise(F.lit(default))


def newest_oldest_rel_change(v, k: int = 3, min_n: int = 3, default: float = 0.0) -> Column:
    """(mean nlargest(k) - mean nsmallest(k)) / (mean nsmallest(k) + 1)."""
    recent, older = newest_mean(v, k), head_mean(v, k)
    return F.when(n_rows() >= min_n, safe_div(recent - older, older + F.lit(1.0))).otherwise(F.lit(default))


def ratio_of_sums_trend(num, den, k: int = 3, min_n: int = 3, default: float = 1.0) -> Column:
    """Σnum/(Σden+1) over iloc[-k:] minus the same over iloc[:k]."""
    tail = F.col(RN_A) > F.col(N) - k
    head = F.col(RN_A) <= k
    r_tail = safe_div(sum0(F.when(tail, col(num))), sum0(F.when(tail, col(den))) + F.lit(1.0))
    r_head = safe_div(sum0(F.when(head, col(num))), sum0(F.when(head, col(den))) + F.lit(1.0))
    return F.when(n_rows() >= min_n, r_tail - r_head).otherwise(F.lit(default))


def mean_abs_gap(time: str, min_n: int = 2, default: float = 0.0) -> Column:
    """Mean |diff| of the time column in time order.

    Sorted by the time itself, the absolute gaps telescope: their sum is
    max - min over the non-NULL values and there are count - 1 of them.
    An algebraic aggregate, so no ordering is needed at all.
    """
    t = F.col(time).cast("double")
    return F.when(n_rows() >= min_n, safe_div(F.max(t) - F.min(t), F.count(t) - F.lit(1))) \
        .otherwise(F.lit(default))


def newest_k_rate(pred: Column, k: int = 3) -> Column:
    """Share of ``pred`` among the min(k, n) newest rows."""
    hits = F.sum(F.when(F.col(RN_D) <= k, flag(pred)).otherwise(0))
    return safe_div(hits, F.least(F.lit(k), n_rows()))


def older_rate(pred: Column, k: int = 3) -> Column:
    """Share of ``pred`` among nsmallest(n - k) rows; 0 when n <= k."""
    return F.when(n_rows() > k, F.avg(F.when(F.col(RN_A) <= F.col(N) - k, flag(pred)))).otherwise(F.lit(0.0))


def volatility(v, min_n: int = 2, default: float = 0.0) -> Column:
    """Std / (mean + 1), default when n < min_n."""
    return F.when(n_rows() >= min_n, safe_div(F.stddev_samp(col(v)), F.avg(col(v)) + F.lit(1.0))) \
        .otherwise(F.lit(default))


def top_k_per_group(df: DataFrame, key, order: Sequence[Column], k: int, salt_buckets: int = 64,
                    salt_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k per key by ``order`` (a unique order), as a
    two-stage top-k: first per (key, salt), then per key over at most
    ``salt_buckets * k`` survivors. A hot key is spread over the salts.
    Adds ``rank`` (1-based)."""
    keys = _keys(key)
    salt = F.pmod(F.hash(*[F.col(c) for c in (salt_col and [salt_col] or df.columns)]), F.lit(salt_buckets))
    s1 = (df.withColumn("_salt", salt)
            .withColumn("_r1", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
            .filter(F.col("_r1") <= k).drop("_r1", "_salt"))
    return (s1.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
              .filter(F.col("rank") <= k))
