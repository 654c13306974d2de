"""Entity rollups: many measures x functions x slices in ONE aggregate.

The reference groups a fact table many times (per slice, per status, per
function family) and index-aligns the pieces. Here every piece is a
conditional aggregate inside a single ``groupBy(entity).agg(...)``, so a fact
table is scanned once and shuffled once, and each aggregate is algebraic
(partial aggregation before the shuffle), which keeps hot entities cheap.

Naming follows ``{prefix}{measure}_{func}``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import col, count_if, safe_div, sum0

# pandas aggregate name -> Spark aggregate with pandas null semantics
AGG_FUNCS = {
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "sum": sum0,                    # all-NULL group -> 0
    "std": F.stddev_samp,           # ddof=1, one row -> NULL
    "std_pop": F.stddev_pop,        # ddof=0
    "count": F.count,               # non-null count
    "nunique": F.count_distinct,
    "median": F.median,
}


def measure_aggs(spec: Mapping[str, Sequence[str]], prefix: str = "", where: Column | None = None,
                 absent_when_empty: bool = True, rename: Mapping[str, str] | None = None) -> list[Column]:
    """Aggregates for ``{measure: [func, ...]}``.

    With ``where`` the aggregates only see matching rows (a recency slice or a
    status filter). ``absent_when_empty`` reproduces "entity missing from the
    filtered frame": every slice aggregate is NULL when no row matches.
    """
    rename = rename or {}
    out = []
    for m, funcs in spec.items():
        for f in funcs:
            c = F.col(m) if where is None else F.when(where, F.col(m))
            if f == "size":
                a = F.count(F.lit(1)) if where is None else count_if(where)
            else:
                a = AGG_FUNCS[f](c)
            if where is not None and absent_when_empty:
                a = F.when(count_if(where) > 0, a)
            name = f"{prefix}{m}_{f}"
            out.append(a.alias(rename.get(name, name)))
    return out


def size_agg(name: str, where: Column | None = None, absent_when_empty: bool = False) -> Column:
    """Row count (pandas ``size``) of the entity or of a slice."""
    if where is None:
        return F.count(F.lit(1)).cast("long").alias(name)
    a = count_if(where).cast("long")
    if absent_when_empty:
        a = F.nullif(a, F.lit(0))
    return a.alias(name)


def status_counts(status_col: str, values: Mapping[str, str], absent_when_zero: bool = True) -> list[Column]:
    """``{out_name: value}`` -> count of rows with that status (NULL when none)."""
    out = []
    for name, v in values.items():
        a = count_if(F.col(status_col) == F.lit(v)).cast("long")
        out.append((F.nullif(a, F.lit(0)) if absent_when_zero else a).alias(name))
    return out


def status_rates(status_col: str, values: Mapping[str, str], absent_when_zero: bool = True) -> list[Column]:
    """count(status = v) / count(*) per entity."""
    out = []
    for name, v in values.items():
        n = count_if(F.col(status_col) == F.lit(v))
        if absent_when_zero:
            n = F.nullif(n, F.lit(0))
        out.append(safe_div(n, F.count(F.lit(1))).alias(name))
    return out


def category_shares(cat_col: str, values: Sequence[str], prefix: str, suffix: str = "_RATIO") -> list[Column]:
    """One-hot, summed per entity, normalised by the row total of the dummies.

    NULL categories contribute to no dummy (so they are not in the total);
    an entity with only NULL categories gets NULL shares.
    """
    total = F.count(F.col(cat_col))
    return [safe_div(count_if(F.col(cat_col) == F.lit(v)), total).alias(f"{prefix}{v}{suffix}")
            for v in values]


def ratio(name: str, num, den) -> Column:
    return safe_div(col(num), col(den)).alias(name)


def rollup(df: DataFrame, key: str | Sequence[str], aggs: Sequence[Column],
           having: Column | None = None) -> DataFrame:
    """One row per non-NULL entity key (pandas drops NULL keys)."""
    keys = [key] if isinstance(key, str) else list(key)
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    out = df.filter(cond).groupBy(*keys).agg(*aggs)
    return out.filter(having) if having is not None else out


def slice_pred(time_col: str, lo: float | None = None, hi: float | None = None) -> Column:
    """lo <= t < hi (either side optional)."""
    t = F.col(time_col)
    p = F.lit(True)
    if lo is not None:
        p = p & (t >= F.lit(lo))
    if hi is not None:
        p = p & (t < F.lit(hi))
    return p
