"""Profiling: missing report, describe, value counts, box statistics,
histograms, exact percentiles and pairwise correlation.

Exact percentiles at scale (``exact_percentiles``)
--------------------------------------------------
Spark's exact ``percentile`` keeps a value->count map per group and merges it
in one task, which does not survive a continuous column of a hundred
billion rows. Instead:

1. ``percentile_approx`` (a mergeable sketch with rank error <= n/accuracy)
   brackets every requested rank: lo = q(p - m/acc), hi = q(p + m/acc);
2. one pass counts the rows below lo and keeps only the rows inside
   [lo, hi] (about 2m·n/accuracy of them);
3. the candidates collapse to distinct values with counts, and a window over
   those picks the exact order statistics at floor(p(n-1)) and ceil(p(n-1))
   and interpolates linearly (numpy's and DuckDB's ``quantile_cont`` rule).

Brackets are joined to the rows by a salted key, so a large group is spread
over the salts whether or not the small side can be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import count_if, safe_div


#: pieces of a group in a join of rows with the table of groups
SALTS = 32


def _nonnull_double(df: DataFrame, by: Sequence[str], value) -> DataFrame:
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def exact_percentiles(df: DataFrame, value, probs: Sequence[float], by: Sequence[str] = (),
                      accuracy: int = 100_000, margin: float = 3.0) -> DataFrame:
    """Long result ``(*by, p_idx, p, value)``; linear interpolation, NULLs skipped."""
    by = list(by)
    keys = by or ["_g"]
    base = _nonnull_double(df, by, value)
    if not by:
        base = base.withColumn("_g", F.lit(0))
    eps = margin / accuracy
    lo_p = [max(0.0, p - eps) for p in probs]
    hi_p = [min(1.0, p + eps) for p in probs]
    stats = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", lo_p, accuracy).alias("_lo"),
        F.percentile_approx("_v", hi_p, accuracy).alias("_hi"))
    # a single row without ``by`` (bounded)
    if by:
        salt = F.pmod(F.hash("_v"), F.lit(SALTS))
        salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        j = base.withColumn("_salt", salt).join(salted, keys + ["_salt"]).drop("_salt")
    else:
        j = base.join(F.broadcast(stats), keys)
    m = len(probs)
    lo_i = [F.get(F.col("_lo"), i) for i in range(m)]
    hi_i = [F.get(F.col("_hi"), i) for i in range(m)]
    # per group and percentile: rows below the bracket, rows up to its top,
    # and the nearest values just outside it (covers off-by-one ranks)
    edges = j.groupBy(*keys).agg(
        F.first("_n").alias("_n"),
        F.array(*[count_if(F.col("_v") < lo_i[i]) for i in range(m)]).alias("_below"),
        F.array(*[count_if(F.col("_v") <= hi_i[i]) for i in range(m)]).alias("_upto"),
        F.array(*[F.max(F.when(F.col("_v") < lo_i[i], F.col("_v"))) for i in range(m)]).alias("_prev"),
        F.array(*[F.min(F.when(F.col("_v") > hi_i[i], F.col("_v"))) for i in range(m)]).alias("_next"))
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    targets = edges.select(*keys, "_n", F.posexplode(F.arrays_zip("_below", "_upto", "_prev", "_next")).alias("p_idx", "_e"))
    pos = F.get(probs_arr, F.col("p_idx")) * (F.col("_n") - F.lit(1))
    targets = targets.select(*keys, "p_idx", F.col("_e._below").alias("_nb"), F.col("_e._upto").alias("_nu"),
                             F.col("_e._prev").alias("_prev"), F.col("_e._next").alias("_next"),
                             pos.alias("_pos"), F.floor(pos).alias("_k0"), F.ceil(pos).alias("_k1"))
    in_bracket = F.filter(F.sequence(F.lit(0), F.lit(m - 1)),
                          lambda i: (F.get(F.col("_lo"), i) <= F.col("_v")) & (F.col("_v") <= F.get(F.col("_hi"), i)))
    # equal values are one candidate with a count (map-side combine): a value held by a third of all rows is one row
    cand = j.select(*keys, "_v", F.explode(in_bracket).alias("p_idx")).groupBy(*keys, "p_idx", "_v").agg(F.count(F.lit(1)).alias("_c"))
    cand = cand.join(targets.select(*keys, "p_idx", "_nb", "_k0", "_k1"), keys + ["p_idx"])
    upto = F.sum("_c").over(Window.partitionBy(*keys, "p_idx").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    cand = cand.withColumn("_last", F.col("_nb") + upto - F.lit(1)).withColumn("_first", F.col("_last") - F.col("_c") + F.lit(1))

    def holds(k):
        return (F.col("_first") <= F.col(k)) & (F.col(k) <= F.col("_last"))
    res = cand.filter(holds("_k0") | holds("_k1")).groupBy(*keys, "p_idx").agg(
        F.max(F.when(holds("_k0"), F.col("_v"))).alias("_v0"), F.max(F.when(holds("_k1"), F.col("_v"))).alias("_v1"))
    t = targets.join(res, keys + ["p_idx"], "left")

    def pick(v, k):
        return F.coalesce(F.col(v), F.when(F.col(k) == F.col("_nb") - 1, F.col("_prev")),
                          F.when(F.col(k) == F.col("_nu"), F.col("_next")),
                          F.raise_error(F.lit("percentile bracket missed its rank")).cast("double"))

    v0, v1 = pick("_v0", "_k0"), pick("_v1", "_k1")
    val = v0 + (F.col("_pos") - F.col("_k0")) * (v1 - v0)
    return t.select(*by, F.col("p_idx").cast("int").alias("p_idx"),
                    F.get(probs_arr, F.col("p_idx")).alias("p"), val.alias("value"))


def percentiles_wide(df: DataFrame, value, probs: Sequence[float], names: Sequence[str],
                     by: Sequence[str] = (), accuracy: int = 100_000) -> DataFrame:
    """One row per group with one column per requested percentile."""
    long = exact_percentiles(df, value, probs, by, accuracy)
    aggs = [F.max(F.when(F.col("p_idx") == i, F.col("value"))).alias(n) for i, n in enumerate(names)]
    if by:
        return long.groupBy(*by).agg(*aggs)
    return long.agg(*aggs)


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "feature",
            val: str = "value") -> DataFrame:
    """Wide -> long (feature, value) with values cast to double."""
    d = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return d.unpivot(list(ids), list(cols), var, val)


def missing_report(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """(feature, missing, missing_pct) sorted by count desc: one aggregate pass."""
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = row.unpivot(["_rows"], cols, "feature", "missing")
    long = long.select("feature", F.col("missing").cast("long").alias("missing"),
                       (F.lit(100.0) * safe_div("missing", "_rows")).alias("missing_pct"))
    if only_missing:
        long = long.filter(F.col("missing") > 0)
    return long.orderBy(F.desc("missing"), "feature")


def describe(df: DataFrame, cols: Sequence[str], accuracy: int = 100_000) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per column (long by feature)."""
    long = unpivot(df, [], cols)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = percentiles_wide(long, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], ["feature"], accuracy)
    return basic.join(q, "feature", "left")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count, share) — pandas ``value_counts`` plus the normalised share."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).withColumn("_g", F.lit(0))
    tot = c.groupBy("_g").agg(F.sum("count").alias("_tot"))
    return c.join(F.broadcast(tot), "_g").select(col, "count", safe_div("count", "_tot").alias("share"))


def box_stats(df: DataFrame, value: str, by: Sequence[str], whisker: float = 1.5,
              accuracy: int = 100_000, below: float | None = None) -> DataFrame:
    """Quartiles and whiskers (furthest data point within whisker·IQR);
    ``below`` keeps values under a cap only, as a plot of the bulk does."""
    by = list(by)
    if below is not None:
        df = df.filter(F.col(value) < F.lit(float(below)))
    q = percentiles_wide(df, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"], by, accuracy)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    v = F.col(value).cast("double")
    salted = q.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    j = (df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull())
         .withColumn("_salt", F.pmod(F.hash("_v"), F.lit(SALTS))).join(salted, by + ["_salt"]).drop("_salt"))
    lo_fence = F.col("q1") - F.lit(whisker) * F.col("iqr")
    hi_fence = F.col("q3") + F.lit(whisker) * F.col("iqr")
    w = j.groupBy(*by).agg(
        F.min(F.when(F.col("_v") >= lo_fence, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(F.col("_v") <= hi_fence, F.col("_v"))).alias("whisker_hi"),
        count_if((F.col("_v") < lo_fence) | (F.col("_v") > hi_fence)).cast("long").alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return q.join(w, by)


def histogram(df: DataFrame, value: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the global [min, max]; bin 1..bins (max lands in the last bin)."""
    by = list(by)
    v = F.col(value).cast("double")
    base = df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull()).withColumn("_g", F.lit(0))
    rng = base.groupBy("_g").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    j = base.join(F.broadcast(rng), "_g")            # one row: bounded
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width) * F.lit(bins)) + F.lit(1), F.lit(bins)))
    out = j.withColumn("bin", b.cast("long")).groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    return out.select(*by, "bin", "count",
                      (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / F.lit(bins)).alias("bin_lo"))


def corr_expr(a: str, b: str) -> Column:
    """Pairwise-complete Pearson r; NULL for a constant column (no exception)."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


#: pair aggregates in one aggregation; wider inputs take the matrix form below
MAX_PAIR_AGGREGATES = 1_000


def corr_pairs(df: DataFrame, cols: Sequence[str], upper_only: bool = True,
               max_aggregates: int = MAX_PAIR_AGGREGATES) -> DataFrame:
    """Long correlation table (a, b, r) from one pass, pairwise complete at
    every width: a pair uses the rows where both are present, whatever the
    other columns hold; a constant column gives NULL.

    Few pairs: each is an algebraic aggregate (co-moments). Many pairs: the
    same sums of all pairs at once as matrix products inside each task.
    """
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(len(cols))
             if (i < j if upper_only else i != j)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    if len(pairs) > max_aggregates:
        return _corr_pairs_wide(df, list(cols), upper_only)
    row = df.agg(*[corr_expr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
                                for i, (a, b) in enumerate(pairs)]))
    return row.select(stack.alias("_p")).select("_p.a", "_p.b", "_p.r")


def _corr_pairs_wide(df: DataFrame, cols: list[str], upper_only: bool) -> DataFrame:
    """One pass: each task adds up, for all pairs at once, the products of the
    matrices of values (NULL as 0, less what the task's first batch has on average),
    their squares and the masks of present values; means and co-moments of the
    tasks meet by pair, as the ones of two parts of a table make those of the whole."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    p = len(cols)
    # More than 100 columns (spark.sql.codegen.maxFields): such a projection is generated in small methods.  One of a
    # few dozen expressions is a single method of over 8,000 bytes, which the JVM interprets (9.3 against 0.8 s at sf0.1).
    wide = [F.lit(None).cast("byte").alias(f"w{i}") for i in range(p, 101)]
    d = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)], *wide)

    def gram(batches):
        from pyspark import TaskContext
        both, squares, shift = np.zeros((2 * p, 2 * p)), np.zeros((p, p)), None
        for b in batches:
            if not b.num_rows:
                continue
            z = np.empty((2 * p, b.num_rows))
            for i in range(p):
                z[p + i] = b.column(i).to_numpy(zero_copy_only=False)
            m, x = z[:p], z[p:]
            m[:] = ~np.isnan(x)
            x[m == 0] = 0.0
            if shift is None:
                shift = x.sum(1) / np.maximum(m.sum(1), 1)
                shift[~np.isfinite(shift)] = 0.0
            x -= shift[:, None]
            x *= m
            both += z @ z.T
            squares += (x * x) @ m.T
        if shift is None:
            return
        i, j = np.triu_indices(p, 1)
        n = both[i, j]
        some = n > 0
        i, j, n = i[some], j[some], n[some]
        sx, sy, sxx, syy = both[p + i, j], both[p + j, i], squares[i, j], squares[j, i]
        yield pa.RecordBatch.from_pandas(pd.DataFrame({
            "i": i.astype(np.int32), "j": j.astype(np.int32), "part": np.full(len(i), TaskContext.get().partitionId() % 256, np.int32),
            "n": n, "mx": shift[i] + sx / n, "my": shift[j] + sy / n, "sxx": sxx, "syy": syy,
            "vx": np.maximum(sxx - sx * sx / n, 0), "vy": np.maximum(syy - sy * sy / n, 0), "c": both[p + i, p + j] - sx * sy / n}), preserve_index=False)
    names = ("n", "mx", "my", "sxx", "syy", "vx", "vy", "c")
    t = d.mapInArrow(gram, "i int, j int, part int, " + ", ".join(f"{c} double" for c in names))

    def join(s, e):
        n = s["n"] + e["n"]
        dx, dy, w = e["mx"] - s["mx"], e["my"] - s["my"], s["n"] * e["n"] / n
        new = {"n": n, "mx": s["mx"] + dx * e["n"] / n, "my": s["my"] + dy * e["n"] / n, "sxx": s["sxx"] + e["sxx"], "syy": s["syy"] + e["syy"],
               "vx": s["vx"] + e["vx"] + dx * dx * w, "vy": s["vy"] + e["vy"] + dy * dy * w, "c": s["c"] + e["c"] + dx * dy * w}
        return F.struct(*[v.alias(k) for k, v in new.items()])
    nothing = F.struct(*[F.lit(0.0).alias(c) for c in names])
    for by in (["i", "j", "part"], ["i", "j"]):         # tasks are many: first those of a part, then the parts
        t = (t.groupBy(*by).agg(F.aggregate(F.array_sort(F.collect_list(F.struct(*names))), nothing, join).alias("s")).select(*by, "s.*"))
    # below this is rounding: the column is constant where both are present
    vx, vy = F.col("vx"), F.col("vy")
    varies = ((vx > 1e-12 * F.col("sxx") + 1e-27 * F.col("n") * F.col("mx") * F.col("mx"))
              & (vy > 1e-12 * F.col("syy") + 1e-27 * F.col("n") * F.col("my") * F.col("my")))
    r = F.when(varies, F.col("c") / F.sqrt(vx * vy))
    pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]
    every = d.sparkSession.createDataFrame(pairs, "i int, j int")       # pairs never present together are in the result too
    t = every.join(t, ["i", "j"], "left")
    named = F.array(*[F.lit(c) for c in cols])
    t = t.select(F.get(named, F.col("i")).alias("a"), F.get(named, F.col("j")).alias("b"), r.alias("r"))
    return t if upper_only else t.unionByName(t.select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def dtype_counts(df: DataFrame) -> list[tuple[str, int]]:
    """Schema metadata: (type name, number of columns)."""
    from collections import Counter
    return sorted(Counter(f.dataType.simpleString() for f in df.schema.fields).items())


def column_split(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, categorical columns) from the schema."""
    from pyspark.sql import types as T
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return num, cat


def width_report(before: DataFrame, after: DataFrame, keys=("SK_ID_CURR", "TARGET")) -> dict:
    """Original / final / new feature counts (schema metadata only)."""
    b = [c for c in before.columns if c not in keys]
    a = [c for c in after.columns if c not in keys]
    return {"original": len(b), "final": len(a), "new": len(set(a) - set(b))}
