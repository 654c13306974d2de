"""Fit/transform preparation: median imputation (global or per group),
constant fills, missing indicators, label encoding, train/test splits.

``fit_*`` returns a small statistics DataFrame (one row per feature, or per
group x feature); ``apply_*`` joins it back. Statistics are computed with the
exact-but-scalable percentile of ``profile.exact_percentiles``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import flag
from ledgerlens.operators.joins import check_parity
from ledgerlens.operators.profile import exact_percentiles, unpivot


#: ranges that number a vocabulary
VOCABULARY_SPLITS = 200


def hash_split(id_col: str, test_below: str = "4", out: str = "is_test") -> Column:
    """Deterministic split on the first md5 hex digit of the id (no row is dropped)."""
    return (F.substring(F.md5(F.col(id_col).cast("string")), 1, 1) < F.lit(test_below)).cast("int").alias(out)


def fit_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long statistics ``(*by, feature, median)``."""
    by = list(by)
    long = unpivot(df, by, cols)
    med = exact_percentiles(long, "value", [0.5], by + ["feature"])
    return med.select(*by, "feature", F.col("value").alias("median"))


def apply_medians(df: DataFrame, stats: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                  suffix: str = "") -> DataFrame:
    """coalesce(col, fitted median). Without ``by`` the statistics are one row
    (bounded: one value per column) and are broadcast."""
    by = list(by)
    keys = by or ["_g"]
    wide = stats.groupBy(*by).agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_med_{c}")
                                    for c in cols]) if by else \
        stats.withColumn("_g", F.lit(0)).groupBy("_g").agg(
            *[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_med_{c}") for c in cols])
    d = df if by else df.withColumn("_g", F.lit(0))
    d = d.join(F.broadcast(wide) if not by else wide, keys, "left")
    for c in cols:
        d = d.withColumn(f"{c}{suffix}", F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")))
    return d.drop(*[f"_med_{c}" for c in cols], *(["_g"] if not by else []))


def impute_finite(df: DataFrame, fit_on: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Two passes: NULLs take the median of ``fit_on``; then infinities become
    NULL and take the median of ``fit_on`` after its own first pass."""
    from ledgerlens.functions.exprs import inf_to_null
    check_parity(fit_on, df, cols)

    def cleaned(d, stats):
        return apply_medians(d, stats, cols).withColumns({c: inf_to_null(c) for c in cols})
    first = fit_medians(fit_on, cols)
    second = fit_medians(cleaned(fit_on, first), cols)
    return apply_medians(cleaned(df, first), second, cols)


def missing_indicators(df: DataFrame, cols: Sequence[str], suffix: str = "_MISSING") -> DataFrame:
    """Always emitted (schema independent of the data)."""
    return df.withColumns({f"{c}{suffix}": flag(F.col(c).isNull()) for c in cols})


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def fit_labels(frames: Sequence[DataFrame], col: str, missing: str = "missing") -> DataFrame:
    """Vocabulary ``(value, code)`` over the union of frames; NULL -> ``missing``;
    codes follow sorted (binary) order.

    The numbering is a two-level prefix over the distinct values. Its buckets
    are ranges between values of a bounded sample, so values with a long common
    prefix spread like any others; the sample only steers the balance."""
    from ledgerlens.operators.prefix import prefix_before
    vals = None
    for f in frames:
        check_parity(frames[0], f, [col])
        v = f.select(F.coalesce(F.col(col).cast("string"), F.lit(missing)).alias("value"))
        vals = v if vals is None else vals.unionByName(v)
    vocab = vals.distinct()
    some = vocab.orderBy(F.xxhash64("value"), "value").limit(VOCABULARY_SPLITS)
    splits = some.agg(F.sort_array(F.collect_list("value")).alias("_splits"))          # one row, bounded
    d = vocab.crossJoin(F.broadcast(splits))
    d = d.withColumn("_range", F.size(F.filter("_splits", lambda x: x <= F.col("value")))).drop("_splits")
    coded = prefix_before(d, [], [F.col("value")], F.col("_range"), {"code": F.lit(1)})
    return coded.select("value", F.col("code").cast("long").alias("code"))


def apply_labels(df: DataFrame, vocab: DataFrame, col: str, out: str | None = None,
                 missing: str = "missing") -> DataFrame:
    out = out or f"{col}_code"
    d = df.withColumn("_lv", F.coalesce(F.col(col).cast("string"), F.lit(missing)))
    return d.join(vocab.select(F.col("value").alias("_lv"), F.col("code").alias(out)), "_lv", "left").drop("_lv")
