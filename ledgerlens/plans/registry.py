"""Query registry shared by the Spark catalogue and the DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ROUNDED: dict[str, tuple] = {}     # floating columns of an oracle's result


def query(name: str):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Result types: integers and booleans -> bigint, decimals and floats ->
    double. Values keep their full precision.

    Built as one ``selectExpr`` so that a wide result costs one call into the
    JVM, not several per column."""
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            e = f"CAST({q} AS DOUBLE)"
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            e = f"CAST({q} AS BIGINT)"
        else:
            e = q
        exprs.append(f"{e} AS {q}")
    return df.selectExpr(*exprs)


# ---- the driver's boundary --------------------------------------------------------------------------------------
# Two engines add floating numbers in different orders, so results are compared
# after both sides pass through the same rounding: to single precision (relative
# to the magnitude), and below that to a grid that hides what is left of a
# cancellation. Averages of cents often lie half-way on a decimal grid; the
# shift keeps them off the threshold. Only the entry module and the verifier
# apply this; catalogue queries return full precision.
GRID, SHIFT = 1e8, 0.0463


def boundary(df: DataFrame, name: str) -> DataFrame:
    """The result of a query with the floating columns that its oracle names
    rounded for comparison."""
    out = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if f.name in ROUNDED.get(name, ()) and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(f"CAST(CAST(rint({q} * {GRID:.1f}D - {SHIFT}D) / {GRID:.1f}D AS FLOAT) AS DOUBLE) AS {q}")
        else:
            out.append(q)
    return df.selectExpr(*out)


def boundary_sql(name: str) -> str:
    """The oracle of a query with the same rounding."""
    cols = ROUNDED.get(name)
    if not cols:
        return ORACLE[name]
    rep = ", ".join(f"CAST(CAST(floor({c} * {GRID:.1f}::DOUBLE - {SHIFT}::DOUBLE + 0.5::DOUBLE) / {GRID:.1f}::DOUBLE AS FLOAT) AS DOUBLE) AS {c}"
                    for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{ORACLE[name]}\n) AS _r"
