"""As-of join, sessions and range frames per key, where a hot key is split by time.

A window over a whole key runs in one task, however long its history. Here the
time line is cut into cells of a fixed width, windows run over (key, cell), and
what crosses a cell's edge is carried by a table of one row per (key, cell):
the last matched row, the last time, or the number of sessions before. So the
largest task holds the rows of one key in one cell; ``width`` sets it. Times
are numbers (days, seconds, microseconds), whole or not.

Defined results: rows of the left side and of ``range_frame`` are all kept; a
NULL key or time matches nothing and has a NULL result. Rows with a NULL key or
time belong to no session. Equal times are ordered by the given tiebreak.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.prefix import prefix_before


def _cell(time: str, width: float) -> Column:
    return F.floor(F.col(time) / F.lit(width))


def asof_join(left: DataFrame, right: DataFrame, by: str, time: str, take: Sequence[str], width: float,
              tiebreak: str, within: float | None = None) -> DataFrame:
    """``left`` with the columns ``take`` of the latest row of ``right`` of the
    same key that is not later (``within``: nor older than that); of equal
    times the row of the largest ``tiebreak``."""
    found = F.struct(F.col(time).alias("t"), F.col(tiebreak).alias("k"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(take)])
    r = right.filter(F.col(by).isNotNull() & F.col(time).isNotNull()).select(F.col(by).alias("_by"), F.col(time).alias("_t"), found.alias("_r"))
    known = F.col(by).isNotNull() & F.col(time).isNotNull()
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    lone = left.filter(~known).select(row.alias("_l"), F.lit(None).cast(r.schema["_r"].dataType).alias("_m"))
    both = (left.filter(known).select(F.col(by).alias("_by"), F.col(time).alias("_t"), row.alias("_l"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"))
            .unionByName(r.withColumn("_l", F.lit(None).cast(lone.schema["_l"].dataType))).withColumn("_cell", _cell("_t", width)))
    # one row per (key, cell): the last match in it, carried on to later cells
    cells = both.groupBy("_by", "_cell").agg(F.max("_r").alias("_last"))
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy("_by").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("_by", "_cell", before.alias("_carried"))
    order = Window.partitionBy("_by", "_cell").orderBy(F.col("_t"), F.col("_l").isNotNull(), F.col("_r.k")).rowsBetween(Window.unboundedPreceding, 0)
    m = both.withColumn("_in", F.last("_r", ignorenulls=True).over(order)).filter(F.col("_l").isNotNull())
    m = m.join(cells, ["_by", "_cell"]).withColumn("_m", F.coalesce("_in", "_carried"))
    if within is not None:
        m = m.withColumn("_m", F.when(F.col("_t") - F.col("_m.t") <= F.lit(within), F.col("_m")))
    m = m.select("_l", "_m").unionByName(lone)
    return m.select("_l.*", *[F.col(f"_m.v{i}").alias(c if c not in left.columns else f"right_{c}") for i, c in enumerate(take)])


def with_session(df: DataFrame, by: str, time: str, gap: float, width: float, tiebreak: str, out: str = "session") -> DataFrame:
    """Numbers the sessions of a key from 1: a row begins one if the row before it is more than ``gap`` earlier."""
    d = df.filter(F.col(by).isNotNull() & F.col(time).isNotNull()).withColumn("_cell", _cell(time, width))
    last = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    edges = (d.groupBy(by, "_cell").agg(F.max(time).alias("_max")).select(by, "_cell", F.max("_max").over(last).alias("_edge")))
    inner = Window.partitionBy(by, "_cell").orderBy(time, tiebreak)
    d = d.join(edges, [by, "_cell"]).withColumn("_prev", F.coalesce(F.lag(time).over(inner), F.col("_edge")))
    d = d.withColumn("_new", F.when(F.col("_prev").isNull() | (F.col(time) - F.col("_prev") > F.lit(gap)), 1).otherwise(0))
    d = prefix_before(d, [by], [F.col(time), F.col(tiebreak)], F.col("_cell"), {"_before": F.col("_new")})
    return d.withColumn(out, (F.col("_before") + F.col("_new")).cast("long")).drop("_cell", "_edge", "_prev", "_new", "_before")


def session_summary(df: DataFrame, by: str, time: str, gap: float, width: float, tiebreak: str, measures: Mapping[str, Column]) -> DataFrame:
    """One row per session: key, session, first and last time, rows and the given
    aggregates (partial sums before the shuffle, so a long session is no single task's work)."""
    s = with_session(df, by, time, gap, width, tiebreak)
    return s.groupBy(by, "session").agg(F.min(time).alias("session_start"), F.max(time).alias("session_end"),
                                        F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in measures.items()])


def range_frame(df: DataFrame, by: str, time: str, span: float, measures: Mapping[str, Column]) -> DataFrame:
    """Aggregates of a key's rows from ``span`` before a row to its own time,
    both included. Cells are as wide as the frame, so every row goes to its own
    cell and the next, and no other: twice the rows, whatever the history."""
    known = F.col(by).isNotNull() & F.col(time).isNotNull()
    d = df.filter(known).withColumn("_cell", _cell(time, span))
    d = d.withColumn("_at", F.explode(F.array(F.col("_cell"), F.col("_cell") + 1)))
    w = Window.partitionBy(by, "_at").orderBy(time).rangeBetween(-span, Window.currentRow)
    d = d.select(*df.columns, "_cell", "_at", *[c.over(w).alias(n) for n, c in measures.items()])
    d = d.filter(F.col("_at") == F.col("_cell")).drop("_cell", "_at")
    return d.unionByName(df.filter(~known), allowMissingColumns=True)
