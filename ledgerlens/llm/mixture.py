"""Mixing sources to target weights by capped water-filling.

Targets: every source gets its share of the budget by weight; a source above
its cap (``max_epochs`` times its size) is clamped and the excess is reshared
by weight among the others, until none is above.  Only sums per source go to
the driver's arithmetic, one scalar row per round.

Taking: a source whose target is f times its size gets floor(f) whole copies
of every document, and the fraction by a seeded order (md5 of seed and id):
documents are taken whole along that order until the rest of the target is
used up; the one document that crosses the line gives only its first words.
The order is cut into md5 buckets; only bucket sums are accumulated, and rows
are ranked inside the one bucket per source that holds the line, so no source
meets in one task.

Defined results: NULL text has size 0 and takes 0; a NULL source is a source
of its own, last in order; a source of size 0 has target 0; repeated ids are
ordered by size as a second key; an empty table gives an empty table.  Rows
are carried under prefixed names, so clashing columns are safe.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import words_of, written

#: weights by rank of the source, repeating
WEIGHTS = (5, 2, 1)


def _weighted(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Weight by rank in code point order, NULL last.  One row per source: the
    rank window runs over the table of sources, not over documents."""
    rank = F.row_number().over(Window.orderBy(F.col("__mx_source").isNull(), F.col("__mx_source"))) - 1
    arr = F.array(*[F.lit(int(x)).cast("long") for x in weights])
    return sources.withColumn("weight", F.get(arr, (rank % len(weights)).cast("int")))


def targets(sources: DataFrame, share_pct: int = 150, max_epochs: int = 2, weights=WEIGHTS) -> DataFrame:
    """``sources`` (__mx_source, source_size) plus weight and target.

    Exact integers until the one division: a free source's target is
    weight * (share*S - 100*capped) / (100 * free weights).
    """
    s = written(_weighted(sources, weights), "mix-sources")
    total = s.agg(F.sum("source_size").alias("s")).collect()[0]["s"] or 0
    capped_words, free_w, n_capped = 0, None, -1
    level = F.lit(False)        # nothing clamped yet
    while True:
        r = s.agg(F.sum(F.when(~level, F.col("weight"))).alias("w"),
                  F.sum(F.when(level, max_epochs * F.col("source_size"))).alias("c"),
                  F.sum(level.cast("long")).alias("n")).collect()[0]
        if (r["n"] or 0) == n_capped:
            break
        n_capped, capped_words, free_w = r["n"] or 0, r["c"] or 0, r["w"]
        if not free_w:
            break
        num, den = share_pct * total - 100 * capped_words, 100 * free_w
        # the integers are compared as decimals: nothing rounds, nothing overflows
        level = level | ((F.col("weight").cast("decimal(18,0)") * F.lit(num).cast("decimal(20,0)"))
                         > (F.col("source_size").cast("decimal(18,0)") * F.lit(max_epochs * den).cast("decimal(20,0)")))
    num, den = share_pct * total - 100 * capped_words, 100 * (free_w or 1)
    free = (F.col("weight") * F.lit(num).cast("decimal(20,0)")).cast("double") / F.lit(float(den))
    return s.withColumn("target", F.when(level, (max_epochs * F.col("source_size")).cast("double")).otherwise(free))


def _rows(df: DataFrame, key: str, source: str, size: Column | None, text: str, seed: str, carry: bool) -> DataFrame:
    size = F.size(words_of(F.col(text))).cast("long") if size is None else size
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__mx_row")] if carry else []
    return df.select(F.col(key).alias("__mx_key"), F.col(source).cast("string").alias("__mx_source"), size.alias("size"),
                     F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("__mx_h"), *row)


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", size: Column | None = None, text: str = "text",
        seed: str = "mix", share_pct: int = 150, max_epochs: int = 2, weights=WEIGHTS, rows_per_bucket: int = 20_000,
        carry: bool = False) -> DataFrame:
    """key, __mx_source, size, source_size, target, taken for every row; with
    ``carry`` also the row itself as the struct ``__mx_row``."""
    d = _rows(df, key, source, size, text, seed, carry)
    if not carry:
        d = written(d, "mix-docs")      # narrow: texts are split into words once
    n = df.count()
    digits = 1
    while 16 ** digits * rows_per_bucket < n:
        digits += 1
    digits += 1                   # buckets well below one task's share
    d = d.withColumn("__mx_b", F.substring("__mx_h", 1, digits))
    by_bucket = d.groupBy("__mx_source", "__mx_b").agg(F.sum("size").alias("b_size"))
    by_bucket = written(by_bucket, "mix-buckets")
    t = targets(by_bucket.groupBy("__mx_source").agg(F.sum("b_size").alias("source_size")), share_pct, max_epochs, weights)
    # words before each bucket: 16**digits rows per source at most
    w = Window.partitionBy("__mx_source").orderBy("__mx_b").rowsBetween(Window.unboundedPreceding, -1)
    line = (by_bucket.withColumn("before", F.coalesce(F.sum("b_size").over(w), F.lit(0)))
            .alias("b").join(t.alias("t"), F.col("b.__mx_source").eqNullSafe(F.col("t.__mx_source")))
            .select("b.__mx_source", "__mx_b", "b_size", "before", "source_size", "target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    line = (line.withColumn("epochs", epochs)
            .withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
                        - F.col("before")))
    line = written(line.withColumn("crossed", (F.col("rest") > 0) & (F.col("rest") < F.col("b_size"))), "mix-line")
    row = ["__mx_row"] if carry else []
    # source and bucket together are the key of the join: a large source is spread over its buckets
    j = (d.alias("d").join(line.alias("l"), F.col("d.__mx_source").eqNullSafe(F.col("l.__mx_source"))
                           & (F.col("d.__mx_b") == F.col("l.__mx_b")))
         .select("d.__mx_key", "d.__mx_source", "size", "__mx_h", "d.__mx_b", "source_size", "target", "epochs", "rest",
                 "crossed", *row))
    plain = j.filter(~F.col("crossed")).withColumn("part", F.when(F.col("rest") > 0, F.col("size")).otherwise(0))
    inner = (Window.partitionBy("__mx_source", "__mx_b").orderBy("__mx_h", "__mx_key", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    cut = (j.filter("crossed").withColumn("left", F.col("rest") - F.coalesce(F.sum("size").over(inner), F.lit(0)))
           .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left")))).drop("left"))
    both = plain.unionByName(cut)
    return both.select(F.col("__mx_key").alias(key), "__mx_source", "size", "source_size", "target",
                       (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"), *row)


def apply_mix(df: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The mixed table itself, with the columns of ``df``: whole copies of a row
    as repeated rows, a part as the text's first words joined by single spaces.
    Rows of no word are kept once."""
    m = mix(df, key=key, text=text, carry=True, **kw).select("__mx_row", "size", "taken")
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    copies = F.concat(F.array_repeat(F.lit(-1), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    m = m.withColumn("__mx_copy", F.explode(copies))
    own = F.col("__mx_row").getField(text)
    cut = F.when(F.col("__mx_copy") < 0, own).otherwise(F.array_join(F.slice(words_of(own), 1, F.greatest(F.col("__mx_copy"), F.lit(0))), " "))
    return m.select(*[cut.alias(c) if c == text else F.col("__mx_row").getField(c).alias(c) for c in df.columns])
