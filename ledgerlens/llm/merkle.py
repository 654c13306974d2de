"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf, the hash of its fields.  The leaves of a source in
ascending key order form a tree: runs of ``FANOUT`` consecutive nodes become
the hash of their digests until one is left; the sources' roots form a tree
of the same kind, whose root stands for the dataset.

A pivot does ``step`` levels in one shuffle: conditional aggregates spread the
``FANOUT ** step`` nodes below a common ancestor into slot columns.  Digests
of the inner nodes are hashes of concatenated columns; the siblings of a node
are the columns of its run without its own.  The way down starts at the root:
a pivot row, with the path above it, is exploded back into its slots, each
with its siblings in front of that path.  So the leaves' proofs come out of
the first pivot and the leaves are shuffled twice in all.

Leaves are numbered without a task per source: they are range-partitioned by
source, key and leaf, and the counts of each (source, partition) give the
offsets.  Identical rows are spread over partitions like any others.

Defined results: NULL fields hash as ``-``, so an empty text and a NULL text
differ; a NULL source is a source of its own and comes first, NULL keys come
first in their source; rows that share a key are leaves of their own, ordered
by their hash; a source of one row is its own root; an empty table gives an
empty manifest.  Only the columns that are named are read, so others may have
any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

FANOUT = 3
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for NULL, else the byte count, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def proof_hash(proof: Column) -> Column:
    """Hash of a proof's siblings from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def _placed(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows in range partitions of ``order`` (NULL first), written, with their
    place ``__at`` (partition and position in it).  Rows alike in all of it are
    told apart by where they were read, so that they are spread too."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = df.withColumn("__tie", F.monotonically_increasing_id())
    d = (d.repartitionByRange(parts, *keys, F.col("__tie")).sortWithinPartitions(*keys, "__tie").drop("__tie")
         .withColumn("__at", F.monotonically_increasing_id()))
    return written(d.withColumn("__part", F.shiftright("__at", 33)), name)


def _spans(placed: DataFrame, tree: str, name: str) -> DataFrame:
    """Per (tree, partition): the number of the tree's rows before it less the
    place of its first row, and n, the tree's rows.  As many rows as there are
    partitions and trees together."""
    s = placed.groupBy(tree, "__part").agg(F.count("*").alias("c"), F.min("__at").alias("first"))
    w = Window.partitionBy(tree)
    before = F.coalesce(F.sum("c").over(w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return written(s.select(tree, "__part", (before - F.col("first")).alias("shift"), F.sum("c").over(w).alias("n")), name)


def _depth(n: Column, most: int) -> Column:
    """Levels above the leaves of a tree of n (at most ``most``) leaves."""
    steps, size = [F.lit(0)], 1
    while size < most:
        steps.append((n > size).cast("int"))
        size *= FANOUT
    return reduce(lambda a, b: a + b, steps)


def _levels(most: int) -> int:
    k, size = 0, 1
    while size < most:
        k, size = k + 1, size * FANOUT
    return k


def _pivot(nodes: DataFrame, level: int, step: int) -> DataFrame:
    """(tree, depth, g, slots, l1 .., top): slot columns of ``FANOUT ** step``
    neighbours, the digests of each level above them, and the tree's root
    where it lies within these levels."""
    width = FANOUT ** step
    node = F.struct("h", "x")
    slots = [f"__c{k}" for k in range(width)]
    w = (nodes.groupBy("tree", "depth", F.expr(f"i div {width}").alias("g"))
         .agg(*[F.max(F.when(F.col("i") % width == k, node)).alias(c) for k, c in enumerate(slots)]))
    below, names = [F.col(c)["h"] for c in slots], []
    for s in range(step):
        cols = []
        for k in range(len(below) // FANOUT):
            run = below[FANOUT * k:FANOUT * (k + 1)]
            cols.append(F.when((F.col("depth") > level + s) & run[0].isNotNull(), F.sha2(F.concat_ws("", *run), 256)).alias(f"__l{s}_{k}"))
        w = w.select("*", *cols)
        names.append([f"__l{s}_{k}" for k in range(len(cols))])
        below = [F.col(c) for c in names[-1]]
    top = F.coalesce(*[F.when(F.col("depth") == level + s + 1, F.col(names[s][0])) for s in range(step)])
    return w.select("tree", "depth", "g", F.array(*slots).alias("slots"),
                    *[F.array(*names[s]).alias(f"l{s + 1}") for s in range(step)], top.alias("top"))


def _climb(nodes: DataFrame, most: int, step: int, name: str) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """The pivots of ``nodes`` (tree, depth, i, h, x), and (tree, top): the root of each tree."""
    pivots, level = [], 0
    tops = nodes.filter("depth = 0").select("tree", F.col("h").alias("top"))
    while level < _levels(most):
        wide = written(_pivot(nodes.filter(F.col("depth") > level), level, step), f"{name}-{level}")
        pivots.append((level, wide))
        tops = tops.unionByName(wide.filter(F.col("depth") <= level + step).select("tree", "top"))
        nodes = (wide.filter(F.col("depth") > level + step)
                 .select("tree", "depth", F.col("g").alias("i"), F.element_at(f"l{step}", 1).alias("h"), F.lit(None).cast("int").alias("x")))
        level += step
    return pivots, tops


def _descend(nodes: DataFrame, pivots, paths: DataFrame, step: int, name: str) -> DataFrame:
    """h and x of every node with its path and what else ``paths`` (tree, path,
    ...), the paths above the trees' roots, carries."""
    width = FANOUT ** step
    more = [c for c in paths.columns if c not in ("tree", "path")]
    carried = None
    for level, wide in reversed(pivots):
        rows = wide.filter(F.col("depth") <= level + step).join(paths, "tree")
        if carried is not None:
            inner = wide.filter(F.col("depth") > level + step).alias("w").join(
                carried.alias("c"), (F.col("w.tree") == F.col("c.tree")) & (F.col("w.g") == F.col("c.i")))
            rows = rows.unionByName(inner.select(*[f"w.{c}" for c in wide.columns], "c.path", *[f"c.{m}" for m in more]))
        t = rows.withColumn("l0", F.transform("slots", lambda s: s["h"])).select(
            "tree", "depth", "g", *[f"l{s}" for s in range(step)], "path", *more, F.posexplode("slots").alias("t", "node"))
        t = t.filter(F.col("node").isNotNull())
        parts = []
        for s in range(step):
            at = F.expr(f"t div {FANOUT ** s}")
            own = at % FANOUT
            run = at - own
            sib = F.struct(F.array_join(F.slice(f"l{s}", run + 1, own), "").alias("left"),
                           F.array_join(F.slice(f"l{s}", at + 2, FANOUT - 1 - own), "").alias("right"))
            parts.append(F.when(F.col("depth") > level + s, F.array(sib)).otherwise(F.array().cast(PATH)))
        path = F.concat(*parts, F.col("path"))
        if level:
            carried = written(t.select("tree", (F.col("g") * width + F.col("t")).alias("i"), path.alias("path"), *more), f"{name}-{level}")
        else:
            carried = t.select(F.col("node")["h"].alias("h"), F.col("node")["x"].alias("x"), path.alias("path"), *more)
    lone = nodes.filter("depth = 0").join(paths, "tree").select("h", "x", "path", *more)
    return lone if carried is None else lone.unionByName(carried)


def manifest(df: DataFrame, fields: Sequence[str], key: str = "doc_id", source: str = "source",
             carry: Mapping[str, Column] | None = None, step: int = 3) -> DataFrame:
    """key, leaf, subroot, root, proof (siblings left and right of the path,
    from the leaf to the root) and the ``carry`` columns of every row; a leaf
    is the hash of ``fields``.  ``step`` levels are done in one shuffle."""
    carry = dict(carry or {})
    d = df.select(F.col(source).cast("string").alias("source"), F.col(key).alias("key"),
                  leaf_hash([F.col(c) for c in fields]).alias("leaf"), F.struct(*[c.alias(n) for n, c in carry.items()]).alias("carry")
                  if carry else F.lit(None).cast("int").alias("carry"))
    placed = _placed(d, ["source", "key", "leaf"], "merkle-leaves")
    spans = _spans(placed, "source", "merkle-spans")
    size = spans.agg(F.max("n").alias("most"), F.count("*").alias("spans")).first()     # two numbers
    most = size["most"] or 1

    # the sources in order: their own numbering, from the spans
    names = _placed(spans.groupBy("source").agg(F.max("n").alias("n")).withColumn("all", F.lit(0)), ["all", "source"], "merkle-sources")
    sources = names.join(_spans(names, "all", "merkle-source-spans").withColumnRenamed("n", "n_sources"), ["all", "__part"]).select(
        "source", (F.col("__at") + F.col("shift")).alias("tree"), "n_sources")
    sources = written(sources, "merkle-trees")
    spans = written(spans.alias("s").join(sources.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
                    .select("s.source", "s.__part", "shift", "n", "tree"), "merkle-places")
    nodes = (placed.alias("p").join(spans.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.__part") == F.col("s.__part")))
             .select("tree", _depth(F.col("n"), most).alias("depth"), (F.col("__at") + F.col("shift")).alias("i"), F.col("leaf").alias("h"),
                     F.struct("key", "carry").alias("x")))
    pivots, tops = _climb(nodes, most, step, "merkle-up")
    tops = written(tops, "merkle-subroots")

    n_sources = sources.count()
    above = (tops.join(sources, "tree").select(
        F.lit(0).cast("long").alias("tree"), _depth(F.col("n_sources"), max(n_sources, 1)).alias("depth"), F.col("tree").alias("i"),
        F.col("top").alias("h"), F.col("tree").alias("x")))
    over, root = _climb(above, max(n_sources, 1), step, "merkle-top")
    start = root.select("tree", F.array().cast(PATH).alias("path"), F.col("top").alias("root"))
    paths = _descend(above, over, start, step, "merkle-top-down").select(
        F.col("x").alias("tree"), "path", F.col("h").alias("subroot"), "root")
    out = _descend(nodes, pivots, written(paths, "merkle-paths"), step, "merkle-down")
    return out.select(F.col("x.key").alias("key"), F.col("h").alias("leaf"), "subroot", "root", F.col("path").alias("proof"),
                      *[F.col(f"x.carry.{n}").alias(n) for n in carry])
