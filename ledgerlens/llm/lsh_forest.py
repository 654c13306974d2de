"""Near-duplicate documents with an LSH forest.

A document's set holds its distinct word shingles as 64-bit hashes.  Equal sets
are one class from then on, whatever their number.  Each class has a minhash
signature of ``trees`` groups of ``depth`` values.  Tree t is the order of all
classes by the values that start at its group (its own and the next group's,
around the end), sorted over the whole cluster by range partitions: id is the
last sort column, so no value, however frequent, fills a task.

1. Neighbours in an order that share at least ``least_depth`` leading values
   are candidates, and the length of that common prefix is the depth at which
   the order separates them: deep where classes are alike, shallow where they
   are sparse.  Each class is first confirmed against the predecessor and the
   successor with which it shares the longest prefix of all trees; neighbours that are still
   in different components follow, one for each class and component.
2. Candidates are confirmed on the full sets; components are labelled.
3. Classes that agree on the first ``least_depth`` values of a tree are a region
   of it; a pair at the threshold t of similarity shares no region with
   probability (1 - t**least_depth)**trees, and ``trees`` is chosen to make that
   less than 0.00001 (16 trees at t = 0.85, 22 at 0.8).  Regions that
   hold more than one component get a hub, the class
   that shares most of its set with others, and its candidates are confirmed.
4. Regions that hold more than one component even then are compared in blocks:
   every pair from different components is met once, in the first tree that
   it shares, and checked there on the full sets unless it cannot reach the
   similarity: two sets meet only in shingles that each shares with others,
   and signatures of similar sets agree.  Only links leave the block, one for
   each document and component.  Nothing is capped: blocks only bound what one
   task holds.

Sets are compared as 64-bit hashes of their shingles.

Defined results: NULL, empty and blank texts have an empty set, no links, and
are their own component; a text of fewer words than a shingle is one shingle;
rows with the same key are one document; a row with a NULL key takes the smallest
key of the rows with an equal set, and if all of these are NULL it has a NULL
component and counts as kept; an empty table gives an empty result.
Only key and text are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written
from ledgerlens.llm.graph import components


class _WordHash(dict):
    def __missing__(self, w):
        import xxhash
        if len(self) > 150_000:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, shingle: int, words_hash: dict) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    words = text.encode().lower().split() if text else []      # bytes: only A-Z are lowered, only ASCII space splits
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words_hash.__getitem__, words), np.uint64, n)
    k = min(n, shingle)
    acc = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        acc = _mix(acc * np.uint64(0xBF58476D1CE4E5B9) + h[i:n - k + 1 + i])
    return np.unique(acc)


def _coefficients(values: int, seed: int = 3) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 32, (values, 1), dtype=np.uint32) | np.uint32(1)


def signature(s: np.ndarray, coef: np.ndarray) -> np.ndarray:
    """Minimum of each multiplicative hash of a set, over cache-sized parts."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(coef), ~np.uint32(0))
    for i in range(0, len(x), 2048):
        np.minimum(out, (x[None, i:i + 2048] * coef).min(axis=1), out=out)
    return out


def signatures(df: DataFrame, key: str, text: str, shingle: int, trees: int, depth: int) -> DataFrame:
    """key, n (set size), digest of the set, signature (big-endian values)."""
    def run(batches):
        cache, coef = _WordHash(), _coefficients(trees * depth)
        for b in batches:
            n, dig, sig = [], [], []
            for t in b["t"]:
                s = shingle_set(t, shingle, cache)
                n.append(len(s))
                dig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig.append(signature(s, coef).astype(">u4").tobytes() if len(s) else b"")
            yield pd.DataFrame({"key": b["key"], "n": n, "digest": dig, "sig": sig})
    kind = df.schema[key].dataType.simpleString()
    return (df.select(F.col(key).alias("key"), F.col(text).alias("t"))
            .mapInPandas(run, f"key {kind}, n long, digest binary, sig binary"))


def _sets(df: DataFrame, key: str, text: str, shingle: int, ids: DataFrame) -> DataFrame:
    """The full sets of the documents in ``ids``."""
    def run(batches):
        cache = _WordHash()
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "s": [shingle_set(t, shingle, cache).view(np.int64) for t in b["t"]]})
    kind = df.schema[key].dataType.simpleString()
    d = df.select(F.col(key).alias("id"), F.col(text).alias("t"))
    return d.join(ids, "id", "left_semi").mapInPandas(run, f"id {kind}, s array<long>")


def _common(least_depth: int):
    """Neighbours (a before b) of the sorted rows of a partition with the number
    of leading values that they share; the partition's first and last row go out
    with its number, as the neighbours of other partitions' rows."""
    def run(batches):
        from pyspark import TaskContext
        part, first, last = TaskContext.get().partitionId(), None, None
        for b in batches:
            if not len(b):
                continue
            first = b.iloc[:1] if last is None else first
            rows = b if last is None else pd.concat([last, b])
            path = np.frombuffer(b"".join(rows["path"]), ">u4").reshape(len(rows), -1)
            tree, ids = rows["tree"].to_numpy(), rows["id"].to_numpy()
            common = np.cumprod(path[1:] == path[:-1], axis=1).sum(axis=1) * (tree[1:] == tree[:-1])
            at = common >= least_depth
            yield pd.DataFrame({"a": ids[:-1][at], "b": ids[1:][at], "common": common[at], "part": -1, "tree": tree[1:][at], "path": b""})
            last = b.iloc[-1:]
        if last is not None:
            for row in (first, last):
                yield pd.DataFrame({"a": row["id"], "b": row["id"], "common": [0], "part": part, "tree": row["tree"], "path": row["path"]})
    return run


def neighbours(order: DataFrame, least_depth: int, values: int) -> DataFrame:
    """(a, b, common): classes that follow each other in a tree's order of
    (tree, path, id) and share at least ``least_depth`` leading values; where
    partitions meet, their outer rows (two a partition) are compared."""
    kind = order.schema["id"].dataType.simpleString()
    rows = (order.repartitionByRange("tree", "path", "id").sortWithinPartitions("tree", "path", "id")
            .mapInPandas(_common(least_depth), f"a {kind}, b {kind}, common int, part int, tree int, path binary"))
    rows = written(rows, "lsh-neighbours")
    w = Window.orderBy("part", "tree", "path", "a")
    ends = (rows.filter("part >= 0").select(F.lag("a").over(w).alias("a"), F.col("a").alias("b"), F.lag("part").over(w).alias("before"),
                                            "part", F.lag("tree").over(w).alias("tree0"), "tree", F.lag("path").over(w).alias("path0"), "path")
            .filter("before < part and tree0 = tree"))
    same = F.filter(F.sequence(F.lit(1), F.lit(values)), lambda k: F.substring("path", F.lit(1), 4 * k) == F.substring("path0", F.lit(1), 4 * k))
    ends = ends.select("a", "b", F.size(same).alias("common")).filter(F.col("common") >= least_depth)
    return rows.filter("part < 0").select("a", "b", "common").unionByName(ends)


def _pairs(one: DataFrame, two: DataFrame) -> DataFrame:
    both = one.select("a", "b").unionByName(two.select("a", "b"))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _longest(near: DataFrame) -> DataFrame:
    """Of each class, the predecessor and the successor of longest common prefix."""
    return _pairs(near.groupBy("b").agg(F.max_by("a", F.struct("common", "a")).alias("a")),
                  near.groupBy("a").agg(F.max_by("b", F.struct("common", "b")).alias("b")))


def _apart(near: DataFrame, labels: DataFrame, tried: DataFrame) -> DataFrame:
    """Neighbours in different components: of each class one per component, of
    longest common prefix; pairs of ``tried`` are not repeated."""
    la, lb = (labels.select(F.col("id").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
    j = (near.join(la, "a", "left").join(lb, "b", "left")
         .withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")}).filter("la <> lb"))
    j = (j.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "common",
                  F.when(F.col("a") < F.col("b"), F.col("lb")).otherwise(F.col("la")).alias("label"))
         .join(tried, ["a", "b"], "left_anti"))
    return j.groupBy("a", "label").agg(F.max_by("b", F.struct("common", "b")).alias("b")).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    one = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(one, "a").join(two, "b").withColumn("i", both)
            .filter(100 * F.col("i") >= percent * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b"))


def _may_reach(n, shared, n2, shared2, percent: int):
    """Whether two sets can reach the similarity: they meet only in shingles
    that each shares with some other document."""
    most = F.least(shared, shared2)
    return 100 * most >= percent * (n + n2 - most)


def _shared(ids: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, n, shared): how many shingles of a set occur in another set of ``ids``."""
    own = sets.join(ids, "id", "left_semi")
    flat = own.select("id", F.explode("s").alias("h"))
    often = flat.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("h")
    kept = flat.join(often, "h", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    return own.select("id", F.size("s").cast("long").alias("n")).join(kept, "id", "left").fillna(0, ["shared"])


def _mixed_regions(members: DataFrame, labels: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Members with their labels, and the regions of more than one label: the
    largest, and in how many blocks its members and the others are cut.  The
    largest needs no comparison within itself: only the others do, with all."""
    mark = members.select("id", "tree", "head").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mark = written(mark, "lsh-marked")
    held = mark.groupBy("tree", "head", "label").count()
    mixed = (held.groupBy("tree", "head")
             .agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.max("count").alias("n_main"),
                  F.sum("count").alias("all"), F.count("*").alias("labels"))
             .filter("labels > 1")
             .select("tree", "head", "main", F.ceil((F.col("all") - F.col("n_main")) / block).cast("int").alias("few"),
                     F.ceil(F.col("n_main") / block).cast("int").alias("many")))
    return mark, written(mixed, "lsh-mixed")


def _cross(depth: int, least_depth: int, least_agree: float, percent: int):
    """Links between different components within the block pairs of regions,
    confirmed on the full sets; one for each document and component.  Rows come
    sorted by block pair; one block pair at a time is held."""
    def links(tree, rows, same):
        left, right = [r for r in rows if r[0] == 0], [r for r in rows if r[0] == 1]
        if same:
            left = right = rows
        if not left or not right:
            return
        sb = np.frombuffer(b"".join(r[3] for r in right), ">u4").reshape(len(right), -1)
        lb, ib, nb, hb = (np.array([r[c] for r in right]) for c in (2, 1, 4, 5))
        for _, i, label, sig, n, shared, own in left:
            most = np.minimum(hb, shared)
            ok = (lb != label) & (100 * most >= percent * (n + nb - most))
            if same:
                ok &= ib > i
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            eq = sb[at] == np.frombuffer(sig, ">u4")
            agree = eq.mean(axis=1)
            ok = agree >= least_agree
            for t in range(tree):       # an earlier tree holds this pair already
                ok &= ~eq[:, t * depth:t * depth + least_depth].all(axis=1)
            met = set()
            for j in at[ok][np.argsort(-agree[ok], kind="stable")]:
                if lb[j] not in met:
                    both = len(np.intersect1d(own, right[j][6], assume_unique=True))
                    if 100 * both >= percent * (n + nb[j] - both):
                        met.add(lb[j])
                        yield (min(i, ib[j]), max(i, ib[j]))

    def run(batches):
        last, rows = None, []
        for b in batches:
            out = []
            for tree, head, i, j, *row in zip(*(b[c] for c in ("tree", "head", "i", "j", "side", "id", "label", "sig", "n", "shared", "s"))):
                if (tree, head, i, j) != last:
                    if rows:
                        out.extend(links(last[0], rows, last[2] == last[3]))
                    last, rows = (tree, head, i, j), []
                rows.append(row)
            yield pd.DataFrame(out, columns=["a", "b"])
        if rows:
            yield pd.DataFrame(list(links(last[0], rows, last[2] == last[3])), columns=["a", "b"])
    return run


def link(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, trees: int | None = None,
         depth: int = 6, least_depth: int = 4, block: int = 400, margin: float = 0.2) -> DataFrame:
    """key, n_shingles, component_id, kept.  ``margin``: signatures that agree
    on a share of less than the similarity minus this are not confirmed (over
    five standard deviations of the estimate)."""
    # as many orders as make a missed pair at the threshold rarer than one in a hundred thousand
    trees = trees or math.ceil(math.log(1e-5) / math.log(1 - (percent / 100) ** least_depth))
    sig = written(signatures(df, key, text, shingle, trees, depth), "lsh-signatures")
    full = sig.filter("n > 0")
    classes = written(full.groupBy("digest").agg(F.min("key").alias("id"), F.first("sig").alias("sig")), "lsh-classes")
    values = min(2 * depth, trees * depth)
    order = (classes.filter("id is not null")
             .select("id", F.concat("sig", "sig").alias("sig"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
             .select("id", "tree", F.substring("sig", F.col("tree") * (4 * depth) + 1, F.lit(4 * values)).alias("path")))
    near = neighbours(order, least_depth, values)
    # a region has two members or more exactly where neighbours share its prefix
    ids = written(near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct(), "lsh-ids")
    sets = written(_sets(df, key, text, shingle, ids).dropDuplicates(["id"]), "lsh-sets")
    pairs = written(_longest(near), "lsh-pairs")
    links = written(_confirmed(pairs, sets, percent), "lsh-links")
    labels = components(links)
    more = written(_confirmed(_apart(near, labels, pairs), sets, percent), "lsh-links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)

    members = written(order.join(ids, "id", "left_semi")
                      .select("id", "tree", F.substring("path", F.lit(1), F.lit(4 * least_depth)).alias("head")), "lsh-members")
    mark, mixed = _mixed_regions(members, labels, block)
    shared = written(_shared(mark.join(mixed, ["tree", "head"], "left_semi").select("id").distinct(), sets), "lsh-shared")

    # the class that shares most of its set with others is the region's hub
    at = mark.join(mixed, ["tree", "head"]).join(shared, "id")
    hubs = written(at.groupBy("tree", "head").agg(F.max_by(F.struct("id", "label", "n", "shared"), F.struct(F.col("shared") / F.col("n"), "id")).alias("hub")),
                   "lsh-hubs")
    j = at.join(hubs, ["tree", "head"]).filter(F.col("label") != F.col("hub.label"))
    second = (j.filter(_may_reach(F.col("n"), F.col("shared"), F.col("hub.n"), F.col("hub.shared"), percent))
              .select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct())
    more = written(_confirmed(second, sets, percent), "lsh-links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)
        mark, mixed = _mixed_regions(members, labels, block)

    # regions that still have more than one component: every pair across components, by blocks
    is_main = F.col("label") == F.col("main")
    part = F.xxhash64("id")
    able = shared.filter(100 * F.col("shared") >= percent * F.col("n"))       # others cannot reach the similarity with any
    rest = (mark.join(mixed, ["tree", "head"]).join(able, "id").join(classes.select("id", "sig"), "id").join(sets, "id")
            .withColumn("own", F.when(is_main, F.col("few") + F.pmod(part, F.col("many"))).otherwise(F.pmod(part, F.col("few"))).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(is_main, F.col("few") - 1)
                                                      .otherwise(F.col("few") + F.col("many") - 1))))
            .select("tree", "head", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "label", "sig",
                    "n", "shared", "s", (F.col("own") > F.col("other")).cast("int").alias("side")))
    kind = df.schema[key].dataType.simpleString()
    late = (rest.repartition("tree", "head", "i", "j").sortWithinPartitions("tree", "head", "i", "j")
            .mapInPandas(_cross(depth, least_depth, percent / 100 - margin, percent), f"a {kind}, b {kind}").distinct())
    more = written(late, "lsh-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = written(classes.select("digest", "id").join(labels, "id", "left")
                    .select("digest", F.coalesce("label", "id").alias("component_id")), "lsh-named")
    out = full.select("key", "n", "digest").join(named, "digest").select("key", "n", "component_id")
    out = out.unionByName(sig.filter("n = 0").select("key", "n", F.col("key").alias("component_id")))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id",
                      F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", **kw) -> DataFrame:
    """One document of each group stays (the smallest key), with the columns of
    ``df``.  Rows of one key, NULL included, stay or go together: they stay if
    any of them is kept."""
    keep = link(df, key=key, **kw).filter("kept").select(F.col(key).alias("__lsh_key")).distinct()
    return df.join(keep, df[key].eqNullSafe(keep["__lsh_key"]), "left_semi")
