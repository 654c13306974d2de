"""Divergence of sources by one-hot level products.

Terms are counted per (language, source) group.  A language keeps the terms
of at least ``least_docs`` documents; of N occurrences of V kept terms in a
group, a term with c of them has the price p = 1 + floor(SCALE (c+1) / (N+V)).
The distance of a group from another distribution q is the sum over terms of
floor((p-q)^2 / q).

Two groups' sum depends only on how many terms have count a in one and count b
in the other.  Blocks of terms are turned into indicator columns, one for each
(group, count level) that occurs in the block, zero included; the product of
their transpose with themselves holds, for every pair of groups, the joint
table of levels (exact: whole numbers far below 2**24 in single precision).
Each cell of it is priced once, in whole numbers.  Terms whose largest counts
are alike share a block, which keeps levels, and so columns, few; columns are
cut into panels, so a product's size does not grow with the number of groups.

What moves: the terms' counts once by (language, term).  One row per group (its
N, V and name) is broadcast: the result itself holds a row for every ordered
pair of groups of a language, so that table is about the root of the result.
Joint tables stay in their task; sums per pair of groups leave it.

Defined results: NULL text, language and source are empty strings; a group
without terms counts 0 of every kept term; a language without kept terms has
distance 0 between its sources and no terms; repeated rows count each; an
empty table gives an empty result.  Whole texts are counted.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

SCALE = 1_000_000_000
#: ASCII letters in lower case and all bytes of other characters; the rest separates
_LETTERS = bytes(c | 0x20 if chr(c).isalpha() and c < 0x80 else c if c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("c", pa.int64()), ("d", pa.int64())])


def _count(most: int = 400_000):
    """Partial counts of a task: occurrences and documents of every term by
    group, given out whenever ``most`` entries have gathered, and one row
    without a term for each group."""
    def run(batches):
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def give():
            for (lang, source), (occ, docs) in seen.items():
                n = len(occ) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n), pa.array([source] * n), pa.array([None, *occ], pa.binary()).cast(pa.string()),
                     pa.array([0, *occ.values()], pa.int64()), pa.array([0, *map(docs.__getitem__, occ)], pa.int64())], schema=_COUNTS)
            seen.clear()
        for b in batches:
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text")):
                occ, docs = seen.setdefault((lang, source), (Counter(), Counter()))
                words = terms_of(text.as_py())
                occ.update(words)
                docs.update(set(words))
            if sum(len(occ) for occ, _ in seen.values()) > most:
                yield from give()
        yield from give()
    return run


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 3) -> tuple[DataFrame, DataFrame]:
    """(lang, term, total, cells of (source, c)) of the kept terms, and per
    group (lang, source, n, n_lang, v)."""
    rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    # dealt once by (lang, term): both groupings below fit that
    part = rows.mapInArrow(_count(), "lang string, source string, term string, c long, d long").repartition("lang", "term")
    cells = part.groupBy("lang", "term", "source").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    # one row per term; its cells are at most as many as the language has sources
    terms = written(cells.groupBy("lang", "term").agg(F.sum("c").alias("total"), F.sum("d").alias("docs"),
                                                      F.collect_list(F.struct("source", "c")).alias("cells"))
                    .filter(F.col("term").isNull() | (F.col("docs") >= least_docs)), "divergence-terms")
    kept = terms.filter("term IS NOT NULL")
    named = terms.filter("term IS NULL").select("lang", F.explode("cells").alias("x")).select("lang", "x.source").distinct()
    sums = (kept.select("lang", F.explode("cells").alias("x")).groupBy("lang", F.col("x.source").alias("source"))
            .agg(F.sum("x.c").alias("n")))
    langs = kept.groupBy("lang").agg(F.sum("total").alias("n_lang"), F.count("*").alias("v"))
    zero = F.lit(0).cast("long")
    groups = (named.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "n_lang", "v")]))
    return kept.select("lang", "term", "total", "cells"), written(groups, "divergence-groups")


def price(count: int, n: int, v: int) -> int:
    return 1 + SCALE * (count + 1) // (n + v)


def _panels(widths: list[int], most: int) -> list[list[int]]:
    """Consecutive groups whose columns together are at most ``most`` (or one group)."""
    out, size = [], 0
    for g, w in enumerate(widths):
        if not out or size + w > most:
            out.append([])
            size = 0
        out[-1].append(g)
        size += w
    return out


def block_values(counts: np.ndarray, n: list[int], v: int, panel: int = 2048) -> np.ndarray:
    """Sums over a block of terms (rows of ``counts``, a column per group) of
    floor((p-q)^2 / q), by group of p (row) and of q (column)."""
    t, s = counts.shape
    level = [np.unique(counts[:, g], return_inverse=True) for g in range(s)]
    out = np.zeros((s, s), np.int64)
    hot = []
    for part in _panels([len(u) for u, _ in level], panel):
        first = np.cumsum([0] + [len(level[g][0]) for g in part])
        x = np.zeros((t, first[-1]), np.float32)
        for k, g in enumerate(part):
            x[np.arange(t), first[k] + level[g][1]] = 1
        group = np.repeat(part, np.diff(first))
        p = np.array([price(int(c), n[g], v) for g in part for c in level[g][0]], np.int64)
        hot.append((x, group, p))
    for x, gx, px in hot:
        for y, gy, py in hot:
            joint = x.T @ y                  # terms by (group, level) and (group, level)
            i, j = np.nonzero(joint)
            d = px[i] - py[j]
            np.add.at(out, (gx[i], gy[j]), joint[i, j].astype(np.int64) * (d * d // py[j]))
    return out


def _pair_values(shared):
    """Sums per ordered pair of groups over the terms of a task."""
    def run(batches):
        acc: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), object)
            cells = b.column("cells")
            size = np.diff(cells.offsets.to_numpy())
            flat = cells.flatten()
            row = np.repeat(np.arange(len(size)), size)
            c = flat.field("c").to_numpy()
            names = flat.field("source").dictionary_encode()
            for lang in dict.fromkeys(langs):
                index, n, v = shared.value[lang]
                at = np.array([index.get(x, -1) for x in names.dictionary.to_pylist()])
                mine = langs[row] == lang
                place = np.full(len(langs), -1)
                rows = np.flatnonzero(langs == lang)
                for lo in range(0, len(rows), 4096):       # a bounded dense table of counts
                    some = rows[lo:lo + 4096]
                    place[:] = -1
                    place[some] = np.arange(len(some))
                    m = mine & (place[row] >= 0)
                    dense = np.zeros((len(some), len(n)), np.int64)
                    dense[place[row[m]], at[names.indices.to_numpy()[m]]] = c[m]
                    bits = np.array([int(x).bit_length() for x in dense.max(axis=1)])
                    for k in np.unique(bits):
                        alike = dense[bits == k]
                        block = max(64, 4096 >> max(int(k) - 2, 0))
                        for a in range(0, len(alike), block):
                            acc[lang] = acc.get(lang, 0) + block_values(alike[a:a + block], n, v)
        for lang, s in acc.items():
            names = list(shared.value[lang][0])
            i, j = np.nonzero(s)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(i), "source": [names[x] for x in i], "item": [names[x] for x in j],
                                              "value": s[i, j]}, schema=_PAIRS)
    return run


_PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def pair_divergence(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every ordered pair of sources of a language."""
    table: dict[str, tuple[dict[str, int], list[int], int]] = {}
    for r in groups.orderBy("lang", "source").toLocalIterator():
        index, n, _ = table.setdefault(r["lang"], ({}, [], r["v"]))
        index[r["source"]] = len(n)
        n.append(r["n"])
    shared = groups.sparkSession.sparkContext.broadcast(table)
    sums = (terms.select("lang", "cells").mapInArrow(_pair_values(shared), "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")))
    a = groups.select("lang", "source")
    pairs = a.join(a.withColumnRenamed("source", "item"), "lang").filter("source <> item")      # the rows of the result
    return pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))


def _price(c: Column | str, n: str) -> str:
    return f"(1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({c} + 1 AS DECIMAL(20,0))) div CAST({n} + v AS DECIMAL(20,0)))"


def term_divergence(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms that a group uses and prices above its language."""
    x = (terms.select("lang", "term", "total", F.explode("cells").alias("x")).select("lang", "term", "total", "x.source", "x.c")
         .filter("c > 0").join(groups, ["lang", "source"]))
    x = x.withColumn("p", F.expr(_price("c", "n"))).withColumn("q", F.expr(_price("total", "n_lang"))).filter("p > q")
    return x.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))


def audit(df: DataFrame, top_terms: int = 200, **kw) -> DataFrame:
    """lang, source, part, item, value, rank: all sources of the language by
    their distance (``pair``) and the ``top_terms`` terms that set a group off
    most from its language (``term``)."""
    terms, groups = term_counts(df, **kw)
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergence(terms, groups).withColumn("rank", F.row_number().over(w))
    # the rank limit is applied in every partition before the shuffle
    top = term_divergence(terms, groups).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_terms)
    return (pairs.withColumn("part", F.lit("pair")).unionByName(top.withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))
