"""Repeated passages by a distributed difference-cover suffix sort.

A byte is removed if it lies in a string of ``length`` bytes that also starts
anywhere else, in the same document or another.  A start is the first byte of
such a string; "repeated" is decided for every start of every text.

Distribution.  The starts of a text are dealt to anchors: the anchor of a
start is the place, among its string's grams of half the length, where the
gram's hash is least.  It depends on the string alone, so equal strings have
anchors at the same place in them, with equal grams: strings of different
grams never need to meet, and all starts of an anchor lie in one run of text,
its context.

1. Grams that are the anchor of one context only are done: nothing in it is
   repeated.  Where all contexts of a gram are the same, all of it is.
2. What is left, one copy of each different context, is dealt out by gram and
   sorted by the difference cover {1, 2} modulo 3: triples at the sampled
   positions are sorted and named, the algorithm recurses on the string of
   names until names are unique or span ``length`` bytes, the remaining
   suffixes are merged in through the sampled ones, and adjacent suffixes are
   compared over their first ``length`` bytes.  Grams with more contexts than
   a task should hold are dealt out once more, by their strings themselves.
3. Repeated starts become intervals, and each text is cut once.

A Bloom filter of the repeated grams (``bloom_bytes`` bounds it) only thins
out what is joined with them; with more grams it thins less, nothing is lost.
Contexts are told apart by 64-bit hashes; strings are compared as bytes.
Texts are read whole, in overlapping pieces if very long.

Defined results: NULL and empty texts have no bytes and lose none; texts
shorter than ``length`` lose none; rows that share a key are separate
documents; an empty table gives an empty result.  Only key and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

PIECE = 1 << 22
SALTS = 16
_LOW = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_NO = np.empty(0, np.int64)


# ---- anchors --------------------------------------------------------------------------------------------------------

class Anchors:
    """Rolling hashes with tables grown to the longest text seen."""

    def __init__(self, length: int):
        self.length, self.gram = length, length // 2
        self.table = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            inverse = pow(_BASE, -1, 1 << 64)
            self.up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]))
            self.down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]))

    @staticmethod
    def _mix(x):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def of(self, raw: bytes):
        """at, first, last (start positions dealt to the anchor), gram hash and
        context hash of every anchor."""
        a = np.frombuffer(raw, np.uint8)
        n, g, w = len(a), self.gram, self.length - self.gram + 1
        if n < self.length:
            return _NO, _NO, _NO, np.empty(0, np.uint64), np.empty(0, np.uint64)
        self._grow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[a] * self.up[:n], out=total[1:])
        h = self._mix((total[g:] - total[:-g]) * self.down[:n - g + 1])
        # least (hash, place) of each window: high bits of the hash, place in the low bits, running minima of blocks
        key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        blocks = np.concatenate([key, np.full(-len(h) % w, ~np.uint64(0))]).reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = n - self.length + 1
        place = (np.minimum(back[:starts], ahead[w - 1:w - 1 + starts]) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:] - 1, [starts - 1]])
        at = place[first]
        end = last + self.length
        context = self._mix((total[end] - total[first]) * self.down[first] + (at - first).astype(np.uint64))
        return at, first, last, h[at], context


def _pieces(raw: bytes, length: int):
    """(offset, bytes) so that every start lies in exactly one piece."""
    for p in range(0, max(len(raw) - length + 1, 1), PIECE):
        yield p, raw[p:p + PIECE + length - 1]


def _grams(length: int):
    def run(batches):
        f = Anchors(length)
        for b in batches:
            grams, contexts = [], []
            for t in b["text"]:
                for _, raw in _pieces((t or "").encode(), length):
                    _, _, _, g, c = f.of(raw)
                    grams.append(g)
                    contexts.append(c)
            if grams:
                yield pd.DataFrame({"g": np.concatenate(grams).view(np.int64), "c": np.concatenate(contexts).view(np.int64)})
    return run


def _places(length: int, bloom):
    def run(batches):
        f, bits = Anchors(length), np.frombuffer(bloom.value, np.uint8)
        for b in batches:
            out = []
            for row, t in zip(b["row"], b["text"]):
                for p, raw in _pieces((t or "").encode(), length):
                    at, first, last, g, c = f.of(raw)
                    ok = _in_bloom(bits, g)
                    if ok.any():
                        out.append((np.full(int(ok.sum()), row), first[ok] + p, last[ok] + p, at[ok] + p, g[ok], c[ok]))
            if out:
                r, first, last, at, g, c = (np.concatenate(x) for x in zip(*out))
                yield pd.DataFrame({"row": r, "first": first, "n": last - first + 1, "back": at - first,
                                    "g": g.view(np.int64), "c": c.view(np.int64)})
    return run


def _bloom_places(g: np.ndarray, n_bits: int):
    for s in (0, 20):
        yield (Anchors._mix(g + np.uint64(s)) >> np.uint64(3)) % np.uint64(n_bits)


def _in_bloom(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    ok = np.ones(len(g), bool)
    for p in _bloom_places(g, 8 * len(bits)):
        ok &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return ok


def _bloom(grams: DataFrame, n: int, bloom_bytes: int) -> bytes:
    """Bits of all repeated grams: a few partial filters of a bounded size, which
    the driver merges one by one."""
    size = 1024
    while size < min(bloom_bytes, 2 * n):
        size *= 2
    size = min(size, bloom_bytes)

    def run(batches):
        bits = np.zeros(size, np.uint8)
        for b in batches:
            for p in _bloom_places(b["g"].to_numpy().view(np.uint64), 8 * size):
                np.bitwise_or.at(bits, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        yield pd.DataFrame({"b": [bits.tobytes()]})

    parts = max(1, min(8, n // 500_000 + 1))
    out = np.zeros(size, np.uint8)
    for r in grams.select("g").coalesce(parts).mapInPandas(run, "b binary").toLocalIterator():
        out |= np.frombuffer(r["b"], np.uint8)
    return out.tobytes()


# ---- difference cover -----------------------------------------------------------------------------------------------

def suffix_order(s: np.ndarray, span: int) -> np.ndarray:
    """Suffixes of ``s`` (integers >= 1) in an order that agrees with their
    first ``span`` symbols at least."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: tuple(s[i:].tolist())), np.int64)
    pad = np.concatenate([s, np.zeros(3, s.dtype)])
    ones, twos, zeros = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])       # a pad position ends the first half if it would run into the second
    names, distinct = _names(pad, sample)
    if distinct == len(sample) or span <= 3:
        order = np.argsort(names, kind="stable")
    else:
        order = suffix_order(names + 1, -(-span // 3))
    rank = np.zeros(n + 4, np.int64)            # 0 beyond the end: shorter suffixes first
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sample = sample[order]
    sample = sample[sample < n]
    # the other suffixes: by first symbol and the rank of the next, which is sampled
    zeros = zeros[_argsort2(pad[zeros], rank[zeros + 1])]
    # merged through the cover: against class 1 by (symbol, rank), against class 2 by (symbol, symbol, rank)
    c1, c2 = sample[sample % 3 == 1], sample[sample % 3 == 2]
    both = np.concatenate([zeros, c1])
    o1 = _argsort2(pad[both], rank[both + 1])
    both2 = np.concatenate([zeros, c2])
    o2 = _argsort3(pad[both2], pad[both2 + 1], rank[both2 + 2])
    z1, z2 = _before(o1, len(zeros)), _before(o2, len(zeros))
    place = np.empty(n, np.int64)
    place[zeros] = np.arange(len(zeros)) + z1[0] + z2[0]
    among = np.zeros(n, np.int64)
    among[sample] = np.arange(len(sample))
    place[c1] = among[c1] + z1[1]
    place[c2] = among[c2] + z2[1]
    return np.argsort(place, kind="stable")


def _before(order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For items 0..k-1: how many of the others stand before; for the others: how many of those."""
    first = order < k
    left, right = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    left[order] = np.cumsum(~first)
    right[order] = np.cumsum(first)
    return left[:k], right[k:]


def _dense(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1]


def _argsort2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    top = int(b.max(initial=0)) + 1
    if (int(a.max(initial=0)) + 1) * top < 1 << 62:
        return np.argsort(a.astype(np.int64) * top + b, kind="stable")
    return np.lexsort((b, a))


def _argsort3(a, b, c):
    top_b, top_c = int(b.max(initial=0)) + 1, int(c.max(initial=0)) + 1
    if (int(a.max(initial=0)) + 1) * top_b * top_c < 1 << 62:
        return np.argsort((a.astype(np.int64) * top_b + b) * top_c + c, kind="stable")
    return np.lexsort((c, b, a))


def _names(pad: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of the triple at each position among the different triples."""
    far = len(pad) - 1
    x, y, z = (pad[np.minimum(at + d, far)].astype(np.int64) for d in range(3))
    top = int(pad.max(initial=0)) + 1
    if top ** 3 < 1 << 62:
        key = (x * top + y) * top + z
    else:
        key = _dense(x * top + y) * top + z
    u, inv = np.unique(key, return_inverse=True)
    return inv, len(u)


def repeated_starts(contexts: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """Per context, which of its first ``counts`` starts are repeated among all
    contexts given."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    order = suffix_order(text.astype(np.int64) + 1, length)
    is_start = np.zeros(len(text) + 1, np.int64)
    np.add.at(is_start, begin, 1)
    np.add.at(is_start, begin + np.array(counts, np.int64), -1)
    starts = order[np.cumsum(is_start)[:-1][order] > 0]
    same = np.zeros(max(len(starts) - 1, 0), bool)
    views = np.lib.stride_tricks.sliding_window_view(text, length)
    for i in range(0, len(same), 20_000):       # adjacent prefixes, byte by byte
        j = min(i + 20_000, len(same))
        same[i:j] = (views[starts[i:j]] == views[starts[i + 1:j + 1]]).all(axis=1)
    flag = np.zeros(len(text), bool)
    flag[starts[:-1][same]] = True
    flag[starts[1:][same]] = True
    return [flag[b:b + n] for b, n in zip(begin, counts)]


def _runs(flag: np.ndarray) -> list[tuple[int, int]]:
    """[from, to) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _sort_contexts(length: int, positions: int):
    """Whole groups of a gram are gathered (the rows come sorted by gram) until
    they hold ``positions`` bytes, then sorted together."""
    def flush(rows):
        flags = repeated_starts([r[3] for r in rows], [r[2] for r in rows], length)
        out = [(row, first + a, first + z) for (row, first, n, _, _), f in zip(rows, flags) for a, z in _runs(f)]
        return pd.DataFrame(out, columns=["row", "a", "z"])

    def run(batches):
        rows, size = [], 0
        for b in batches:
            for r in zip(b["row"], b["first"], b["n"], b["bytes"], b["g"]):
                if size > positions and r[4] != rows[-1][4]:
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[3])
        if rows:
            yield flush(rows)
    return run


# ---- documents ------------------------------------------------------------------------------------------------------

def _merged(a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals [a, z): touching ones become one."""
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(z[order])
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    return a[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(a) - 1]])]


def _cut(with_spans: bool):
    def run(batches):
        for b in batches:
            out = []
            for t, a, z in zip(b["text"], b["a"], b["z"]):
                raw = (t or "").encode()
                a, z = _merged(np.asarray(a), np.asarray(z)) if a is not None and len(a) else (_NO, _NO)
                kept, at = hashlib.sha256(), 0
                for x, y in zip(a.tolist(), z.tolist()):
                    kept.update(raw[at:x])
                    at = y
                kept.update(raw[at:])
                out.append((len(raw), int((z - a).sum()), len(a), kept.hexdigest(), [{"a": x, "z": y} for x, y in zip(a, z)]))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["removed"] * with_spans
            yield pd.DataFrame({"key": b["key"]} | {n: [o[i] for o in out] for i, n in enumerate(names)})
    return run


def removed_spans(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, bloom_bytes: int = 16 << 20,
                  positions: int = 1_000_000, hot_contexts: int = 5_000, with_spans: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256; with_spans: also the
    removed byte intervals [a, z)."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    # rows get numbers that do not change: the ids are part of a written table, the text is read from where it is
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("row"))
    texts = docs.select("row", "text").filter(F.octet_length("text") >= length)

    grams = (texts.select("text").mapInPandas(_grams(length), "g long, c long").groupBy("g")
             .agg(F.count("*").alias("k"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("k > 1"))
    grams = written(grams.select("g", (F.col("c0") == F.col("c1")).alias("uniform")), "sa-grams")
    n_grams = grams.count()
    shared = spark.sparkContext.broadcast(_bloom(grams, n_grams, bloom_bytes))      # at most bloom_bytes
    places = texts.mapInPandas(_places(length, shared), "row long, first int, n int, back int, g long, c long")
    places = written(places.join(grams, "g"), "sa-places")

    certain = places.filter("uniform").select("row", "first", "n")
    mixed = places.filter("NOT uniform")
    classes = written(mixed.groupBy("g", "c").agg(F.count("*").alias("k"), F.min(F.struct("row", "first", "n", "back")).alias("p")),
                      "sa-classes")
    # a context of very many copies is spread over the salts
    twice = classes.filter("k > 1").select("g", "c", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = mixed.withColumn("salt", F.pmod(F.xxhash64("row", "first"), F.lit(SALTS)).cast("int"))
    certain = certain.unionByName(salted.join(twice, ["g", "c", "salt"], "left_semi").select("row", "first", "n"))
    spans = certain.select("row", F.col("first").alias("a"), (F.col("first") + F.col("n") - 1 + length).alias("z"))

    # one copy of each different context, with its bytes
    per_gram = classes.groupBy("g").agg(F.count("*").alias("contexts"))
    wanted = (classes.join(per_gram, "g").filter("contexts > 1")
              .select("g", "c", "p.row", "p.first", "p.n", (F.col("contexts") > hot_contexts).alias("hot")))
    by_row = wanted.groupBy("row").agg(F.collect_list(F.struct("g", "first", "n", "hot")).alias("at"))

    def contexts(batches):
        for b in batches:
            out = []
            for row, t, at in zip(b["row"], b["text"], b["at"]):
                raw = t.encode()
                out.extend((row, x["first"], x["n"], raw[x["first"]:x["first"] + x["n"] - 1 + length], x["g"], x["hot"]) for x in at)
            yield pd.DataFrame(out, columns=["row", "first", "n", "bytes", "g", "hot"])
    ctx = written(texts.join(by_row, "row").mapInPandas(contexts, "row long, first int, n int, bytes binary, g long, hot boolean"),
                  "sa-contexts")
    found = (ctx.filter("NOT hot").repartition("g").sortWithinPartitions("g").select("row", "first", "n", "bytes", "g")
             .mapInPandas(_sort_contexts(length, positions), "row long, a int, z int"))
    hot = (ctx.filter("hot").select("row", "first", "g", "bytes", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("d"))
           .select("row", (F.col("first") + F.col("d")).alias("a"), F.substring("bytes", F.col("d") + 1, F.lit(length)).alias("string")))
    often = hot.groupBy("string").agg(F.count("*").alias("k")).filter("k > 1").select("string")
    hot = hot.join(often, "string", "left_semi").select("row", "a", (F.col("a") + 1).alias("z"))
    late = found.unionByName(hot).select("row", "a", (F.col("z") - 1 + length).alias("z"))
    spans = written(spans.unionByName(late), "sa-spans")

    gathered = spans.groupBy("row").agg(F.collect_list(F.struct("a", "z")).alias("s"))
    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", removed array<struct<a:int,z:int>>" * with_spans
    return (docs.join(gathered, "row", "left").select("key", "text", F.col("s.a").alias("a"), F.col("s.z").alias("z"))
            .mapInPandas(_cut(with_spans), schema).withColumnRenamed("key", key))
