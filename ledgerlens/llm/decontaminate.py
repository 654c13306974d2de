"""Benchmark decontamination with one Aho-Corasick automaton.

Texts and items are normalised alike: ASCII letters lowered, words are runs of
digits, lower-case letters and non-ASCII characters, joined by single spaces.
The automaton holds every item cut into pieces of half a window (an item
shorter than a window is one piece); any full window of an item contains at
least one whole piece.  A text is scanned once; around each piece found, the
match is extended word by word, and a run of at least a window marks its words
and names its item.  Positions are word numbers, mapped back to character
offsets of the original text.

The automaton is linear in the item texts.  Items are cut into blocks of a
bounded size.  One block at a time is read by the driver and broadcast; with
more than one, rows and their hits are written to the shared folder after each
block and its broadcast is given back before the next, so a large benchmark
means more scans and writes, not a larger broadcast or more automata in a task.

Defined results: NULL and empty texts have no words and no hits; items without
words match nothing; items of one id count once; NULL item ids are skipped;
without items nothing is contaminated.  Columns of the input pass through; the
operator's own columns carry the prefix ``dc_``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")      # on texts before lowering
_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def normalise(text: str | None) -> str:
    """Words of a text joined by single spaces (lowering bytes touches A-Z only)."""
    return b" ".join(text.encode().lower().translate(_TO_SPACE).split()).decode() if text else ""


class Matcher:
    """Automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int = 10):
        import ahocorasick
        self.window, self.items = window, []
        piece = window // 2
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            line = normalise(text)
            if not line:
                continue
            words = line.split(" ")
            n = len(self.items)
            self.items.append((str(item_id), words))
            cuts = [(0, len(words))] if len(words) < window else [(i, i + piece) for i in range(0, len(words) - piece + 1, piece)]
            for i, j in cuts:
                places.setdefault(" ".join(words[i:j]), []).append((n, i))
        self.auto = ahocorasick.Automaton() if places else None
        for text, at in places.items():
            self.auto.add_word(f" {text} ", (text.count(" ") + 1, at))
        if self.auto is not None:
            self.auto.make_automaton()

    def find(self, line: str) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word intervals [start, end) that are hit, and the item ids."""
        if self.auto is None or not line:
            return [], set()
        words, runs, items, done = None, [], set(), {}
        for end, (k, at) in self.auto.iter(f" {line} "):
            if words is None:       # and the character position of each word in the line
                words = line.split(" ")
                starts = list(accumulate((len(w) + 1 for w in words), initial=1))
            p = bisect_right(starts, end - 1) - k          # first word of the piece
            for n, i in at:
                if done.get((n, p - i), -1) > p:
                    continue                                # inside a run already extended
                item_id, own = self.items[n]
                lo, hi = 0, k
                while p - lo > 0 and i - lo > 0 and words[p - lo - 1] == own[i - lo - 1]:
                    lo += 1
                while p + hi < len(words) and i + hi < len(own) and words[p + hi] == own[i + hi]:
                    hi += 1
                done[(n, p - i)] = p + hi
                if lo + hi >= min(self.window, len(own)):
                    runs.append((p - lo, p + hi))
                    items.add(item_id)
        return merge(runs), items


def merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of intervals."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of word intervals."""
    at = [m.span() for m in WORD.finditer(text)] if spans else []
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


SPAN = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("word_start", "word_end", "char_start", "char_end")]))


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """(is it the last, items) for blocks of (id, text) of bounded size, each read when it is asked
    for; the number of blocks follows the measured size of the item table."""
    d = items.select(F.col(item_id).cast("string").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).filter("i IS NOT NULL")
    total = d.agg(F.sum(F.octet_length("t") + 64).alias("s")).collect()[0]["s"] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        yield k == n - 1, [(r["i"], r["t"]) for r in d.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def scan(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = 10, block_bytes: int = 4 << 20, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all) plus dc_n_words, dc_spans (merged word
    and character intervals) and dc_items (sorted ids).  No shuffle: each block
    of items is one pass of mapInPandas over the rows; all but the last pass are written
    when this is called."""
    spark = df.sparkSession
    keep = df.columns if carry is None else carry
    names = [f"c{i}" for i in range(len(keep))]
    out = [T.StructField(n, df.schema[c].dataType) for n, c in zip(names, keep)] + [
        T.StructField("t", T.StringType()), T.StructField("n", T.LongType()), T.StructField("spans", SPAN),
        T.StructField("items", T.ArrayType(T.StringType()))]
    d = df.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, keep)], F.col(f"`{text}`").alias("t"),
                  F.lit(0).cast("long").alias("n"), F.array().cast(SPAN).alias("spans"),
                  F.array().cast("array<string>").alias("items"))
    for last, block in _blocks(items, item_id, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        d = d.mapInPandas(_scanner(shared, window, last), T.StructType(out))
        if not last:
            d = written(d, "decontaminate")
            shared.destroy()
    return d.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("n").alias("dc_n_words"),
                    F.col("spans").alias("dc_spans"), F.col("items").alias("dc_items"))


def _scanner(shared, window: int, last: bool):
    def run(batches):
        m = Matcher(shared.value, window)
        for b in batches:
            ns, spans, items = [], [], []
            for t, old_s, old_i in zip(b["t"], b["spans"], b["items"]):
                line = normalise(t)
                s, i = m.find(line)
                if len(old_s):
                    s = merge(s + [(x["word_start"], x["word_end"]) for x in old_s])
                c = offsets(t, s)
                ns.append(line.count(" ") + 1 if line else 0)
                spans.append([{"word_start": x[0], "word_end": x[1], "char_start": y[0], "char_end": y[1]} for x, y in zip(s, c)])
                items.append(sorted(i | set(old_i)))
            b["n"], b["spans"], b["items"] = ns, pd.Series(spans, index=b.index, dtype=object), pd.Series(items, index=b.index, dtype=object)
            if last:
                b["t"] = None       # the text has been read for the last time
            yield b
    return run


def digest(df: DataFrame, items: DataFrame, key: str = "doc_id", **kw) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256, contaminated."""
    s = scan(df, items, carry=[key], **kw)
    n_hit = F.aggregate("dc_spans", F.lit(0).cast("long"), lambda a, x: a + (x["word_end"] - x["word_start"]))
    return s.select(key, F.col("dc_n_words").alias("n_words"), n_hit.alias("n_hit"),
                    F.size("dc_items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("dc_items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(df: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """Rows of ``df`` without a hit, with the columns of ``df``."""
    return scan(df, items, **kw).filter(F.size("dc_spans") == 0).select(*df.columns)
