"""Toxic passages by maximum-scoring segments of token log-odds.

1. Units are words and their first 3 to 7 bytes, which pool the endings of an
   inflected stem; a word takes the largest score of its units.  A unit's score
   is the log-odds of the share of toxic against clean training documents that
   contain it, with a Dirichlet prior proportional to its overall share, less
   two standard errors.  Documents, not occurrences, are counted, so one long
   repetitive text has no extra weight.  Words without a score above zero by
   that margin get a small negative one; so random text has a negative
   expectation.
2. A linear scan finds all maximal scoring segments of the whole text.
3. Extreme-value calibration: under the clean background the best segment of n
   tokens exceeds s about K * n * exp(-lambda * s) times; lambda solves
   sum p(x) exp(lambda x) = 1 over the background's token scores and K is
   fitted on clean training documents.  A segment's evidence is minus the log
   of its expected number; a segment with fewer than ``max_expected`` is
   significant.
4. The evidence of a document's significant segments is added up; a logistic
   curve turns it into a probability.  Background and curve are fitted on each
   half of the training documents with the units that the other half chose.

The fit uses a bounded, seeded sample of labelled documents (``max_labelled``)
and keeps at most ``max_terms`` units, which bounds what is broadcast; the
scan covers every whole text without a shuffle.

Defined results: NULL, empty and wordless texts have no segment and the score
of zero evidence; labels that are NULL or not 0/1 do not train; without both
classes every score is 0; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
STEP_DOWN = -0.25


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.encode().lower().translate(_TO_SPACE).split() if text else []


def maximal_segments(positions: list[int], scores: list[float], step: float = STEP_DOWN) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, end) in linear time.

    The tokens at ``positions`` score ``scores`` (positive); all others score
    ``step`` (negative), so only the former are visited.  Each candidate keeps
    the cumulative score left of it and at its right end; a new one absorbs
    the candidates back to the last with a lower left score whose right end it
    exceeds (each candidate is absorbed at most once)."""
    out: list[tuple[float, float, int, int]] = []       # left sum, right sum, start, end
    total, prev = 0.0, -1
    for p, s in zip(positions, scores):
        total += step * (p - prev - 1)
        left, start = total, p
        total += s
        prev = p
        while True:
            k = len(out) - 1
            while k >= 0 and out[k][0] >= left:
                k -= 1
            if k < 0 or out[k][1] >= total:
                out.append((left, total, start, p + 1))
                break
            left, start = out[k][0], out[k][2]
            del out[k:]
    return [(a, b, r - x) for x, r, a, b in out]


class Model:
    def __init__(self, terms: dict[bytes, float], lam: float, k: float, slope: float, bias: float, max_expected: float):
        self.terms, self.lam, self.k, self.slope, self.bias, self.max_expected = terms, lam, k, slope, bias, max_expected

    def passages(self, words: list[bytes], scores: Scores | None = None) -> list[tuple[int, int, float, float]]:
        """(start, end, score, evidence) of every significant segment."""
        at, found = scored(words, Scores(self.terms) if scores is None else scores)
        if not at:
            return []
        floor = -math.log(self.max_expected)
        out = []
        for a, b, s in maximal_segments(at, found):
            e = self.lam * s - math.log(self.k * len(words))
            if e > floor:
                out.append((a, b, s, e))
        return out

    def probability(self, evidence: float) -> float:
        if not self.terms:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * math.log1p(evidence) + self.bias))))


PREFIXES = (3, 4, 5, 6, 7)


def units(word: bytes) -> list[bytes]:
    """The units whose scores a word may take: itself and its first bytes, which
    pool the endings of an inflected stem (a prefix is marked by a final *)."""
    return [word, *(word[:k] + b"*" for k in PREFIXES if k < len(word))]


class Scores(dict):
    """Score of a word: the largest of its units, None without one.  Words are
    remembered up to a bound."""

    def __init__(self, terms: dict[bytes, float], most: int = 300_000):
        super().__init__()
        self.terms, self.most = terms, most

    def __missing__(self, word: bytes) -> float | None:
        if len(self) >= self.most:
            self.clear()
        found = [s for s in map(self.terms.get, units(word)) if s is not None]
        out = self[word] = max(found) if found else None
        return out


def scored(words: list[bytes], scores: Scores) -> tuple[list[int], list[float]]:
    """Places and scores of the words that have one."""
    hit = [(i, s) for i, s in enumerate(map(scores.__getitem__, words)) if s is not None]
    return [h[0] for h in hit], [h[1] for h in hit]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_labelled: int = 20_000, max_terms: int = 50_000, prior: float = 20.0, max_expected: float = 0.05, least_z: float = 3.0, least_score: float = 1.0,
        seed: int = 11) -> Model:
    """Fit on at most about ``max_labelled`` seeded labelled documents.  The
    background and the logistic link are fitted on each half of them with the
    terms that the other half chose; the model's terms come from both."""
    lab = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
           .filter("k IS NOT NULL AND y IN (0, 1)").groupBy("k").agg(F.max("y").alias("y")))
    n = lab.count()
    if n > max_labelled:
        lab = lab.filter(F.pmod(F.xxhash64(F.col("k"), F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * max_labelled / n))
    lab = lab.withColumn("h", F.pmod(F.xxhash64(F.col("k"), F.lit(seed + 1)), F.lit(2)).cast("int"))
    # at most max_labelled rows of (id, 0/1, half): small by its parameter
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(lab), "k")

    def count(batches):
        for b in batches:
            c: dict[bytes, list[int]] = {b"\0docs": [0, 0, 0, 0]}
            for y, h, t in zip(b["y"], b["h"], b["t"]):
                c[b"\0docs"][2 * h + y] += 1
                for u in {u for w in set(tokens(t)) for u in units(w)}:
                    c.setdefault(u, [0, 0, 0, 0])[2 * h + y] += 1
            yield pd.DataFrame([(u, *v) for u, v in c.items()], columns=["w", "a0", "a1", "b0", "b1"])
    sums = [F.sum(x).alias(x) for x in ("a0", "a1", "b0", "b1")]
    counts = written(rows.mapInPandas(count, "w binary, a0 long, a1 long, b0 long, b1 long").groupBy("w").agg(*sums), "toxic-counts")
    size = counts.filter(F.col("w") == F.lit(b"\0docs")).collect()
    a0, a1, b0, b1 = (size[0][x] for x in ("a0", "a1", "b0", "b1")) if size else (0, 0, 0, 0)

    def select(y0, y1, n0, n1) -> dict[bytes, float]:
        if not n0 or not n1:
            return {}
        a = F.lit(prior) * (y0 + y1) / F.lit(float(n0 + n1))     # prior counts: the overall share

        def log_odds(y, size_):
            return F.log((y + a) / F.greatest(F.lit(float(size_) + prior) - y - a, F.lit(1e-9)))
        delta = log_odds(y1, n1) - log_odds(y0, n0)
        err = F.sqrt(1 / F.greatest(y1 + a, F.lit(1e-9)) + 1 / F.greatest(y0 + a, F.lit(1e-9)))
        top = (counts.filter((F.col("w") != F.lit(b"\0docs")) & (y1 >= 3)).withColumn("d", delta).withColumn("e", err)
               .filter((F.col("d") > least_z * F.col("e")) & (F.col("d") - 2 * F.col("e") > least_score))
               .select("w", (F.col("d") - 2 * F.col("e")).alias("s"), (F.col("d") / F.col("e")).alias("z"))
               .orderBy(F.desc("z"), "w").limit(max_terms).collect())
        return {bytes(r["w"]): float(r["s"]) for r in top}
    first, second = (F.col("a0"), F.col("a1"), a0, a1), (F.col("b0"), F.col("b1"), b0, b1)
    terms = select(F.col("a0") + F.col("b0"), F.col("a1") + F.col("b1"), a0 + b0, a1 + b1)
    if not terms:
        return Model({}, 1.0, 1.0, 1.0, 0.0, max_expected)
    # the terms for a half are those of the other; too few labels for that: those of both
    of_half = [select(*second) or terms, select(*first) or terms]

    # background: how often clean documents' tokens have each score; best segments of the sample
    shared = docs.sparkSession.sparkContext.broadcast(of_half)

    def background(batches):
        get = [Scores(t) for t in shared.value]
        for b in batches:
            out = []
            for y, h, t in zip(b["y"], b["h"], b["t"]):
                w = tokens(t)
                at, s = scored(w, get[h])
                seg = maximal_segments(at, s)
                c = Counter(s) if y == 0 else {}
                out.append((y, len(w), list(c), list(c.values()), sorted((s for _, _, s in seg), reverse=True)))
            yield pd.DataFrame(out, columns=["y", "n", "scores", "counts", "segments"])
    s = rows.mapInPandas(background, "y int, n long, scores array<double>, counts array<long>, segments array<double>").toPandas()
    clean = s[s["y"] == 0]
    lam, k = calibrate(clean, np.array(list(terms.values())))
    m = Model(terms, lam, k, 1.0, 0.0, max_expected)
    floor = -math.log(max_expected)
    x = np.array([math.log1p(sum(e for e in (lam * v - math.log(k * max(n, 1)) for v in seg) if e > floor))
                  for n, seg in zip(s["n"], s["segments"])])
    m.slope, m.bias = _logistic(x, s["y"].to_numpy(float))
    return m


def calibrate(clean: pd.DataFrame, scores: np.ndarray) -> tuple[float, float]:
    """lambda of the background's score distribution, K of its best segments.
    ``scores`` are the terms' scores; half an occurrence, shared by them, is added."""
    n = max(int(clean["n"].sum()), 1)
    seen: Counter = Counter()
    for s, c in zip(clean["scores"], clean["counts"]):
        seen.update(dict(zip(s, c)))
    for s in scores:
        seen[s] += 0.5 / len(scores)
    value = np.array(list(seen))
    share = np.array([seen[v] for v in seen], float) / (n + 1.0)

    def excess(lam):    # background: a hit of each score as often as clean documents have it, else one step down
        return float(share @ np.exp(np.minimum(lam * value, 700))) + (1 - float(share.sum())) * math.exp(lam * STEP_DOWN) - 1
    lo, hi = 1e-6, 1e-3
    while excess(hi) < 0 and hi < 64:
        hi *= 2
    if excess(hi) < 0:
        return 1.0, 1.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    best = np.array([v[0] if len(v) else 0.0 for v in clean["segments"]])
    y = np.exp(-hi * best) * np.maximum(clean["n"].to_numpy(float), 1)
    return hi, float(np.clip(1.0 / max(y.mean(), 1e-12), 1e-6, 1.0))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Newton's method for one slope and a bias, lightly regularised."""
    a, b = 1.0, -1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * x).sum() + 1e-2 * a, (p - y).sum() + 1e-2 * b])
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        d = np.linalg.solve(h, g)
        a, b = a - float(np.clip(d[0], -2, 2)), b - float(np.clip(d[1], -2, 2))
    return max(a, 1e-3), b


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, predicted, evidence and the significant passages (word and
    character offsets) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)     # at most max_terms tokens

    def run(batches):
        m = shared.value
        known = Scores(m.terms)
        for b in batches:
            scores, evid, spans = [], [], []
            for t in b["t"]:
                found = m.passages(tokens(t), known)
                e = sum(f[3] for f in found)
                evid.append(e)
                scores.append(m.probability(e))
                at = [x.span() for x in _WORD.finditer(t)] if found else []
                spans.append([{"word_start": a, "word_end": z, "char_start": at[a][0], "char_end": at[z - 1][1],
                               "segment_score": s, "evidence": v} for a, z, s, v in found])
            yield pd.DataFrame({"k": b["k"], "score": scores, "evidence": evid, "passages": pd.Series(spans, index=b.index, dtype=object)})
    kind = df.schema[key].dataType.simpleString()
    return (df.select(F.col(key).alias("k"), F.col(text).alias("t"))
            .mapInPandas(run, f"k {kind}, score double, evidence double, passages array<struct<word_start:int,word_end:int,"
                              "char_start:int,char_end:int,segment_score:double,evidence:double>>")
            .select(F.col("k").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "passages"))
