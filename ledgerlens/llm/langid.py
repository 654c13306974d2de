"""Language identification with error-correcting output codes.

Every language gets a codeword; one binary classifier per bit predicts that
bit from hashed byte n-grams; loss-weighted decoding picks the codeword with
the least weighted logistic loss.  A text whose two best codewords are close,
or whose bits lie further from the chosen codeword than the code can correct,
is flagged ambiguous.

Training takes a bounded, seeded sample of labelled rows
(``rows_per_language``, documented bound of the fit); scoring reads every
whole text once, without a shuffle.

Defined results: a NULL text or one without a letter is ``und`` with score 0;
rows with a NULL label never train; with a single label every text with a
letter gets it; with none every text is ``und``; repeated rows score alike;
other columns pass through or are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LETTER = re.compile(r"[^\W\d_]")
DIMS = 1 << 12


def features(text: str, dims: int = DIMS) -> np.ndarray:
    """Unit vector of square roots of hashed byte 2- and 3-gram counts of the
    whole lower-cased text; digits and ASCII punctuation count as spaces."""
    raw = f" {text.lower()} ".encode().translate(_SPACED)
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    two = a[:-1] * np.uint32(257) + a[1:]
    three = two[:-1] * np.uint32(263) + a[2:]
    h = np.concatenate([two * np.uint32(2654435761) >> np.uint32(20), three * np.uint32(2246822519) >> np.uint32(20)])
    c = np.bincount(h & np.uint32(dims - 1), minlength=dims)
    x = np.sqrt(c, dtype=np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-9)


_SPACED = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """k rows of +-1.  Up to six languages: every way to split them in two.
    More: of many random codes the one with the largest least distance."""
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 6:
        bits = np.arange(1, 1 << (k - 1))
        code = np.array([[1 if (b >> r) & 1 else -1 for b in bits] for r in range(k - 1)] + [[-1] * len(bits)], np.int8)
        return code
    rng = np.random.default_rng(seed)
    width = max(15, math.ceil(10 * math.log2(k)))
    best, far = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, width))
        d = (width - code.astype(int) @ code.T.astype(int)) // 2
        least = int(d[~np.eye(k, dtype=bool)].min())
        if least > far:
            best, far = code, least
    return best


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, w: np.ndarray, b: np.ndarray, bit_weight: np.ndarray):
        self.langs, self.code, self.w, self.b, self.bit_weight = langs, code, w, b, bit_weight
        d = [int((code[i] != code[j]).sum()) for i in range(len(langs)) for j in range(i)]
        self.corrects = (min(d) - 1) // 2 if d else 0

    def score(self, x: np.ndarray) -> tuple[str, float, bool]:
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        f = x @ self.w + self.b
        loss = np.logaddexp(0, -self.code * f[None, :]) @ self.bit_weight
        order = np.argsort(loss, kind="stable")
        e = np.exp(loss[order[0]] - loss)
        p = float(e[order[0]] / e.sum())
        wrong = int((np.sign(f) != self.code[order[0]]).sum())
        return self.langs[order[0]], p, bool(wrong > self.corrects or loss[order[1]] - loss[order[0]] < 0.5)


def train(x: np.ndarray, y: list[str], steps: int = 150, l2: float = 1e-5, seed: int = 5) -> Model:
    """One logistic classifier per bit, all bits together, full batches with
    momentum; every language weighs the same."""
    langs = sorted(set(y))
    code = codewords(len(langs), seed)
    if len(langs) < 2:
        return Model(langs, code, np.zeros((x.shape[1], 1), np.float32), np.zeros(1, np.float32), np.ones(1))
    at = np.array([langs.index(v) for v in y])
    target = code[at].astype(np.float32)
    row_w = (1.0 / np.bincount(at)[at] / len(langs)).astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    vw, vb, lr = np.zeros_like(w), np.zeros_like(b), 20.0
    for _ in range(steps):
        f = x @ w + b
        g = -target * row_w / (1 + np.exp(np.clip(target * f, -30, 30)))
        vw = 0.9 * vw - lr * (x.T @ g + l2 * w)
        vb = 0.9 * vb - lr * 0.1 * g.sum(0)
        w, b = w + vw, b + vb
    err = ((target * (x @ w + b) <= 0) * row_w).sum(0)
    bit_weight = np.clip(0.5 * np.log((1 - err + 1e-3) / (err + 1e-3)), 0.05, None)
    return Model(langs, code, w, b, bit_weight / bit_weight.mean())


def fit(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = 600, seed: int = 5) -> Model:
    """Fit on at most ``rows_per_language`` rows of each label, first by a seeded
    hash of key and text, and at least one; the rest of the labelled rows only
    count.  Copies of a text with keys of their own are rows like others."""
    d = (rows.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"),
                     F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit(seed)), F.lit(1 << 40)).alias("h"))
         .filter("t IS NOT NULL AND l IS NOT NULL"))
    found = d.groupBy("l").agg(F.count("*").alias("n"), F.min("h").alias("h")).collect()
    counts, least = {r["l"]: r["n"] for r in found}, {r["l"]: r["h"] for r in found}
    if not counts:
        return Model([], np.ones((0, 1), np.int8), np.zeros((DIMS, 1), np.float32), np.zeros(1, np.float32), np.ones(1))
    most = F.lit(0).cast("long")
    for k in sorted(counts):
        share = min(1.0, max(1.2 * rows_per_language, rows_per_language + 50) / counts[k])
        most = F.when(F.col("l") == k, F.lit(max(least[k], int((1 << 40) * share)))).otherwise(most)
    order = Window.partitionBy("l").orderBy("h", "t")
    picked = (d.filter(F.col("h") <= most).withColumn("i", F.row_number().over(order))
              .filter(F.col("i") <= rows_per_language).select("t", "l"))

    def run(batches):
        for b in batches:
            b = b[[bool(LETTER.search(t)) for t in b["t"]]]
            if len(b):
                yield pd.DataFrame({"l": b["l"], "x": [features(t).astype(np.float16).tobytes() for t in b["t"]]})
    got = picked.mapInPandas(run, "l string, x binary").orderBy("l", "x").toPandas()
    if got.empty:
        return Model([], np.ones((0, 1), np.int8), np.zeros((DIMS, 1), np.float32), np.zeros(1, np.float32), np.ones(1))
    x = np.frombuffer(b"".join(got["x"]), np.float16).reshape(len(got), DIMS).astype(np.float32)
    return train(x, list(got["l"]), seed=seed)


def predict(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score, ambiguous for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)      # one weight per hashed n-gram and bit

    def run(batches):
        m = shared.value
        for b in batches:
            out = [m.score(features(t)) if t and m.langs and LETTER.search(t) else ("und", 0.0, True) for t in b["t"]]
            yield pd.DataFrame({"k": b["k"], "lang_pred": [o[0] for o in out], "score": [o[1] for o in out],
                                "ambiguous": [o[2] for o in out]})
    kind = df.schema[key].dataType.simpleString()
    return (df.select(F.col(key).alias("k"), F.col(text).alias("t"))
            .mapInPandas(run, f"k {kind}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("k", key))
