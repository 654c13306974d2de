"""Scoring texts with a causal self-attention model.

The probability of a word is P(class of the word | words before) times
P(word | class).  The first factor comes from a causal self-attention model
(one head, learned positions, trained here in numpy) that reads each word's
first subword id (the longest vocabulary entry that begins the word) and
predicts the class of the next; the second from counts of
the whole training corpus, which Spark gathers, with one added to each.
Classes: the most frequent words have one each; all others share the classes
found by clustering first subwords by the words around them.

Long texts are scored in overlapping windows: ``stride`` new tokens and
``context`` tokens before them, which are attended to but not scored again, so
each token is scored once; windows of many documents form one batch, with
causal and padding masks.

Counts of the ``head_words`` most frequent words are broadcast (that number
bounds their size); every other word of a document is joined with the table
of counts, wherever it lies.  Which subwords are inputs, their classes and the
neighbours that decide those come from all training documents, as Spark
aggregates.  The attention model is trained on every window of every training
document, in ``rounds`` passes that each take their share of a document's
windows: every task trains its own copy and the copies are averaged.  A corpus
of fewer than ``steps`` batches is gone over several times by one task.  A caller may let
the first pass begin from a model of ``fit_documents`` seeded documents.

Defined results: NULL, empty and blank texts are the end token alone; without
training rows counts are zero and every class is equally likely; repeated rows
score alike if their keys differ, and a repeated key is scored by row; other
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written
from ledgerlens.llm.token_store import load_tokenizer

END = ""                # the end token among words: no word is empty
PAD, BOS, OTHER = 0, 1, 2
LIMIT = 60.0            # of scores and logits either way: their exponentials fit float32, so no maximum is taken off first


def split_words(texts) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The words of a batch of texts as numbers, how many each text has, and the
    different words.  Lowering and splitting are ASCII's, as the words are
    runs without ASCII white space; the end token is not among them."""
    t = pc.fill_null(pa.array(texts, pa.large_string(), from_pandas=True), "")
    t = pc.ascii_trim_whitespace(pc.ascii_lower(t))
    lists = pc.ascii_split_whitespace(t)
    some = pc.not_equal(t, "").to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    if not some.all():          # an empty text splits into one empty string
        flat = flat.filter(pa.array(np.repeat(some, sizes)))
        sizes = np.where(some, sizes, 0)
    words = flat.dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes, words.dictionary.to_pylist()


class FirstSubword:
    """Id of the subword that a word begins with: the word itself if it is in
    the vocabulary, else the longest vocabulary entry that begins it."""

    def __init__(self, tokenizer: str):
        tok = load_tokenizer(tokenizer)
        self.size = tok.get_vocab_size()
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]       # bytes that stand for themselves in the vocabulary
        char = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in set(plain))}
        self.whole, self.start = {}, {}
        self.known: dict[str, int] = {}         # words looked up before, a bounded number
        for t, i in tok.get_vocab(with_added_tokens=False).items():
            body = t.removesuffix("</w>")
            if all(c in char for c in body):
                raw = bytes(char[c] for c in body)
                (self.whole if body != t else self.start)[raw] = i
        self.longest = max(map(len, self.start), default=1)

    def of(self, words: list[str], remembered: int = 250_000) -> np.ndarray:
        out = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        whole, start, longest = self.whole.get, self.start, self.longest
        for j in np.flatnonzero(out < 0).tolist():
            w = words[j]
            raw = w.encode()
            i = whole(raw)
            if i is None:
                k = min(len(raw), longest)
                while k and raw[:k] not in start:
                    k -= 1
                i = start[raw[:k]] if k else 0
            out[j] = i
            if len(self.known) < remembered:
                self.known[w] = i
        return out


_FIRST: dict[str, FirstSubword] = {}


def _first_subword(tokenizer: str) -> FirstSubword:
    """One per worker."""
    if tokenizer not in _FIRST:
        _FIRST[tokenizer] = FirstSubword(tokenizer)
    return _FIRST[tokenizer]


# ---- the attention model ------------------------------------------------------------------------------------------

class Attention:
    """x = E[id] + P; x + softmax(masked q k') v Wo; class logits."""

    def __init__(self, n_in: int, n_class: int, d: int, window: int, seed: int = 1):
        r = np.random.default_rng(seed)

        def m(*shape):
            return (r.standard_normal(shape) * 0.1).astype(np.float32)
        self.p = {"E": m(n_in, d), "P": m(window, d), "Wq": m(d, d), "Wk": m(d, d), "Wv": m(d, d), "Wo": m(d, d),
                  "Wu": m(d, n_class), "b": np.zeros(n_class, np.float32)}
        self.d, self.window = d, window
        self.mask = np.triu(np.full((window, window), -1e9, np.float32), 1)

    def _attend(self, ids: np.ndarray, first: int):
        """What positions ``first``.. take from those before them.  Products are of two-dimensional
        arrays wherever the rows of all windows can be taken together."""
        p, d = self.p, self.d
        n, t = ids.shape
        x = p["E"][ids]
        x += p["P"]
        flat = x.reshape(-1, d)
        kv = (flat @ np.concatenate([p["Wk"], p["Wv"]], 1)).reshape(n, t, 2 * d)
        late = np.ascontiguousarray(x[:, first:]).reshape(-1, d)
        q = (late @ (p["Wq"] * p["Wq"].dtype.type(1 / math.sqrt(d)))).reshape(n, t - first, d)
        k, v = kv[:, :, :d], kv[:, :, d:]
        s = q @ k.transpose(0, 2, 1)
        np.clip(s, -LIMIT, LIMIT, out=s)
        s += self.mask[first:]
        pad = ids == PAD
        if pad.any():
            s += np.where(pad, np.float32(-1e9), np.float32(0))[:, None, :]
        np.exp(s, out=s)
        s /= (s @ np.ones(t, s.dtype) + 1e-30)[:, :, None]       # nothing before but padding: nothing is taken
        av = (s @ v).reshape(-1, d)
        return flat, late, q, k, v, s, av, late + av @ p["Wo"]

    def _logits(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.p["Wu"]
        z += self.p["b"]
        return np.clip(z, -LIMIT, LIMIT, out=z)

    def log_probs(self, ids: np.ndarray, targets: np.ndarray, context: int) -> np.ndarray:
        """Natural log probability of the targets of positions ``context``.."""
        p = self.p
        z = self._logits(self._attend(ids, context)[-1])
        own = z[np.arange(len(z)), targets.ravel()]
        return (own - np.log(np.exp(z, out=z) @ np.ones(len(p["b"]), z.dtype))).reshape(targets.shape)

    def gradients(self, ids: np.ndarray, targets: np.ndarray, valid: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients; positions before the first valid one are only attended to."""
        p, g, d = self.p, {}, self.d
        some = valid.any(axis=0)
        first = int(some.argmax()) if some.any() else 0
        y, ok = targets[:, first:].ravel(), valid[:, first:].ravel()
        x, late, q, k, v, a, av, h = self._attend(ids, first)
        z = self._logits(h)
        np.exp(z, out=z)
        total, at = z @ np.ones(z.shape[1], z.dtype), np.arange(len(z))
        n = max(float(ok.sum()), 1.0)
        loss = float(-(np.log(z[at, y] / total + 1e-12) * ok).sum() / n)
        share = (ok / n).astype(z.dtype)
        z *= (share / total)[:, None]
        z[at, y] -= share                       # the gradient of the logits
        g["Wu"], g["b"] = h.T @ z, np.ones(len(z), z.dtype) @ z
        dh = z @ p["Wu"].T
        g["Wo"] = av.T @ dh
        dav = (dh @ p["Wo"].T).reshape(q.shape)
        ds = dav @ v.transpose(0, 2, 1)
        dkv = np.empty((len(ids), ids.shape[1], 2 * d), z.dtype)
        dkv[:, :, d:] = a.transpose(0, 2, 1) @ dav
        ds -= np.einsum("ij,ij->i", dav.reshape(-1, d), av).reshape(*a.shape[:2], 1)
        ds *= a
        dkv[:, :, :d] = ds.transpose(0, 2, 1) @ q
        dq = (ds @ k).reshape(-1, d) * z.dtype.type(1 / math.sqrt(d))
        flat = dkv.reshape(-1, 2 * d)
        g["Wq"] = late.T @ dq
        both = x.T @ flat
        g["Wk"], g["Wv"] = both[:, :d], both[:, d:]
        dx = (flat @ np.concatenate([p["Wk"], p["Wv"]], 1).T).reshape(*ids.shape, d)
        dx[:, first:] += (dh + dq @ p["Wq"].T).reshape(q.shape)
        g["P"] = dx.sum(0)
        at = (ids.reshape(-1, 1) * d + np.arange(d)).ravel()
        g["E"] = np.bincount(at, dx.ravel(), p["E"].size).astype(dx.dtype).reshape(p["E"].shape)
        return loss, g

    def train(self, inputs: np.ndarray, targets: np.ndarray, valid: np.ndarray, steps: int, batch: int, lr: float, seed: int) -> list[float]:
        """Adam over seeded batches of windows; returns the losses."""
        r = np.random.default_rng(seed)
        adam, losses = Adam(self.p), []
        for t in range(1, steps + 1):
            at = r.integers(0, len(inputs), batch)
            loss, g = self.gradients(inputs[at], targets[at], valid[at])
            losses.append(loss)
            adam.step(g, lr * min(1.0, t / 20) * (1 - 0.9 * t / steps))
        return losses


class Adam:
    """Adam's moments of a model's parameters, which it changes in place."""

    def __init__(self, p: dict):
        self.p, self.t = p, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict, rate: float) -> None:
        self.t += 1
        up, root = rate / (1 - 0.9 ** self.t), 1 / math.sqrt(1 - 0.99 ** self.t)
        for k, p in self.p.items():
            m, v, x = self.m[k], self.v[k], g[k]
            m *= 0.9
            m += 0.1 * x
            v *= 0.99
            x = x * x
            x *= 0.01
            v += x
            np.sqrt(v, out=x)
            x *= root
            x += 1e-8
            np.divide(m, x, out=x)
            x *= up
            p -= x


def windows(ids: np.ndarray, targets: np.ndarray, context: int, stride: int, first: int = 0, every: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (w, context + stride), targets and validity (w, stride): window i
    scores positions i*stride .. and sees ``context`` positions before.  Of all
    windows, those numbered ``first``, ``first + every``, ..."""
    n = len(ids)
    w = -(-n // stride)
    x = np.zeros(context + w * stride, np.int32)
    x[context:context + n] = ids
    y, ok = np.zeros(w * stride, np.int32), np.zeros(w * stride, np.float32)
    y[:n], ok[:n] = targets, 1
    some = slice(first, None, every)
    at = np.arange(w)[some, None] * stride + np.arange(context + stride)
    return x[at], y.reshape(w, stride)[some], ok.reshape(w, stride)[some]


def places(sizes: np.ndarray, context: int, stride: int, first=0, every: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The windows of many texts of ``sizes`` tokens, as ``windows`` numbers them: the text of
    each window and the places in it (w, context + stride); those below 0 or past the end are padding."""
    w = -(-sizes // stride)
    count = np.maximum(-(-(w - first) // every), 0)
    text = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    number = number * every + np.broadcast_to(first, len(sizes))[text]
    return text, number[:, None] * stride + np.arange(-context, stride)


# ---- corpus statistics --------------------------------------------------------------------------------------------

def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts, one end token per text; counted inside each
    batch before the shuffle."""
    def run(batches):
        for b in batches:
            at, sizes, words = split_words(b["t"])
            yield pd.DataFrame({"word": [*words, END], "n": [*np.bincount(at, minlength=len(words)), len(sizes)]})
    return (docs.select(F.col(text).alias("t")).mapInPandas(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Words down to a count that at most ``most`` words reach.  The count comes
    from a small histogram (eight classes to each doubling), so no task sorts
    and no list of candidates per task goes to the driver."""
    step = F.floor(F.log2("n") * 8)
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        total += r["count"]
        if total > most:
            break
        least = r["s"]
    return counts.filter(F.lit(False)) if least is None else counts.filter(step >= least)


def subword_counts(counts: DataFrame, tokenizer: str, size: int) -> np.ndarray:
    """How many words of the corpus begin with each subword, from (word, n)."""
    def run(batches):
        f, n = _first_subword(tokenizer), np.zeros(size, np.int64)
        for b in batches:
            np.add.at(n, f.of(list(b["word"])), b["n"].to_numpy(np.int64))
        at = np.flatnonzero(n)
        yield pd.DataFrame({"s": at, "n": n[at]})
    got = (counts.filter(F.col("word") != F.lit(END)).mapInPandas(run, "s int, n long")
           .groupBy("s").agg(F.sum("n").alias("n")).toPandas())          # at most the vocabulary
    out = np.zeros(size, np.int64)
    out[got["s"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out


def near_counts(seqs: DataFrame, kind: str, row: np.ndarray, col: np.ndarray, n_row: int, n_col: int, reach: int) -> np.ndarray:
    """How often subword of number ``row`` stands within ``reach`` words of subword of
    number ``col``, over all sequences; -1 are left out."""
    shared = seqs.sparkSession.sparkContext.broadcast((row, col))

    def run(batches):
        r_of, c_of = shared.value
        near = np.zeros(n_row * n_col, np.int64)
        for b in batches:
            for i in range(0, len(b), 1000):
                part = [np.frombuffer(s, kind) for s in b["s"].iloc[i:i + 1000]]
                sizes = np.array([len(p) for p in part])
                # gaps of ``reach`` between texts, so that no text is near another
                at = np.arange(sizes.sum()) + np.repeat(np.arange(len(part)) * reach, sizes)
                r, c = (np.full(sizes.sum() + len(part) * reach, -1, np.int64) for _ in range(2))
                flat = np.concatenate(part)
                r[at], c[at] = r_of[flat], c_of[flat]
                for d in range(1, reach + 1):
                    for x, y in ((r[:-d], c[d:]), (r[d:], c[:-d])):
                        ok = (x >= 0) & (y >= 0)
                        near += np.bincount(x[ok] * n_col + y[ok], minlength=len(near))
        at = np.flatnonzero(near)
        yield pd.DataFrame({"k": at, "n": near[at]})
    got = seqs.select("s").mapInPandas(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(n_row * n_col, np.int64)
    out[got["k"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out.reshape(n_row, n_col)


def cluster_subwords(seqs: DataFrame, kind: str, count: np.ndarray, k: int, frequent: int = 4093, around: int = 128, reach: int = 3,
                     rounds: int = 15, seed: int = 2) -> np.ndarray:
    """Cluster of every subword id from which frequent subwords stand near it
    (k-means on square roots of shares); rare ids share the last cluster."""
    size = len(count)
    top = np.argsort(-count, kind="stable")
    top = top[count[top] > 0][:frequent]
    out = np.full(size, k - 1, np.int32)
    if len(top) < 2 * k:
        out[top] = np.arange(len(top)) % k
        return out
    row = np.full(size, -1, np.int64)
    row[top] = np.arange(len(top))
    col = np.full(size, -1, np.int64)
    col[top[:around]] = np.arange(min(around, len(top)))
    x = near_counts(seqs, kind, row, col, len(top), around, reach) + 0.01
    x = np.sqrt(x / x.sum(1, keepdims=True))
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), k - 1, replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ centre.T - 0.5 * (centre ** 2).sum(1), axis=1)
        for j in range(k - 1):
            if (own == j).any():
                centre[j] = x[own == j].mean(0)
    out[top] = own
    return out


class _Inputs:
    """Input ids and target classes of a text from its stored subword ids and
    classes of own words (-1: none)."""

    def __init__(self, kind: str, in_of_sub: np.ndarray, class_of_sub: np.ndarray):
        self.kind, self.in_of_sub, self.class_of_sub = kind, in_of_sub, class_of_sub

    def __call__(self, s: bytes, c: bytes) -> tuple[np.ndarray, np.ndarray]:
        sub, own = np.frombuffer(s, self.kind), np.frombuffer(c, np.int16)
        return np.concatenate([[BOS], self.in_of_sub[sub]]), np.append(np.where(own >= 0, own, self.class_of_sub[sub]), 0)      # class 0: the end

    def windows(self, s: list[bytes], c: list[bytes], context: int, stride: int, first: np.ndarray, every: int):
        """``windows`` of many texts, without those that are not asked for."""
        sub, own = np.frombuffer(b"".join([*s, bytes(8)]), self.kind), np.frombuffer(b"".join([*c, bytes(8)]), np.int16)
        words = np.array([len(x) for x in c]) // 2
        text, at = places(words + 1, context, stride, first, every)
        n, begin = words[text][:, None], (np.cumsum(words) - words)[text][:, None]
        x = np.where((at > 0) & (at <= n), self.in_of_sub[sub[np.clip(begin + at - 1, 0, len(own) - 1)]], np.where(at == 0, BOS, PAD)).astype(np.int32)
        at = at[:, context:]
        flat = np.minimum(begin + at, len(own) - 1)
        y = np.where(own[flat] >= 0, own[flat], self.class_of_sub[sub[flat]])
        return x, np.where(at < n, y, 0).astype(np.int32), (at <= n).astype(np.float32)


def train_round(net: Attention, seqs: DataFrame, inputs, which: int, every: int, stride: int, batch: int, lr: float, passes: int = 1,
                group_words: int = 150_000) -> int:
    """One pass over all sequences: each task trains a copy of the model on window
    ``which`` (shifted by the document) of every ``every`` windows, and the copies
    are averaged by windows, rows of E by how often the task saw the id.  Tasks
    return one row each, and these are added in two steps.  With ``passes`` (few
    windows, held by the task) each window is used so often.  Returns the windows."""
    spark = seqs.sparkSession
    context = net.window - stride
    names = sorted(net.p)
    shared = spark.sparkContext.broadcast((net, inputs))

    def train(batches):
        import copy
        start, use = shared.value
        mine = copy.copy(start)
        mine.p = {k: v.copy() for k, v in start.p.items()}
        adam, parts, waiting, total = Adam(mine.p), [], 0, 0
        seen, draw = np.zeros(len(mine.p["E"]), np.float64), np.random.default_rng(which)

        def steps(least):
            nonlocal parts, waiting, total
            if waiting < max(least, 1):
                return
            x, y, ok = (np.concatenate(z) for z in zip(*parts))
            order = np.concatenate([draw.permutation(len(x)) for _ in range(passes)])
            use = len(order) - (len(order) % batch if least > 1 else 0)
            for i in range(0, use, batch):
                j = order[i:min(i + batch, use)]
                late = (np.concatenate([np.zeros((len(j), context), z.dtype), z[j]], 1) for z in (y, ok))
                _, g = mine.gradients(x[j], *late)
                adam.step(g, lr * min(1.0, (adam.t + 1) / 20) * len(j) / batch)
                seen[:] += np.bincount(x[j].ravel(), minlength=len(seen))
            total += len(x) - len(order[use:])
            parts = [(x[order[use:]], y[order[use:]], ok[order[use:]])] if use < len(order) else []
            waiting = len(order) - use
        for b in batches:
            first = (b["h"].to_numpy() + which) % every
            s, c = b["s"].tolist(), b["c"].tolist()
            size = np.cumsum([len(x) // 2 + 1 for x in c])
            i = 0
            while i < len(c):       # texts of together about ``group_words``
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + group_words)))
                parts.append(use.windows(s[i:j], c[i:j], context, stride, first[i:j], every))
                waiting += len(parts[-1][0])
                if passes == 1 and waiting >= 20 * batch:
                    steps(batch)
                i = j
        steps(1)
        if total:
            moved = [((mine.p[k] - start.p[k]) * (seen[:, None] if k == "E" else total)).astype(np.float64).ravel() for k in names]
            yield pd.DataFrame({"n": [total], "v": [np.concatenate([*moved, seen]).tobytes()]})

    def add(batches):
        n, v = 0, 0.0
        for b in batches:
            n += int(b["n"].sum())
            v = v + sum(np.frombuffer(x, np.float64) for x in b["v"])
        if n:
            yield pd.DataFrame({"n": [n], "v": [v.tobytes()]})
    few = max(1, math.isqrt(seqs.rdd.getNumPartitions()))
    got = seqs.mapInPandas(train, "n long, v binary").repartition(few).mapInPandas(add, "n long, v binary").collect()
    total = sum(r["n"] for r in got)
    if total:
        v = np.sum([np.frombuffer(r["v"], np.float64) for r in got], axis=0)
        sizes = [net.p[k].size for k in names] + [len(net.p["E"])]
        *moved, seen = np.split(v, np.cumsum(sizes)[:-1])
        for k, x in zip(names, moved):
            x = x.reshape(net.p[k].shape) / (np.maximum(seen, 1)[:, None] if k == "E" else total)
            net.p[k] = (net.p[k] + x).astype(np.float32)
    return total


class Model:
    """Everything that scoring needs; bounded by head_words and the vocabulary."""

    def __init__(self, net, in_of_sub, class_of_sub, own_class, head, n_total, v_total, class_size, context, stride, tokenizer):
        self.net, self.in_of_sub, self.class_of_sub, self.own_class = net, in_of_sub, class_of_sub, own_class
        self.head, self.n_total, self.v_total, self.class_size = head, n_total, v_total, class_size
        self.context, self.stride, self.tokenizer = context, stride, tokenizer
        self.trained_windows = 0        # windows of the training documents that it was trained on
        self.uid = uuid.uuid4().hex


def fit(train: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json", head_words: int = 250_000,
        own_words: int = 32, clusters: int = 32, fit_documents: int = 0, d: int = 16, context: int = 8, stride: int = 24,
        steps: int = 400, batch: int = 96, lr: float = 0.02, rounds: int = 4, seed: int = 1) -> tuple[Model, DataFrame]:
    """The model and the table of counts (word, n)."""
    spark = train.sparkSession
    counts = written(word_counts(train, text), "lm-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()[0]
    n_total, v_total = total["n"] or 0, total["v"] or 0
    top = _most_frequent(counts, head_words).toPandas().sort_values(["n", "word"], ascending=[False, True])
    head = {w: int(n) for w, n in zip(top["word"], top["n"])}
    first = _first_subword(tokenizer)
    own = [END] + [w for w in list(head)[:own_words] if w != END][:own_words - 1]
    own_class = {w: i for i, w in enumerate(own)}

    # every training document as first subword ids and classes of its own words
    kind = "u2" if first.size <= 1 << 16 else "i4"

    def subwords(batches):
        f = _first_subword(tokenizer)
        for b in batches:
            at, sizes, words = split_words(b["t"])
            sub = f.of(words).astype(kind)[at] if words else at.astype(kind)
            cls = np.array([own_class.get(w, -1) for w in words], np.int16)[at] if words else at.astype(np.int16)
            cut = np.cumsum(sizes)[:-1]
            yield pd.DataFrame({"h": b["h"], "s": [x.tobytes() for x in np.split(sub, cut)], "c": [x.tobytes() for x in np.split(cls, cut)]})
    hashed = F.pmod(F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit("")), F.lit(seed)), F.lit(1 << 40))
    seqs = written(train.select(hashed.alias("h"), F.col(text).alias("t")).mapInPandas(subwords, "h long, s binary, c binary"), "lm-seqs")

    seen = subword_counts(counts, tokenizer, first.size)
    class_of_sub = cluster_subwords(seqs, kind, seen, clusters, seed=seed + 1) + len(own)
    n_class = len(own) + clusters
    in_of_sub = np.full(first.size, OTHER, np.int32)
    frequent = np.argsort(-seen, kind="stable")
    frequent = frequent[seen[frequent] > 1][:4093]
    in_of_sub[frequent] = np.arange(len(frequent)) + 3

    # size of each class over the whole table of counts
    shared = spark.sparkContext.broadcast((own_class, class_of_sub))

    def classes(batches):
        f = _first_subword(tokenizer)
        oc, cs = shared.value
        for b in batches:
            w = list(b["word"])
            c = [oc.get(v, int(cs[s])) for v, s in zip(w, f.of(w))]
            yield pd.DataFrame({"c": c, "n": b["n"], "v": 1}).groupby("c", as_index=False).sum()
    size = (counts.mapInPandas(classes, "c int, n long, v long").groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    class_size, share = np.ones(n_class, np.float64), np.ones(n_class, np.float64)
    for r in size:
        class_size[r["c"]] = r["n"] + r["v"] + 1
        share[r["c"]] = r["n"] + 1

    inputs = _Inputs(kind, in_of_sub, class_of_sub)
    net = Attention(3 + len(frequent), n_class, d, context + stride, seed)
    net.p["b"] = np.log(share / share.sum()).astype(np.float32)

    # if asked for, a start from a sample: at most fit_documents rows, copies of a text with keys of their own are rows like others
    ends = counts.filter(F.col("word") == F.lit(END)).collect()
    docs = ends[0]["n"] if ends else 0
    if fit_documents:
        share = min(1.0, max(1.2 * fit_documents, fit_documents + 50) / max(docs, 1))
        picked = seqs.filter(F.col("h") < math.ceil((1 << 40) * share)).orderBy("h", "s", "c").limit(fit_documents)
        got = picked.toPandas().sort_values(["s", "c"])
        parts = [windows(*inputs(s, c), context, stride) for s, c in zip(got["s"], got["c"])]
        if parts:
            x, y, ok = (np.concatenate(z) for z in zip(*parts))
            full_y = np.concatenate([np.zeros((len(x), context), np.int32), y], 1)
            full_ok = np.concatenate([np.zeros((len(x), context), np.float32), ok], 1)
            net.train(x, full_y, full_ok, steps, batch, lr, seed)

    # every window of every training document, each in one of the rounds; a copy is worth its place in the average after
    # about ``steps`` batches, so a corpus has no more tasks than that makes
    trained, least = 0, steps * batch * stride
    passes = max(1, -(-least // max(n_total, 1)))
    seqs = seqs.coalesce(max(1, n_total // least))
    for i in range(rounds if docs else 0):
        trained += train_round(net, seqs, inputs, i, rounds, stride, batch, lr * max(0.5 ** i, 0.1) * (0.25 if fit_documents else 1), passes)
    model = Model(net, in_of_sub, class_of_sub, own_class, head, n_total, v_total, class_size, context, stride, tokenizer)
    model.trained_windows = trained
    return model, counts


class _Scorer:
    """A model with what turns words into its inputs; one per worker."""

    def __init__(self, model: Model):
        self.m, self.first = model, _first_subword(model.tokenizer)
        self.log_class = np.log10(model.class_size)
        # columns of the head words, looked up once
        subs = self.first.of(list(model.head))
        self.place = {w: i for i, w in enumerate(model.head)}
        self.ids, self.cls = model.in_of_sub[subs], model.class_of_sub[subs].astype(np.int64)
        for w, c in model.own_class.items():
            if w in self.place:
                self.cls[self.place[w]] = c
        self.lc = np.log10(np.fromiter(model.head.values(), np.int64, len(subs)) + 1.0)

    def columns(self, words: list[str]):
        """Input id, class, log10 of count + 1 and whether the count is known, by
        word; the first word is the end."""
        m, at = self.m, np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        known = at >= 0
        ids, cls, lc = np.zeros(len(at), m.in_of_sub.dtype), np.zeros(len(at), np.int64), np.zeros(len(at))
        ids[known], cls[known], lc[known] = self.ids[at[known]], self.cls[at[known]], self.lc[at[known]]
        late = np.flatnonzero(~known)
        subs = self.first.of([words[i] for i in late.tolist()])
        ids[late], cls[late] = m.in_of_sub[subs], m.class_of_sub[subs]
        cls[0] = m.own_class[END]
        return ids, cls, lc, known

    def score(self, texts, group_words: int = 150_000) -> pd.DataFrame:
        at, sizes, words = split_words(texts)
        words = [END, *words]
        cols = self.columns(words)
        # an end after the words of each text
        full = np.zeros(len(at) + len(sizes), np.int64)
        full[np.arange(len(at)) + np.repeat(np.arange(len(sizes)), sizes)] = at + 1
        sizes = sizes + 1
        ends = np.cumsum(sizes)
        out, a = [], 0
        while a < len(sizes):
            begin = ends[a] - sizes[a]
            z = max(a + 1, int(np.searchsorted(ends, begin + group_words)))
            out.append(self._group(full[begin:ends[z - 1]], sizes[a:z], words, cols))
            a = z
        return pd.concat(out, ignore_index=True)

    def _group(self, at: np.ndarray, sizes: np.ndarray, words: list[str], cols, max_windows: int = 128) -> pd.DataFrame:
        m, n = self.m, len(sizes)
        ids, cls, lc, known = (c[at] for c in cols)
        first = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(n), sizes)

        def per_doc(x):
            return np.bincount(doc, weights=x, minlength=n)
        base = per_doc(lc) - sizes * math.log10(m.n_total + m.v_total + 1)
        word = per_doc(lc - self.log_class[cls])
        # rare words: each once per document, with its number there
        rare = np.flatnonzero(~known)
        u, k = np.unique(doc[rare] * len(words) + at[rare], return_counts=True)
        owner, which = np.divmod(u, len(words))
        cut = np.searchsorted(owner, np.arange(1, n))
        names = [words[i] for i in which.tolist()]
        lo = np.concatenate([[0], cut, [len(names)]]).tolist()
        # class probabilities
        of, pos = places(sizes, m.context, m.stride)
        begin, n_of = first[of][:, None], sizes[of][:, None]
        x = np.where((pos > 0) & (pos < n_of), ids[np.clip(begin + pos - 1, 0, len(ids) - 1)], np.where(pos == 0, BOS, PAD))
        pos = pos[:, m.context:]
        ok = pos < n_of
        y = cls[np.where(ok, begin + pos, 0)]
        ctx = np.zeros(n)
        for i in range(0, len(x), max_windows):
            j = slice(i, i + max_windows)
            lp = m.net.log_probs(x[j], y[j], m.context) * ok[j]
            ctx += np.bincount(of[j], weights=lp.sum(1, dtype=np.float64), minlength=n)
        return pd.DataFrame({"n_tokens": sizes, "n_known": per_doc(known).astype(np.int64), "base": base, "model": word + ctx / math.log(10),
                             "tail_w": pd.Series([names[a:z] for a, z in zip(lo, lo[1:])], dtype=object),
                             "tail_n": pd.Series(np.split(k, cut), dtype=object)})


_SCORERS: dict[str, _Scorer] = {}


def _scorer_of_worker(model: Model) -> _Scorer:
    if model.uid not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.uid] = _Scorer(model)
    return _SCORERS[model.uid]


def _score_batches(shared, rows: int = 3_000):
    def run(batches):
        s = _scorer_of_worker(shared.value)
        for b in batches:
            for i in range(0, len(b), rows):
                part = b.iloc[i:i + rows]
                yield s.score(part["t"]).assign(key=part["key"].to_numpy())
    return run


def score(df: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()
    part = written(df.select(F.col(key).alias("key"), F.col(text).alias("t"))
                   .mapInPandas(_score_batches(shared), f"n_tokens long, n_known long, base double, model double, "
                                                 f"tail_w array<string>, tail_n array<long>, key {kind}")
                   .withColumn("row", F.monotonically_increasing_id()), "lm-part")
    # rare words: their counts wherever they lie
    t = (part.select("row", F.explode(F.arrays_zip("tail_w", "tail_n")).alias("t"))
         .select("row", F.col("t.tail_w").alias("word"), F.col("t.tail_n").alias("k")))
    late = (t.join(counts, "word").groupBy("row")
            .agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("lc")))
    extra = F.coalesce("lc", F.lit(0.0))
    return (part.drop("tail_w", "tail_n").join(late, "row", "left")
            .select(F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
                    F.lit(model.n_total).cast("long").alias("train_tokens"),
                    (F.col("base") + extra).alias("base_score"), (F.col("model") + extra).alias("score")))
