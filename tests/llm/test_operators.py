"""Each operator against brute force on small texts, with nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import (causal_lm, decontaminate, langid, lsh_forest, mixture, quality_cascade, suffix_dedup, token_store,
                            toxicity, warc_store)
from ledgerlens.llm.graph import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lg, s, None if t is None else len(t)) for i, t, lg, s in rows], DOCS)


def prose(n, seed, words=("ka", "lo", "mi", "ne", "tu", "ré", "xo", "pa")):
    r = random.Random(seed)
    return " ".join("".join(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    base = [prose(n, n) for n in (60, 80, 120, 200, 400)]
    rows = [(i, t, "en" if i % 2 else "fr", "abc"[i % 3]) for i, t in enumerate(base)]
    near = base[3].split(" ")
    near[100] = "changed"
    rows += [(10, base[3], "en", "a"), (11, " ".join(near), None, None), (12, None, "en", "a"), (13, "", None, "b"),
             (14, " \t\n", "fr", "c"), (15, "one", "en", None), (16, "Two words", "en", "z"), (17, (prose(30, 7) + "\n") * 300, "fr", "a"),
             (18, "a" * 5000, "en", "b"), (19, "#*$%&|<> " * 80, "en", "b"), (20, "İstanbul ΣΑΣ \x00 日本語 " * 40, "en", "c")]
    return rows


# ---- 1 --------------------------------------------------------------------------------------------------------------

def brute_quality(t):
    w = WORD.findall(t or "")
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(win)
    cov = {j for i, g in enumerate(win) if c[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t or ""), len(lines) - len(set(lines)), len(cov))


def test_quality_statistics_and_verdict(spark, corpus):
    got = {r["doc_id"]: r for r in quality_cascade.statistics(frame(spark, corpus)).collect()}
    assert len(got) == len(corpus)
    for i, t, _, _ in corpus:
        r, want = got[i], brute_quality(t)
        assert tuple(r[1:6]) == want, i
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert got[3]["kept"] and not got[17]["kept"] and not got[19]["kept"] and not got[12]["kept"]


def test_quality_order_changes_no_verdict(spark, corpus):
    df = frame(spark, corpus).withColumn("rejected_by", F.lit("clash"))
    rules = quality_cascade.default_rules()
    cheap_last = [{"rule": r.name, "cost": 1.0 + k, "rejected": 0.1 * k} for k, r in enumerate(rules)]
    assert [r.name for r in quality_cascade.order_rules(rules, cheap_last)][0] == rules[-1].name
    a = quality_cascade.cascade(df, reason="why")
    b = quality_cascade.cascade(df, reason="why", measured=cheap_last)
    kept = lambda x: {r["doc_id"] for r in x.filter("why IS NULL").collect()}
    stats = quality_cascade.statistics(df)
    assert kept(a) == kept(b) == {r["doc_id"] for r in stats.filter("kept").collect()}
    clean = quality_cascade.keep_clean(df)
    assert clean.columns == df.columns and {r["doc_id"] for r in clean.collect()} == kept(a)


def test_quality_empty_table(spark, corpus):
    empty = frame(spark, corpus).limit(0)
    assert quality_cascade.statistics(empty).count() == 0 and quality_cascade.keep_clean(empty).count() == 0


def test_quality_native(spark, corpus):
    plan = quality_cascade.statistics(frame(spark, corpus))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- 2 --------------------------------------------------------------------------------------------------------------

def brute_segments(scores):
    """All maximal scoring segments by recursion on the best one."""
    def best(lo, hi):
        top, arg = 0.0, None
        for i in range(lo, hi):
            s = 0.0
            for j in range(i, hi):
                s += scores[j]
                if s > top + 1e-9 or (arg and abs(s - top) <= 1e-9 and j - i < arg[1] - arg[0] - 1):
                    top, arg = s, (i, j + 1)
        return arg
    out, todo = [], [(0, len(scores))]
    while todo:
        lo, hi = todo.pop()
        a = best(lo, hi)
        if a:
            out.append(a)
            todo += [(lo, a[0]), (a[1], hi)]
    return sorted(out)


def test_maximal_segments_match_brute_force():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(1, 25)
        hit = {i: r.choice([0.4, 1.1, 2.3]) + r.random() / 100 for i in range(n) if r.random() < 0.3}
        scores = [hit.get(i, toxicity.STEP_DOWN) for i in range(n)]
        got = toxicity.maximal_segments(list(hit), list(hit.values()))
        assert sorted((a, b) for a, b, _ in got) == brute_segments(scores)
        for a, b, s in got:
            assert s == pytest.approx(sum(scores[a:b]))


def toxic_corpus(spark, n=240):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        w = prose(60, 1000 + i).split(" ")
        y = i % 3 == 0
        if y:
            for p in sorted(r.sample(range(60), 5)):
                w[p] = r.choice(["idiot,", "Scum", "moron."])
        rows.append((i, " ".join(w), "en", "a"))
        labels.append((i, 1, int(y)))
    rows += [(n, None, "en", "a"), (n + 1, "", "en", "a"), (n + 2, "idiot scum moron " * 3, None, None)]
    labels += [(n, 1, None), (n + 1, 1, 0), (999_999, 1, 1)]
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = toxic_corpus(spark)
    m = toxicity.fit(docs, labels.filter("doc_id % 4 <> 0"))
    out = {r["doc_id"]: r for r in toxicity.score(docs.withColumn("score", F.lit("x")), m).collect()}
    y = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in range(240) if i % 4 == 0]
    assert sum((out[i]["predicted"] == y[i]) for i in held) >= 0.97 * len(held)
    assert out[240]["predicted"] == 0 and out[241]["score"] == out[240]["score"] and out[242]["predicted"] == 1
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for p in out[0]["passages"]:
        assert re.search("idiot|scum|moron", text[0][p["char_start"]:p["char_end"]].lower())
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_toxicity_pools_the_endings_of_a_stem(spark):
    r = random.Random(9)
    rows, labels = [], []
    ends = ["", "a", "est", "ito", "ung", "os", "enter", "iqua", "zela", "orum", "ade", "ifi", "ol", "ur"]
    for i in range(400):
        lang, stem = (("x", "grunz"), ("y", "malv"))[i % 2]
        w = prose(80, 5000 + i).split(" ")
        y = (i // 2) % 4 == 0
        for p in r.sample(range(80), 7 if y else r.choice([0, 0, 0, 1])):      # clean texts hold the stem too, but once
            w[p] = stem + r.choice(ends) + r.choice(ends)
        rows.append((i, " ".join(w), lang, "a"))
        labels.append((i, 1, int(y)))
    m = toxicity.fit(frame(spark, rows), spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, quality int, toxic int"))
    assert {b"grunz*", b"malv*"} <= set(m.terms)
    got = {x["doc_id"]: x["predicted"] for x in toxicity.score(frame(spark, rows), m).collect()}
    for lang in (0, 1):
        held = [(i, y) for i, _, y in labels if i % 5 == 0 and i % 2 == lang]
        assert sum(got[i] for i, y in held if y) >= 0.9 * sum(y for _, y in held)
        assert sum(got[i] for i, y in held if not y) <= 0.05 * sum(1 - y for _, y in held)


def test_toxicity_lambda_solves_the_whole_distribution():
    clean = pd.DataFrame({"y": 0, "n": [5000, 4999], "hits": [30, 3], "sum": [42.0, 8.0], "scores": [[1.0, 7.0], [1.0, 6.0]],
                          "counts": [[28, 2], [2, 1]], "segments": [[1.0, 7.0], [6.0]]})
    lam, k = toxicity.calibrate(clean, np.array([1.0, 6.0, 7.0, 2.0]))
    hits = {1.0: 30.125, 6.0: 1.125, 7.0: 2.125, 2.0: 0.125}
    p = {s: c / 10_000 for s, c in hits.items()} | {toxicity.STEP_DOWN: 1 - sum(hits.values()) / 10_000}
    assert lam > 0 and sum(v * np.exp(lam * s) for s, v in p.items()) == pytest.approx(1, abs=1e-6)


def test_toxicity_without_labels(spark):
    docs, labels = toxic_corpus(spark, 12)
    m = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, m).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), m).count() == 0


# ---- 3 --------------------------------------------------------------------------------------------------------------

def test_causal_lm_gradients():
    net = causal_lm.Attention(12, 5, 4, 6, seed=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    ids, y = r.integers(1, 12, (3, 6)), r.integers(0, 5, (3, 6))
    ids[0, :2] = causal_lm.PAD
    ok = (r.random((3, 6)) < 0.8).astype(float)
    ok[0, :2] = 0
    _, g = net.gradients(ids, y, ok)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for j in r.choice(len(flat), 3):
            old = flat[j]
            flat[j] = old + 1e-5
            up, _ = net.gradients(ids, y, ok)
            flat[j] = old - 1e-5
            down, _ = net.gradients(ids, y, ok)
            flat[j] = old
            assert g[name].reshape(-1)[j] == pytest.approx((up - down) / 2e-5, abs=2e-5), name


def test_causal_lm_is_causal_and_windows_cover_once():
    net = causal_lm.Attention(20, 6, 8, 10, seed=1)
    ids = np.random.default_rng(1).integers(3, 20, (1, 10))
    y = np.zeros((1, 8), np.int64)
    a = net.log_probs(ids, y, 2)
    ids2 = ids.copy()
    ids2[0, 7:] = 5
    assert np.allclose(a[0, :5], net.log_probs(ids2, y, 2)[0, :5], atol=1e-6)
    for n in (1, 8, 9, 16, 50):
        x, t, ok = causal_lm.windows(np.arange(n) + 3, np.arange(n), 4, 8)
        assert t[ok > 0].tolist() == list(range(n)) and x.shape[1] == 12
        assert (x[:, 4:][ok > 0] - 3).tolist() == list(range(n))


def test_causal_lm_scores(spark, corpus):
    # two vocabularies: what stands before tells which words may follow
    lexicon = [prose(40, 1, ("ka", "lo", "mi")).split(" "), prose(40, 2, ("schu", "ber", "en")).split(" ")]
    r = random.Random(6)
    rows = corpus + [(100 + i, " ".join(r.choice(lexicon[i % 2]) for _ in range(100)), "en", "a") for i in range(40)]
    docs = frame(spark, rows)
    train = docs.filter("doc_id % 5 <> 0")
    model, counts = causal_lm.fit(train, head_words=40, own_words=8, clusters=6, steps=120)
    out = {r["doc_id"]: r for r in causal_lm.score(docs, model, counts).collect()}
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    c = Counter()
    for i, t, _, _ in rows:
        if i % 5:
            c.update(WORD.findall(low(t)) + [None])
    n_all, v = sum(c.values()), len(c)
    for i, t, _, _ in rows:
        w = WORD.findall(low(t)) + [None]
        r = out[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n_all)
        assert r["base_score"] == pytest.approx(sum(np.log10((c[x] + 1) / (n_all + v + 1)) for x in w), rel=1e-9)
        assert np.isfinite(r["score"]) and r["score"] < 0
    held = [out[i] for i, *_ in rows if i >= 100 and i % 5 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # the classes' word probabilities and the class probabilities each sum to one
    assert model.class_size.sum() >= n_all


def test_causal_lm_is_fitted_on_every_document(spark):
    """Input ids, classes and training windows follow the corpus, not the sample that training starts from."""
    lexicon = [prose(40, 1, ("ka", "lo", "mi")).split(" "), prose(40, 2, ("schu", "ber", "en")).split(" ")]
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(lexicon[i % 2]) for _ in range(300)), "en", "a") for i in range(80)]
    small = dict(head_words=40, own_words=4, clusters=6, fit_documents=1, steps=2)
    model, _ = causal_lm.fit(frame(spark, rows), **small)
    half, _ = causal_lm.fit(frame(spark, rows[:40]), **small)
    first = causal_lm.FirstSubword(model.tokenizer)
    c = Counter(w for _, t, _, _ in rows for w in t.split(" "))
    subs = Counter()
    for s, w in zip(first.of(list(c)), c):
        subs[int(s)] += c[w]
    assert all((model.in_of_sub[s] != causal_lm.OTHER) == (n > 1) for s, n in subs.items())
    # neighbours of a brute-force count
    seqs = [first.of(t.split(" ")) for _, t, _, _ in rows[:5]]
    row = np.full(first.size, -1, np.int64)
    row[list(subs)] = np.arange(len(subs))
    want = np.zeros((len(subs), len(subs)), np.int64)
    for s in seqs:
        for i in range(len(s)):
            for j in range(max(0, i - 3), min(len(s), i + 4)):
                want[row[s[i]], row[s[j]]] += i != j
    df = spark.createDataFrame([(s.astype("u2").tobytes(),) for s in seqs], "s binary").repartition(3)
    assert (causal_lm.near_counts(df, "u2", row, row, len(subs), len(subs), 3) == want).all()
    # windows: two of eight of the 13 windows of each document
    assert model.trained_windows > 80 * 2 and model.trained_windows == pytest.approx(2 * half.trained_windows, rel=0.1)


def test_causal_lm_is_trained_on_every_window(spark):
    """No start from a sample, no window left out: each is in exactly one of the rounds."""
    rows = [(i, prose(20 + 13 * (i % 9), i), "en", "a") for i in range(60)] + [(100, None, "en", "a"), (101, "", "en", "a")]
    model, _ = causal_lm.fit(frame(spark, rows), head_words=40, own_words=4, clusters=6, steps=1)
    sizes = [len(WORD.findall(t or "")) + 1 for _, t, _, _ in rows]
    assert model.trained_windows == sum(-(-n // model.stride) for n in sizes)


def test_causal_lm_windows_of_a_share_are_disjoint():
    ids, y = np.arange(50) + 3, np.arange(50)
    parts = [causal_lm.windows(ids, y, 4, 8, i, 3) for i in range(3)]
    assert sorted(np.concatenate([t[ok > 0] for _, t, ok in parts]).tolist()) == y.tolist()


def test_causal_lm_empty(spark, corpus):
    docs = frame(spark, corpus)
    model, counts = causal_lm.fit(docs.limit(0), steps=2)
    out = causal_lm.score(docs, model, counts)
    assert out.count() == len(corpus) and causal_lm.score(docs.limit(0), model, counts).count() == 0


# ---- 4 --------------------------------------------------------------------------------------------------------------

def norm(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(t, items, window=10):
    w, hit, ids = norm(t), set(), set()
    for item, text in items:
        v = norm(text)
        k = min(window, len(v))
        for i in range(len(v) - k + 1 if v else 0):
            for p in range(len(w) - k + 1):
                if w[p:p + k] == v[i:i + k]:
                    hit.update(range(p, p + k))
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block_bytes", [4 << 20, 300])
def test_decontaminate_matches_brute_force(spark, block_bytes):
    r = random.Random(9)
    vocab = ["a", "b", "Cé", "dd", "e5"]
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 3, 9, 10, 11, 14, 25, 40])))) for k in range(14)]
    items = [x for x in items if len(x[1].split()) not in (1,)] + [(50, "x1, y2. Z3"), (51, None), (50, "x1 y2 z3")]
    docs = [(i, "; ".join(r.choice(vocab) for _ in range(60)).upper() if i % 2 else prose(50, i), "en", "a") for i in range(20)]
    long_item = next(t for _, t in items if t and len(t.split()) >= 25)
    docs += [(30, "see " + long_item[3:].replace(" ", " - ") + " end", "en", "a"), (31, None, None, None), (32, "", None, None),
             (33, "X1... y2\nz3", None, None)]
    b = spark.createDataFrame(items, "item_id int, text string")
    got = {x["doc_id"]: x for x in decontaminate.digest(frame(spark, docs), b, block_bytes=block_bytes).collect()}
    for i, t, _, _ in docs:
        n, h, ids = brute_hits(t, items)
        x = got[i]
        assert (x["n_words"], x["n_hit"], x["n_items"], x["contaminated"]) == (n, h, len(ids), h > 0), i
        assert x["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()
    full = decontaminate.scan(frame(spark, docs), b).filter("doc_id = 33").first()
    assert [docs[-1][1][s["char_start"]:s["char_end"]] for s in full["dc_spans"]] == ["X1... y2\nz3"]


def test_decontaminate_without_items_and_rows(spark, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, corpus)
    assert decontaminate.drop_contaminated(docs, none).count() == len(corpus)
    some = spark.createDataFrame([(1, corpus[0][1])], "item_id long, text string")
    clean = decontaminate.drop_contaminated(docs.withColumn("t", F.lit(1)).withColumn("items", F.lit(2)), some)
    assert clean.count() == len(corpus) - 1 and clean.columns == docs.columns + ["t", "items"]
    assert decontaminate.digest(docs.limit(0), some).count() == 0


# ---- 5 --------------------------------------------------------------------------------------------------------------

def test_langid(spark):
    words = {"aa": ("the", "and", "with", "tion"), "bb": ("der", "und", "nicht", "ß"), "cc": ("que", "ción", "los", "ñ")}
    rows = [(k * 1000 + i, prose(12, k * 1000 + i, w), lg, "s") for k, (lg, w) in enumerate(words.items()) for i in range(60)]
    train = frame(spark, rows + [(9000, "xx yy", None, None), (9001, None, "aa", "s")])
    m = langid.fit(train, rows_per_language=40)
    assert m.langs == ["aa", "bb", "cc"] and m.code.shape == (3, 3)
    test = [(k * 1000 + 500 + i, prose(12, 77_000 + k * 1000 + i, w), lg, "s") for k, (lg, w) in enumerate(words.items()) for i in range(30)]
    out = {r["doc_id"]: r for r in langid.predict(frame(spark, test + [(1, None, None, None), (2, "12 ... 5", None, None), (3, "", "aa", None)]), m).collect()}
    assert np.mean([out[i]["lang_pred"] == lg for i, _, lg, _ in test]) >= 0.97
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (1, 2, 3))
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_samples_hold_their_bound_with_copies(spark, monkeypatch):
    """Copies of one text are neither taken whole nor left out whole."""
    copy = "the and with tion"
    rows = [(i, copy, "aa", "s") for i in range(300)] + [(1000 + i, prose(12, i, ("der", "und", "ß")), "bb", "s") for i in range(30)]
    rows += [(5000, "que los", "cc", "s")] * 200                # one key and text
    fitted = []
    train = langid.train
    monkeypatch.setattr(langid, "train", lambda x, y, **kw: fitted.append(Counter(y)) or train(x, y, **kw))
    langid.fit(frame(spark, rows), rows_per_language=20)
    assert fitted == [{"aa": 20, "bb": 20, "cc": 20}]
    windows = []
    step = causal_lm.Attention.train
    monkeypatch.setattr(causal_lm.Attention, "train", lambda net, x, *a: windows.append(len(x)) or step(net, x, *a))
    causal_lm.fit(frame(spark, rows[:300]), fit_documents=20, steps=1, own_words=4, clusters=4)
    assert windows == [20]


def test_langid_codes_and_few_labels(spark, corpus):
    for k in (2, 3, 4, 6, 9, 20):
        code = langid.codewords(k)
        d = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert min(d) >= (1 if k == 2 else 2 if k <= 3 else 4)
    docs = frame(spark, corpus)
    none = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    one = langid.fit(docs.filter("lang = 'en'"))
    assert {r["lang_pred"] for r in langid.predict(docs, one).collect()} == {"en", "und"}


# ---- 6 --------------------------------------------------------------------------------------------------------------

def brute_removed(texts, length):
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        m = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                m[i:i + length] = True
        kept = bytes(c for c, x in zip(b, m) if not x)
        out.append((len(b), int(m.sum()), int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order_is_the_suffix_array():
    r = random.Random(2)
    for _ in range(200):
        s = np.array([r.randint(1, 3) for _ in range(r.randint(1, 70))])
        assert suffix_dedup.suffix_order(s, 1000).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("kw", [{}, {"hot_contexts": 1, "bloom_bytes": 1024}, {"positions": 50}])
def test_suffix_dedup_matches_brute_force(spark, kw):
    r = random.Random(4)
    passage, other = prose(12, 1), prose(9, 2)
    rows = []
    for i in range(24):
        t = prose(25, 100 + i)
        if i % 3 == 0:
            t = t[:37] + passage + t[37:]
        if i % 4 == 0:
            t = t[:90] + other[: r.randint(20, len(other))] + t[90:]
        rows.append((i, t, "en", "a"))
    rows += [(30, rows[5][1], "en", "a"), (30, rows[5][1], "en", "a"), (31, None, None, None), (32, "", None, None), (33, "z" * 90, None, None),
             (34, "ab" * 60, None, None), (35, "short", None, None), (36, (prose(6, 3) + "\n") * 7, None, None), (37, "é" * 50, None, None)]
    got = suffix_dedup.removed_spans(frame(spark, rows), length=40, with_spans=True, **kw).collect()
    want = Counter((i, *b) for (i, *_), b in zip(rows, brute_removed([(t or "").encode() for _, t, _, _ in rows], 40)))
    assert Counter(tuple(x)[:5] for x in got) == want
    for x in got:
        assert sum(s["z"] - s["a"] for s in x["removed"]) == x["n_removed"] and len(x["removed"]) == x["n_spans"]


def test_suffix_dedup_pieces(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    raw = prose(80, 5).encode()
    starts = []
    for p, piece in suffix_dedup._pieces(raw, 40):
        _, first, last, _, _ = suffix_dedup.Anchors(40).of(piece)
        for a, b in zip(first + p, last + p):
            starts += range(a, b + 1)
    assert starts == list(range(len(raw) - 39))
    assert suffix_dedup.removed_spans(frame(spark, [(1, "x", None, None)]).limit(0)).count() == 0


# ---- 7 --------------------------------------------------------------------------------------------------------------

def brute_groups(rows, shingle, percent):
    sets = {}
    for i, t, _, _ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(shingle, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows(seed, groups=6):
    r = random.Random(seed)
    rows, k = [], 0
    for g in range(groups):
        base = prose(70, seed * 100 + g).split(" ")
        for _ in range(r.choice([1, 2, 5, 12])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                w[r.randrange(len(w))] = r.choice(["new", "odd", "more"])
            rows.append((k, " ".join(w), "en", "a"))
            k += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"block": 3}), (3, {"block": 1})])
def test_lsh_forest_matches_brute_force(spark, corpus, seed, kw):
    rows = near_rows(seed) + [(1000 + i, t, lg, s) for i, t, lg, s in corpus]
    got = {r["doc_id"]: r for r in lsh_forest.link(frame(spark, rows), shingle=3, percent=85, **kw).collect()}
    want = brute_groups(rows, 3, 85)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


@pytest.mark.parametrize("parts", ["1", "7"])
def test_lsh_neighbours_match_sorted_orders(spark, parts):
    r = random.Random(5)
    rows = [(i, t, b"".join(r.choice([1, 1, 1, 70000]).to_bytes(4, "big") for _ in range(6))) for i in range(300) for t in range(3)]
    rows += [(300 + i, 0, b"\0\0\0\1" * 6) for i in range(200)]            # one path of a third of its order
    want = []
    for t in range(3):
        s = sorted((p, i) for i, k, p in rows if k == t)
        for (p, i), (q, j) in zip(s, s[1:]):
            n = next((d for d in range(6) if p[4 * d:4 * d + 4] != q[4 * d:4 * d + 4]), 6)
            want += [(i, j, n)] if n >= 2 else []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = spark.createDataFrame(rows, "id long, tree int, path binary")
        got = [tuple(x) for x in lsh_forest.neighbours(order, 2, 6).select("a", "b", "common").collect()]
        assert sorted(got) == sorted(want)
        assert lsh_forest.neighbours(order.limit(0), 2, 6).count() == 0
        near = spark.createDataFrame(want, "a long, b long, common int")
        best = {(x["a"], x["b"]) for x in lsh_forest._longest(near).collect()}
        want_best = set()
        for me, other in ((0, 1), (1, 0)):
            top = {}
            for w in want:
                top[w[me]] = max(top.get(w[me], (0, -1)), (w[2], w[other]))
            want_best |= {(min(i, j), max(i, j)) for i, (_, j) in top.items()}
        assert best == want_best
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_lsh_forest_null_keys(spark):
    a, b = prose(60, 1), prose(60, 2)
    df = spark.createDataFrame([(None, a), (4, a), (3, a), (None, b), (None, b), (9, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in lsh_forest.link(df).collect()), key=str)
    assert got == sorted([(None, 3, False), (4, 3, False), (3, 3, True), (None, None, True), (None, None, True), (9, 9, True)], key=str)


def test_lsh_forest_repeated_keys_and_empty(spark, corpus):
    rows = corpus + corpus[:2]
    out = lsh_forest.link(frame(spark, rows).withColumn("n", F.lit(1)).withColumn("sig", F.lit(2)))
    assert out.count() == len(rows)
    df = frame(spark, corpus)
    kept = lsh_forest.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in brute_groups(corpus, 5, 80).items() if i == c}
    assert lsh_forest.link(df.limit(0)).count() == 0 and lsh_forest.drop_near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    e = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (7, 7)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 103: 100, 101: 100}


# ---- 8 --------------------------------------------------------------------------------------------------------------

def test_warc_round_trip(spark):
    pages = [(1, "http://a", "<p>x</p>"), (2, "http://b\r\nX: y", "<p>x</p>"), (3, None, None), (9, "http://c", ""), (5, "u", "é" * 3000),
             (7, "http://d", "<p>x</p>"), (7, "http://d", "<p>x</p>"), (None, "n", "only"), (11, "k", "WARC-Type: revisit\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha1", F.lit("clash"))
    got = Counter(tuple(r) for r in warc_store.archive(df).collect())
    top = {}
    for i, _, h in pages:
        top[h or ""] = max([x for x in (top.get(h or ""), i) if x is not None], default=None)
    want = Counter()
    for i, _, h in pages:
        b = (h or "").encode()
        same = i == top[h or ""]
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if same else "revisit", None if same else top[h or ""])] += 1
    assert got == want


def test_warc_records_and_tampering(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "same"), (2, "http://b", "same"), (3, "http://c", "other")], "page_id long, url string, html string")
    path = warc_store.write(df, str(tmp_path / "w"))
    assert spark.read.parquet(f"{path}/payload").count() == 2
    rec = sorted(bytes(r["record"]) for r in warc_store.read_records(spark, path).collect())
    assert sum(r.endswith(b"\r\n\r\nsame\r\n\r\n") for r in rec) == 1 and sum(b"WARC-Type: revisit" in r for r in rec) == 1
    assert all(r.startswith(b"WARC/1.1\r\n") for r in rec)
    bad = spark.read.parquet(f"{path}/payload").withColumn("payload", F.lit(b"changed"))
    with pytest.raises(Exception, match="stored payload differs"):
        warc_store._verified(bad).collect()
    small = warc_store.write(df, str(tmp_path / "m"), min_bytes=100)
    assert {r["record_type"] for r in warc_store.describe(warc_store.read_records(spark, small)).collect()} == {"response"}
    assert warc_store.archive(df.limit(0)).count() == 0


# ---- 9 --------------------------------------------------------------------------------------------------------------

def test_token_store_matches_tokenizer(spark, corpus, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus + [(40, "a<|endoftext|>b  c d e\x85f don't é", None, None), (-3, "first", None, None)]
    rows = sorted(rows)
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t, _, _ in rows}
    path = token_store.write(frame(spark, rows), str(tmp_path / "s"), block_ids=500, keys_per_segment=7)
    got = {r["key"]: r for r in token_store.fetch(spark, path, frame(spark, rows), ids=True).collect()}
    at = 0
    for i, *_ in rows:
        r = got[str(i)]
        assert r["ids"] == ids[i] and r["start"] == at and r["n_tokens"] == len(ids[i])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[i], "<u4").tobytes())
        at += len(ids[i])
    some = spark.createDataFrame([(3,), (17,), (12345,)], "doc_id long")
    assert {r["key"] for r in token_store.fetch(spark, path, some).collect()} == {"3", "17"}


@pytest.mark.parametrize("ascii_only", [True, False])
def test_token_store_slices_of_a_batch(spark, tmp_path, ascii_only):
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = ("Ka", "lo", "MI", "ne") if ascii_only else ("Ka", "ló", "mß", "日本")
    texts = [prose(7 + i % 5, i, words) for i in range(200)] + [None, ""]
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    enc = token_store.WordEncoder("word_bpe_49k.json")
    for arr in (pa.array(texts), pa.array(texts, pa.large_string())):
        for off, n in ((0, 202), (1, 50), (100, 50), (150, 52)):
            ids, at = enc.encode(arr.slice(off, n))
            assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == want[off:off + n]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    path = token_store.write(frame(spark, rows), str(tmp_path / "b"), block_ids=300, batch_bytes=300)
    got = {int(r["key"]): r["ids"] for r in token_store.fetch(spark, path, frame(spark, rows), ids=True).collect()}
    assert [got[i] for i in range(202)] == [w + [1] for w in want]


def test_token_store_keyed_read_decodes_its_blocks_only(spark, tmp_path):
    rows = [(i // 40 if 80 <= i < 120 else i, prose(30, i), None, None) for i in range(200)]     # key 2: 41 rows over many blocks
    path = token_store.write(frame(spark, rows), str(tmp_path / "k"), block_ids=200, keys_per_segment=9)
    asked = spark.createDataFrame([(2,), (150,)], "doc_id long")
    found = token_store.lookup(spark, path, asked)
    blocks = token_store._blocks_of(spark, path, found).collect()
    every = spark.read.parquet(f"{path}/blocks").collect()
    span = {r["key"]: (r["doc"], r["doc"] + r["copies"]) for r in found.collect()}
    want = {(b["shard"], b["block"]) for b in every for lo, hi in span.values() if b["first_doc"] < hi and b["first_doc"] + b["docs"] > lo}
    assert {tuple(b) for b in blocks} == want and len(want) < len(every)
    assert Counter(r["key"] for r in token_store.fetch(spark, path, asked).collect()) == {"2": 41, "150": 1}


def test_token_store_repeated_keys_and_empty(spark, corpus):
    rows = corpus[:4] + [corpus[1], (1, "other text", None, None), (None, "no key", None, None)]
    df = frame(spark, rows).withColumn("start", F.lit(1))
    out = token_store.encode_documents(df).collect()
    assert len(out) == len(rows) and Counter(r["doc_id"] for r in out)[1] == 3
    starts = sorted((r["start"], r["n_tokens"]) for r in out)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert [r["doc_id"] for r in sorted(out, key=lambda r: r["start"])][0] is None
    assert token_store.encode_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("m", [1, 2, 5, 63, 1000, 20_000])
def test_perfect_hash_is_minimal(m):
    r = np.random.default_rng(m)
    h1, h2 = r.integers(0, 1 << 63, m, dtype=np.uint64), r.integers(0, 1 << 63, m, dtype=np.uint64)
    with np.errstate(over="ignore"):
        seeds, slots = token_store.perfect_hash(h1, h2)
        again = token_store._slots(h1, h2, seeds[(h2 % np.uint64(len(seeds))).astype(np.int64)], m)
    assert sorted(slots) == list(range(m)) and (again == slots).all()


# ---- 10 -------------------------------------------------------------------------------------------------------------

def brute_targets(sizes, share=1.5, cap=2, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        t = {s: w[s] * left / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **t}
        for s in over:
            fixed[s] = cap * sizes[s]
            left -= fixed[s]


@pytest.mark.parametrize("rows_per_bucket", [20_000, 2])
def test_mixture(spark, rows_per_bucket):
    r = random.Random(8)
    rows = [(i, prose(r.randint(0, 60) or 1, i) if i % 17 else None, None, r.choice(["a", "a", "a", "B", "é", "zz", None, "q"])) for i in range(300)]
    df = frame(spark, rows).withColumn("size", F.lit("clash")).withColumn("target", F.lit(0))
    out = [x.asDict() for x in mixture.mix(df, rows_per_bucket=rows_per_bucket).collect()]
    size = {i: len(WORD.findall(t or "")) for i, t, _, _ in rows}
    src = {i: s for i, _, _, s in rows}
    per = Counter()
    for i in size:
        per[src[i]] += size[i]
    want = brute_targets(per)
    took = Counter()
    for x in out:
        i = x["doc_id"]
        assert (x["size"], x["source_size"]) == (size[i], per[src[i]]) and x["target"] == pytest.approx(want[src[i]])
        assert 0 <= x["taken"] <= 2 * x["size"]
        took[src[i]] += x["taken"]
    assert all(abs(took[s] - want[s]) <= 1 for s in per) and len(out) == len(rows)
    again = mixture.mix(df.repartition(7)).collect()
    assert {(x["doc_id"], x["taken"]) for x in again} == {(x["doc_id"], x["taken"]) for x in out}
    mixed = mixture.apply_mix(df)
    assert mixed.columns == df.columns
    words = Counter()
    for x in mixed.collect():
        words[x["source"]] += len(WORD.findall(x["text"] or ""))
    assert all(words[s] == took[s] for s in per)


def test_mixture_edges(spark, corpus):
    df = frame(spark, corpus)
    assert mixture.mix(df.limit(0)).count() == 0 and mixture.apply_mix(df.limit(0)).count() == 0
    blank = frame(spark, [(1, None, None, "a"), (2, "", None, None)])
    assert {(x["size"], x["taken"], x["target"]) for x in mixture.mix(blank).collect()} == {(0, 0, 0.0)}
    twice = df.unionByName(df)
    assert mixture.mix(twice).count() == 2 * len(corpus)
    plan = mixture.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
