"""Merkle manifest, divergence audit and packing against brute force, with
nulls, empty and long texts, ties, repeated rows, empty tables and clashing
columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import divergence, merkle, packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lg, s, None if t is None else len(t)) for i, t, lg, s in rows], DOCS)


def prose(n, seed, words=("ka", "lo", "mi", "ne", "tu", "ré", "xo", "pa")):
    r = random.Random(seed)
    return " ".join("".join(r.choice(words) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rows = [(i, prose(5 + i * 3, i % 17), ("en", "fr", "de")[i % 3], ("a", "b", "hot", "hot", "hot", "é")[i % 6]) for i in range(90)]
    rows += [(200, None, None, None), (201, "", "en", None), (202, " \n", "en", "z"), (203, "Línea una\nlínea DOS\n" * 400, "es", "hot"),
             (3, "same key, other text", "en", "hot"), (5, rows[5][1], "de", "é"), (None, "no key\n", "fr", "b"), (204, "solo", "xx", "only")]
    return rows + [rows[1]] * 5


# ---- 11 -------------------------------------------------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(leaves):
    """Root, and per leaf the (left, right) siblings on its path."""
    at, paths = list(range(len(leaves))), [[] for _ in leaves]
    level = list(leaves)
    while len(level) > 1:
        for j, a in enumerate(at):
            lo = a - a % 3
            paths[j].append(("".join(level[lo:a]), "".join(level[a + 1:lo + 3])))
            at[j] = a // 3
        level = [H(*level[k:k + 3]) for k in range(0, len(level), 3)]
    return level[0], paths


def brute_manifest(rows):
    by = defaultdict(list)
    for i, t, lg, s in rows:
        by[s].append((i, brute_leaf((i, s, lg, None if t is None else len(t), t))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = brute_tree([h for _, h in by[s]])
    root, over = brute_tree([trees[s][0] for s in order])
    return sorted((str(i), h, trees[s][0], root, tuple(trees[s][1][k] + over[j]))
                  for j, s in enumerate(order) for k, (i, h) in enumerate(by[s]))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("step", [1, 2, 3])
def test_manifest_matches_brute_force(spark, corpus, step):
    df = frame(spark, corpus).withColumn("leaf", F.lit("clash")).withColumn("h", F.lit(1))
    m = merkle.manifest(df, FIELDS, step=step, carry={"c": F.col("n_chars")})
    got = m.withColumn("ok", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert all(r["ok"] == r["root"] for r in got)
    assert sorted((str(r["key"]), r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["proof"])) for r in got) == brute_manifest(corpus)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_manifest_of_every_shape(spark, n):
    rows = [(i, f"t{i}", "en", "s" if i % 4 else "r") for i in range(n)]
    got = merkle.manifest(frame(spark, rows), FIELDS).collect()
    assert sorted((str(r["key"]), r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["proof"])) for r in got) == brute_manifest(rows)


def test_manifest_finds_tampering_and_takes_no_rows(spark, corpus):
    df = frame(spark, corpus)
    changed = merkle.leaf_hash([F.translate("text", "\n", "") if c == "text" else F.col(c) for c in FIELDS])
    m = merkle.manifest(df, FIELDS, carry={"other": changed}).withColumn("r", merkle.fold(F.col("other"), F.col("proof")))
    bad = {r["key"] for r in m.filter("r <> root").collect()}
    assert bad == {i for i, t, _, _ in corpus if t and "\n" in t}
    assert merkle.manifest(df.limit(0), FIELDS).count() == 0


# ---- 12 -------------------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, top=200):
    groups, df, occ = set(), defaultdict(Counter), defaultdict(Counter)
    for _, t, lang, s in rows:
        w = TERM.findall((t or "").translate(LOWER))
        groups.add((lang or "", s or ""))
        df[lang or ""].update(set(w))
        occ[lang or "", s or ""].update(w)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for w, n in df[lang].items() if n >= 3]
        mine = sorted(s for g, s in groups if g == lang)
        total = Counter()
        for s in mine:
            total.update(occ[lang, s])

        def prices(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 1) // (n + len(kept)) for w in kept}
        p = {s: prices(occ[lang, s]) for s in mine}
        q = prices(total)
        for s in mine:
            pair = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o) for o in mine if o != s]
            term = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if occ[lang, s][w] and p[s][w] > q[w]]
            for part, x in (("pair", pair), ("term", term)):
                x.sort(key=lambda y: (-y[0], y[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(x) if part == "pair" or k < top]
    return sorted(out)


def audited(df, **kw):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.audit(df, **kw).collect())


def test_audit_matches_brute_force(spark, corpus):
    rows = corpus + [(300 + i, prose(400, i % 5, ("ka", "lo", "é", "Mi")), "en", "hot") for i in range(20)] + [(400, "x'y ÀB àb\x7fz 1a2", None, None)]
    df = frame(spark, rows).withColumn("term", F.lit("clash")).withColumn("rank", F.lit(1))
    assert audited(df) == brute_audit(rows)
    assert audited(df, top_terms=3) == brute_audit(rows, 3)
    assert divergence.audit(df.limit(0)).count() == 0


def test_audit_counts_all_partials(spark, corpus, monkeypatch):
    """Counts given out many times in a task, and levels cut into many panels, change nothing."""
    want = brute_audit(corpus)
    count, values = divergence._count, divergence.block_values
    monkeypatch.setattr(divergence, "_count", lambda: count(most=3))
    monkeypatch.setattr(divergence, "block_values", lambda c, n, v: values(c, n, v, panel=2))
    assert audited(frame(spark, corpus).repartition(7)) == want


def test_joint_tables_price_large_counts():
    r = np.random.default_rng(4)
    counts = r.integers(0, 5, (300, 6)) * r.integers(1, 10**11, (300, 1)) // 3
    n = [int(x) for x in counts.sum(axis=0)]
    p = [[divergence.price(int(c), n[g], 300) for c in counts[:, g]] for g in range(6)]
    want = [[sum((a - b) ** 2 // b for a, b in zip(p[g], p[h])) for h in range(6)] for g in range(6)]
    assert divergence.block_values(counts, n, 300, panel=500).tolist() == want


# ---- 13 -------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("size,batch", [(2048, 8 << 20), (64, 500)])
def test_packing_holds_every_id_once(spark, corpus, tokenizer, size, batch):
    rows = corpus + [(500 + i, "equal text", "en", "a") for i in range(40)]
    df = frame(spark, rows).withColumn("offset", F.lit(1))
    placed = packing.pack(df, size=size, ids=True, batch_bytes=batch).collect()
    want = Counter()
    for i, t, _, _ in rows:
        want[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    # pieces of rows with the same key lie beside one another only by start: take them apart by their ids
    by_start = defaultdict(list)
    for r in placed:
        ids = np.frombuffer(r["ids"], f"<u{r['width']}")
        assert len(ids) == r["length"] <= size and r["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
        by_start[r["doc_id"], r["doc_tokens"], r["start"]].append(ids.tolist())
    pieces = Counter()
    for (i, ids), c in want.items():
        for s in range(0, len(ids), size):
            pieces[i, len(ids), s, tuple(ids[s:s + size])] += c
    assert pieces == Counter((i, n, s, tuple(x)) for (i, n, s), xs in by_start.items() for x in xs)
    seq = defaultdict(list)
    for r in placed:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in seq.values():
        x.sort()
        assert x[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(x, x[1:])) and sum(n for _, n in x) <= size
    assert sorted(seq) == list(range(len(seq)))


def test_sequences_are_padded(spark, corpus):
    placed = packing.pack(frame(spark, corpus), size=64, ids=True)
    want = defaultdict(list)
    for r in sorted(placed.collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        want[r["sequence_id"]] += np.frombuffer(r["ids"], f"<u{r['width']}").tolist()
    got = {r["sequence_id"]: r for r in packing.sequences(placed, 64).collect()}
    assert set(got) == set(want)
    for k, ids in want.items():
        pad = 0 if len(ids) & (len(ids) - 1) == 0 else 64 - len(ids)
        assert got[k]["n_tokens"] == len(ids) and got[k]["ids"] == ids + [0] * pad


def test_packing_of_no_rows(spark, corpus):
    assert packing.pack(frame(spark, corpus).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_patterns_place_the_histogram(seed):
    r = random.Random(seed)
    hist = {k: r.choice([1, 2, 7, 10**9]) for k in r.sample(range(1, 129), 60)}
    patterns = packing.shortest_pack_first(hist, 128)
    placed = Counter()
    for n, content in patterns:
        assert sum(k * t for k, t in content) <= 128
        for k, t in content:
            placed[k] += n * t
    assert placed == hist
    s = packing.slots(patterns)
    assert len(s["length"]) < 20 * len(hist)       # grows with the histogram, not with the pieces


def test_patterns_are_the_piecewise_rule():
    """Bulk placement leaves the same space as placing one piece after the other into the emptiest pack."""
    r = random.Random(8)
    hist = {k: r.randint(1, 6) for k in r.sample(range(1, 65), 25)}
    packs = []
    for k in sorted(hist, reverse=True):
        for _ in range(hist[k]):
            j = min(range(len(packs)), key=packs.__getitem__, default=None)
            if j is None or packs[j] + k > 64:
                packs.append(k)
            else:
                packs[j] += k
    got = sorted(sum(k * t for k, t in c) for n, c in packing.shortest_pack_first(hist, 64) for _ in range(n))
    assert got == sorted(packs)


def test_packing_leaves_little_padding(spark):
    r = random.Random(2)
    rows = [(i, prose(int(r.lognormvariate(4.5, 1)) + 1, i), "en", "a") for i in range(400)]
    out = packing.pack(frame(spark, rows), size=256).agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s")).first()
    assert out["n"] >= 0.97 * 256 * out["s"]
