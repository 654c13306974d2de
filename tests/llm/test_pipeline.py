"""The pipeline against a brute-force version, its contract, and the entry module without it."""

import hashlib
import importlib.util
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from test_operators import DOCS, WORD, brute_groups, brute_hits, brute_quality, brute_targets, near_rows, prose

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    r = random.Random(12)
    rows = [(i, t, "en", r.choice("aab")) for i, t, _, _ in near_rows(5, groups=7)]
    item = prose(30, 4242)
    rows += [(500 + i, prose(90, 9000 + i), "fr", r.choice(["a", "b", "c", None])) for i in range(25)]
    rows += [(600, prose(40, 1) + " " + item + " " + prose(40, 2), "en", "a"), (601, None, "en", "a"), (602, "", None, None),
             (603, "| # " * 70, "en", "b"), (604, (prose(8, 3) + "\n") * 20, "en", "c"), (605, "İ " + prose(70, 9) + " é! don't 12", "de", "c")]
    docs = spark.createDataFrame([(i, t, lg, s, len(t or "")) for i, t, lg, s in rows], DOCS)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "never there at all")], "item_id int, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows, [(1, item), (3, "never there at all")]


def brute_pipeline(rows, items):
    import public_tokenizers
    from tokenizers import Tokenizer

    def clean(t):
        n, chars, sym, dup, rep = brute_quality(t)
        lines = sum(bool(WORD.search(x)) for x in (t or "").split("\n"))
        return not (n < 50 or 100 * rep > 50 * n or 100 * sym > 10 * n or 100 * dup > 50 * lines or not 2 * n <= chars <= 20 * n)
    rows = [x for x in rows if clean(x[1])]
    groups = brute_groups(rows, 5, 80)
    rows = [x for x in rows if groups[x[0]][1] == x[0]]
    rows = [x for x in rows if not brute_hits(x[1], items)[1]]
    size = {i: len(WORD.findall(t)) for i, t, _, _ in rows}
    per = Counter()
    for i, _, _, s in rows:
        per[s] += size[i]
    target = brute_targets(per)
    mixed = []
    for s in per:
        epochs = math.floor(target[s] / per[s])
        rest = math.floor(target[s] - epochs * per[s] + 0.5)
        for i, t, _, _ in sorted((x for x in rows if x[3] == s), key=lambda x: hashlib.md5(f"mix:{x[0]}".encode()).hexdigest()):
            part = max(0, min(size[i], rest))
            rest -= part
            mixed += [(i, t)] * (epochs + (part == size[i]))
            if 0 < part < size[i]:
                mixed.append((i, " ".join(WORD.findall(t)[:part])))
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = Counter()
    for i, t in mixed:
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4")
        out[i, len(ids), zlib.crc32(ids)] += 1
    return out


def test_pipeline_matches_brute_force(spark, tables):
    d, rows, items = tables
    got = corpus_pipeline.run(spark, d).collect()
    want = brute_pipeline(rows, items)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    spans = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in got)
    assert spans[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(spans, spans[1:]))
    assert [x[2] for x in spans] == sorted(x[2] for x in spans)
    assert 600 not in {r["doc_id"] for r in got} and len(want) > 20


def test_stages_keep_the_columns_of_documents(spark, tables):
    d, rows, _ = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), d).count() == 0, name


def test_entry_without_the_subpackage(tmp_path):
    """The entry module and the other queries work when these folders are gone."""
    for n in os.listdir(ROOT):
        if n in ("ledgerlens", "__spark_entry__.py"):
            os.symlink(os.path.join(ROOT, n), tmp_path / n) if n != "ledgerlens" else None
    os.mkdir(tmp_path / "ledgerlens")
    for n in os.listdir(os.path.join(ROOT, "ledgerlens")):
        if n != "llm":
            os.symlink(os.path.join(ROOT, "ledgerlens", n), tmp_path / "ledgerlens" / n)
    entry = (tmp_path / "__spark_entry__.py")
    entry.unlink()
    entry.write_text(open(os.path.join(ROOT, "__spark_entry__.py")).read())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and 'pipeline' not in q and not any(x.startswith('op') and x[2].isdigit() for x in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, check=True)


def test_nothing_else_imports_the_subpackage():
    for base, _, files in os.walk(os.path.join(ROOT, "ledgerlens")):
        if f"{os.sep}llm" in base:
            continue
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(base, f)).read()
                assert "ledgerlens.llm" not in text and "from .llm" not in text, f
    assert importlib.util.find_spec("ledgerlens.llm")
