"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.llm import (causal_lm, decontaminate, divergence, langid, lsh_forest, merkle, mixture, packing, quality_cascade, suffix_dedup,
                            token_store, toxicity, warc_store)
from ledgerlens.llm.common import fold_of, read
from ledgerlens.llm.registry import ORACLE, QUERIES, query  # noqa: F401

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, unnest([0, 1, 2]) AS v(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
s AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_symbols <= 10 * n_words AND 100 * n_dup_lines <= 50 * n_lines
         AND word_chars BETWEEN 2 * n_words AND 20 * n_words AS kept
FROM b
"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark, sf_dir):
    return quality_cascade.statistics(read(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || doc_id::VARCHAR) AS h FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source COLLATE C) - 1) % 3
            WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS weight FROM s),
r AS (
  SELECT *, 150 * sum(source_size) OVER ()
            - 200 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
         100 * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den,
         row_number() OVER o AS k
  FROM w WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, source COLLATE C)),
f AS (SELECT num, den, k FROM r WHERE weight * num <= 2 * source_size * den ORDER BY k LIMIT 1),
t AS (
  SELECT r.source, source_size::BIGINT AS source_size,
         CASE WHEN r.k < f.k THEN (2 * source_size)::DOUBLE ELSE (weight * f.num)::DOUBLE / f.den::DOUBLE END AS target
  FROM r, f),
p AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken
FROM p
"""


@query("op10_source_mix", OP10_SQL)
def op10_source_mix(spark, sf_dir):
    return mixture.mix(read(spark, sf_dir, "documents")).drop("__mx_source")


@query("op9_token_store")
def op9_token_store(spark, sf_dir):
    return token_store.encode_documents(read(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM d, ks, unnest(range(1, len(w) - k + 2)) AS u(i)),
hit AS (SELECT doc_id, dw.k, i, item FROM dw JOIN bw USING (k, g)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) AS u(p) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE C) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op4_decontaminate", OP4_SQL)
def op4_decontaminate(spark, sf_dir):
    return decontaminate.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _base32_sql(digest: str) -> str:
    return " || ".join(f"substr('{warc_store.BASE32}', ((('0x' || substr({digest}, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INT + 1, 1)"
                       for g in range(8) for s in (15, 10, 5, 0))


OP8_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS r FROM p)
SELECT page_id, payload_bytes, {_base32_sql("h")} AS payload_digest,
       CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = r THEN NULL ELSE r END AS refers_to
FROM q
"""


@query("op8_warc_store", OP8_SQL)
def op8_warc_store(spark, sf_dir):
    return warc_store.archive(read(spark, sf_dir, "pages"))


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold_of(F.col("doc_id"), 3) != 1))
    out = langid.predict(docs, model)
    return out.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(fold_of(F.col("doc_id"), 5) != 0))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted",
                      F.size("passages").alias("n_passages"))


@query("op3_causal_lm")
def op3_causal_lm(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model, counts = causal_lm.fit(docs.filter(fold_of(F.col("doc_id"), 7) != 2))
    out = causal_lm.score(docs, model, counts)
    return out.select("doc_id", (fold_of(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(na.n) + any_value(nb.n) - count(*))),
r AS (SELECT doc_id AS x, doc_id AS c FROM d UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.x),
c AS (SELECT x, min(c) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c ON c.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query("op7_lsh_forest", OP7_SQL)
def op7_lsh_forest(spark, sf_dir):
    return lsh_forest.link(read(spark, sf_dir, "documents"), shingle=3, percent=85)


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removed_spans(read(spark, sf_dir, "documents"))


def _field_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"


# the lowest bit of crc32(decimal doc_id), bit by bit: DuckDB has no crc32
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP11_SQL = f"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, sha256({" || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         CASE WHEN {_CRC_SQL} % 2 = 0
              THEN sha256({" || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')"))}) END AS bad
  FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM f)),
d AS (
  SELECT doc_id, s.s, leaf, bad, row_number() OVER (PARTITION BY s.s ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY s.s) AS n
  FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source),
up AS (
  SELECT 0 AS l, s, i, n, leaf AS h FROM d
  UNION ALL
  SELECT any_value(l) + 1, s, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY s, i // 3),
sub AS (SELECT s, h AS subroot FROM up WHERE n = 1),
top AS (
  SELECT 1000 AS l, s AS i, count(*) OVER () AS n, subroot AS h FROM sub
  UNION ALL
  SELECT any_value(l) + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY i // 3),
nodes AS (SELECT l, s, i, n, h FROM up UNION ALL SELECT l, -1, i, n, h FROM top),
sib AS (
  SELECT l, s, i, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM nodes WINDOW w AS (PARTITION BY l, s, i // 3 ORDER BY i)),
walk AS (
  SELECT doc_id, leaf, s AS src, s, 0 AS l, i, coalesce(bad, leaf) AS h, '' AS proof, false AS done FROM d
  UNION ALL
  SELECT doc_id, leaf, src, CASE WHEN sib.n = 1 THEN -1 ELSE w.s END, CASE WHEN sib.n = 1 THEN 1000 ELSE w.l + 1 END,
         CASE WHEN sib.n = 1 THEN w.src ELSE w.i // 3 END, CASE WHEN sib.n = 1 THEN w.h ELSE sha256(a || w.h || b) END,
         CASE WHEN sib.n = 1 THEN proof ELSE proof || a || b END, sib.n = 1 AND w.s = -1
  FROM walk w JOIN sib ON sib.l = w.l AND sib.s = w.s AND sib.i = w.i WHERE NOT done)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
FROM walk w JOIN sub ON sub.s = w.src, (SELECT h FROM top WHERE n = 1) r WHERE done
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark, sf_dir):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    stripped = merkle.leaf_hash([F.translate("text", "\n", "") if c == "text" else F.col(c) for c in fields])
    tampered = F.when(fold_of(F.col("doc_id"), 2) == 0, stripped)
    m = merkle.manifest(read(spark, sf_dir, "documents"), fields, carry={"tampered": tampered})
    m = m.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return m.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_hash(F.col("proof")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(x.c, 0) AS c
  FROM g JOIN kept k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS c FROM t GROUP BY ALL) x
       ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
n AS (
  SELECT *, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER w + count(*) OVER w)::HUGEINT AS p FROM c WINDOW w AS (PARTITION BY lang, source)),
l AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (total + 1)) // (sum(total) OVER w + count(*) OVER w)::HUGEINT AS q
  FROM kept WINDOW w AS (PARTITION BY lang)),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS v
  FROM n a JOIN n b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.v, 0) AS v
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (
  SELECT n.lang, source, 'term' AS part, n.term AS item, ((p - q) * (p - q)) // q AS v
  FROM n JOIN l ON l.lang = n.lang AND l.term = n.term WHERE c > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY v DESC, item COLLATE C) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, v::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""


@query("op12_source_divergence", OP12_SQL)
def op12_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


@query("op13_packing")
def op13_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"))
