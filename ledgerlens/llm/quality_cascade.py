"""Quality rules as a short-circuit cascade.

Each rule is a rejecting boolean expression over the words or the text.  On a
sample of rows the cascade measures what a rule costs (run time of a job that
evaluates this rule alone) and what share of rows it rejects; rules then run
in descending order of rejection per cost inside one CASE expression, whose
later branches Spark evaluates only for rows that the earlier ones let pass.
The order changes the work, never the verdict: a row is kept if no rule
rejects it.  The main path is DataFrame functions only.

Defined results: a NULL or blank text has 0 words, 0 in every statistic, and
is rejected as too short; NULL in any other column is carried along; repeated
rows are judged alike; an empty table gives an empty table and the declared
order of rules.  Columns whose names clash with the temporary ones are safe:
temporaries are prefixed ``__qc_`` and dropped.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import let, words_of

#: characters counted as symbols
SYMBOLS = r"[#*$%&|<>]+"
_W = "__qc_words"


def n_words(words: Column) -> Column:
    return F.size(words).cast("long")


def word_chars(words: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(worded_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    A window becomes one long: its hash in the high bits, its position in as
    many low bits as the text needs.  After one sort, equal windows are
    neighbours; the words themselves confirm an equality of hashes.  Linear
    memory, n log n time, no matter how often a window repeats.
    """
    def shift(fn, x, b):
        return F.call_function(fn, x, b)

    def covered(w):
        bits = F.length(F.bin(F.size(w).cast("long")))
        packed = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: shift("shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), bits)
            .bitwiseOR(i.cast("long")))
        return let(F.struct(F.sort_array(packed).alias("s"), bits.alias("b")), lambda z: _positions(w, z["s"], z["b"]))

    def _positions(w, s, b):
        mask = shift("shiftleft", F.lit(1).cast("long"), b) - 1

        def same(x, y):
            i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
            eq = shift("shiftright", x, b) == shift("shiftright", y, b)
            for d in range(3):
                eq = eq & (F.get(w, i + d) == F.get(w, j + d))
            return F.coalesce(eq, F.lit(False))

        hits = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        starts = F.transform(hits, lambda x: x.bitwiseAND(mask))
        spans = F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))
        return F.size(F.array_distinct(spans)).cast("long")

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(covered(w)))


@dataclass(frozen=True)
class Rule:
    """``rejects(words, text)`` builds the rejecting expression."""

    name: str
    rejects: object


#: the rules of the base contract, then the cascade's own
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
MAX_SYMBOL_PCT, MAX_DUP_LINE_PCT, MIN_MEAN_WORD, MAX_MEAN_WORD = 10, 50, 2, 20


def default_rules() -> list[Rule]:
    return [
        Rule("too_short", lambda w, t: n_words(w) < MIN_WORDS),
        Rule("repeated_windows", lambda w, t: 100 * n_repeat_words(w) > MAX_REPEAT_PCT * n_words(w)),
        Rule("symbols", lambda w, t: 100 * n_symbols(t) > MAX_SYMBOL_PCT * n_words(w)),
        Rule("repeated_lines", lambda w, t: 100 * n_dup_lines(t) > MAX_DUP_LINE_PCT * F.size(worded_lines(t))),
        Rule("word_length", lambda w, t: (word_chars(w) < MIN_MEAN_WORD * n_words(w))
             | (word_chars(w) > MAX_MEAN_WORD * n_words(w))),
    ]


def measure(df: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 2000, seed: int = 7) -> list[dict]:
    """Cost (seconds) and rejected share of each rule on a sample of about
    ``sample_rows`` rows; the sample only steers the order of the rules."""
    total = df.count()
    frac = min(1.0, sample_rows / total) if total else 1.0
    sample = (df.select(F.col(text).alias("t")).sample(fraction=frac, seed=seed)
              .withColumn("w", words_of(F.col("t"))).persist(StorageLevel.DISK_ONLY))
    try:
        n = sample.count()
        out = []
        for r in rules:
            q = sample.agg(F.sum(r.rejects(F.col("w"), F.col("t")).cast("long")).alias("x"))
            t0 = time.perf_counter()
            x = q.collect()[0]["x"] or 0
            out.append({"rule": r.name, "cost": time.perf_counter() - t0, "rejected": x / n if n else 0.0})
        return out
    finally:
        sample.unpersist()


def order_rules(rules: list[Rule], measured: list[dict]) -> list[Rule]:
    """Descending rejection per cost; ties keep the declared order."""
    by = {m["rule"]: m["rejected"] / max(m["cost"], 1e-9) for m in measured}
    return sorted(rules, key=lambda r: -by[r.name])


def cascade(df: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = 2000,
            reason: str | None = "rejected_by", measured: list[dict] | None = None) -> DataFrame:
    """``df`` with the name of the first rejecting rule (NULL: kept)."""
    rules = rules or default_rules()
    ordered = order_rules(rules, measured or measure(df, rules, text, sample_rows))

    def verdict(words):
        out = None
        for r in ordered:
            cond = r.rejects(words, F.col(text))
            out = F.when(cond, F.lit(r.name)) if out is None else out.when(cond, F.lit(r.name))
        return out
    # the words are bound inside the expression: a filter on it, pushed down or not, splits a text once
    return df.withColumn(reason, let(words_of(F.col(text)), verdict))


def keep_clean(df: DataFrame, **kw) -> DataFrame:
    """Rows that no rule rejects, with the columns of ``df``."""
    return cascade(df, reason="__qc_reason", **kw).filter(F.col("__qc_reason").isNull()).drop("__qc_reason")


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text", rules: list[Rule] | None = None,
               sample_rows: int = 2000) -> DataFrame:
    """key, the five statistics, base_failed, kept.  ``kept`` is the cascade's
    verdict; its rules contain both base rules.  The base rules are evaluated
    on the statistics already computed for the row."""
    rules = rules or default_rules()
    ordered = order_rules(rules, measure(df, rules, text, sample_rows))
    w, t = F.col(_W), F.col("__qc_text")
    s = (df.select(F.col(key).alias(key), F.col(text).alias("__qc_text"))
         .withColumn(_W, words_of(t))
         .select(key, "__qc_text", _W,
                 n_words(w).alias("n_words"), word_chars(w).alias("word_chars"), n_symbols(t).alias("n_symbols"),
                 n_dup_lines(t).alias("n_dup_lines"), n_repeat_words(w).alias("n_repeat_words")))
    ready = {
        "too_short": F.col("n_words") < MIN_WORDS,
        "repeated_windows": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("n_words"),
        "repeated_lines": (F.col("n_dup_lines") > 0)
        & (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.size(worded_lines(t))),
        "word_length": (F.col("word_chars") < MIN_MEAN_WORD * F.col("n_words"))
        | (F.col("word_chars") > MAX_MEAN_WORD * F.col("n_words")),
    }
    rejected = None
    for r in ordered:
        cond = ready.get(r.name)
        cond = r.rejects(w, t) if cond is None else cond
        rejected = F.when(cond, True) if rejected is None else rejected.when(cond, True)
    base = ready["too_short"] | ready["repeated_windows"]
    return s.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & ~F.coalesce(rejected, F.lit(False))).alias("kept"))
