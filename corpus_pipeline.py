"""A training-data pipeline over ``documents``: each stage applies one operator
of ``ledgerlens.llm`` to all that the stage before it kept.

Quality rules drop rejected documents, near-dedup keeps the document of
smallest id in each group, decontamination drops documents that hold a passage
of a benchmark item, mixing repeats and cuts documents to the source targets,
and the last stage writes the token ids and reads them back by key.
"""

from __future__ import annotations

from ledgerlens.llm import decontaminate, lsh_forest, mixture, quality_cascade, token_store
from ledgerlens.llm.common import read, written


def quality(spark, docs, sf_dir):
    return quality_cascade.keep_clean(docs)


def near_dedup(spark, docs, sf_dir):
    return lsh_forest.drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark, docs, sf_dir):
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark, docs, sf_dir):
    return mixture.apply_mix(docs)


def tokens(spark, docs, sf_dir):
    return token_store.encode_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_store", tokens),
]

#: the subword encoding of the last stage is not SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
