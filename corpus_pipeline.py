"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns the columns of ``documents``; the last returns packed pieces.  Stages are
written to the shared folder and read again, so a lost executor costs a stage's tasks
and nothing before them.

Defined results, for every stage: an empty table gives an empty one; rows without a
doc_id and rows that share one are rows of their own; columns beyond those of
``documents`` pass through whatever their names, but for packing, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from podium.llm import decontaminate, near_copies, packing, quality, secrets
from podium.llm.common import materialise, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: those without words always, repeated rows alike.  Labels of
    other documents, labels that are null and missing labels say nothing."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word similarity 0.8 or more) stays, that with the smallest doc_id.

    Null and wordless texts are one group; a row without a doc_id stays only where its group has no other; of
    rows that repeat doc_id and text one stays.
    """
    return near_copies.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go, with or without a doc_id; null texts and null items leak nothing."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, overlapping ones once; n_chars follows the text; null texts stay null."""
    return secrets.redact(docs, secrets.train(secrets.labelled_samples(spark)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; a null or empty text is its end id alone, repeated rows are packed each."""
    return packing.packed_digests(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: The stages use trained models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
