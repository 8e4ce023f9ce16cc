"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet into the session's shared folder and reads again as
the next stage's ``docs``.  All stages but the last return the columns of
``documents``; extra columns pass through them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import decontaminate, packing, pii, simhash, toxicity
from wardline.llm.queries import tokenizer_path
from wardline.llm.tables import read, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; the rest stays as it is."""
    return toxicity.accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, words=4, radius=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind in brackets."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's token pieces in the training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Shingle hashes, a trained classifier and a tokenizer have no SQL form.
ORACLE_SQL = None
