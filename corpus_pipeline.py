"""A training corpus from raw documents, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept. All but the last return the columns of ``documents``, with
``n_chars`` following the text. ``run`` writes each stage's result to the
shared folder and rereads it, so no stage recomputes another and a lost
executor costs no more than its own tasks; what a stage has written besides is
deleted once its result is there.

Defined results: a null text is scored as empty, stays null until it is packed
and is then a document of the end id alone; documents with a null id are never
another's copy and all stay that the classifier accepts; repeated rows of one id
are one document to near_dedup, which keeps or drops them together; equal texts go
to the smallest id; texts of any length are whole rows; empty tables give an empty
result; other columns of any name are carried up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitrend.llm import minhash, packing, quality, secrets, substring
from epitrend.llm.common import scratch, store, table
from epitrend.session import delete_folder

NEAR_PERCENT = 80  # similarity in per cent from which documents are near-duplicates


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep_one(docs, NEAR_PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out."""
    return _counted(substring.remove_repeats(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a placeholder."""
    return _counted(secrets.redact(docs, secrets.train_from_documents(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secrets", secret_scan),
    ("packing", pack),
]

#: The stages run models, rolling hashes and a tokenizer, which SQL cannot
#: express; ``tests/llm/test_pipeline.py`` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            out = stage(spark, docs, sf_dir)
            path = store(out, f"pipeline-{name}")
            keep.append(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs
