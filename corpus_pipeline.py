"""A corpus pipeline in five stages: toxic documents go, one document of each group of near duplicates stays,
contaminated documents go, secrets are replaced by marks, and what is left is packed into token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tslake.llm import decontam, forest, packing, secret_scan, toxicity
from tslake.llm.common import remove, shared_folder, ship, table
from tslake.llm.queries import tokenizer_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return forest.keep_one(docs)


def without_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_duplicates),
    ("decontamination", without_contaminated),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: A fitted model, iterated components and token ids are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's folder is removed once the next one's is written; the last stage stores what it has read."""
    docs, folder, before = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    out = STAGES[-1][1](spark, docs, sf_dir)
    remove(spark, folder)
    return out
