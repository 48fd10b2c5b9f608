"""Corpus pipeline: quality rules, near-duplicates, personal data, source mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``documents``.  ``run`` writes the result of a stage
as Parquet into the shared folder of ``spark.checkpoint.dir`` and reads it for
the next one, so a lost executor never reaches back past a stage.

Cases: an empty table goes through as an empty table; nulls and repeated rows
are treated as each stage's operator says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import minhash, mixing, pii, piece, quality
from cartwheel.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Expectation-maximisation, message passing and merging cannot be written in SQL;
# the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
