"""A corpus made ready for training: five stages over the documents, each on what the last one kept.

1. language: documents in no known language go.
2. quality: documents that fail the rules go.
3. near copies: of each group of documents linked by 0.8 of their five-word shingles one stays.
4. secrets: spans that look like credentials are masked.
5. packing: the texts become sequences of at most 2048 tokens.

The first four return the columns of ``documents``, the last one pieces of documents. Between the
stages the rows lie as Parquet in the folder that all executors share, so a lost executor costs no
more than its tasks. Each stage defines its results for nulls, empty tables and repeated rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm import language_id, ngram_join, packing, quality_rules, secret_scan
from nearfield.llm.common import documents, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.language_filter(docs, language_id.fit(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.quality_filter(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, words=5, share=(80, 100))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("packing", packed),
]

#: No SQL has code lengths, merges or a choice of cuts; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
