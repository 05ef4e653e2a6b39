"""The training-data pipeline: quality, repeated lines, near duplicates, personal data, packing.

Each stage takes what the one before it kept. All stages but the last return the columns of ``documents``; the last
returns the pieces of the packed sequences. Repeated rows, null ids and null texts are taken as the operators say; a null
text comes out of a stage that changes texts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import line_dedup, packing, pseudonyms, quality, simhash
from clickloom.llm.common import KEPT, clear, documents, stored

#: Setting of the session that holds the secret key of the pseudonyms; without it they can be undone by anyone.
KEY_SETTING = "spark.clickloom.pseudonyms.key"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality field does not reject."""
    field = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, field).where(f"score >= {quality.GOOD_FROM}").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that many of them have."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link."""
    return simhash.deduplicate(docs).select(*docs.columns)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced."""
    return pseudonyms.pseudonymise(docs, spark.conf.get(KEY_SETTING, pseudonyms.KEY)).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("lines", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("pseudonyms", with_pseudonyms),
    ("packing", packed_sequences),
]

#: SQL cannot express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``; each stage's result is written and read again, and only the last
    one's table stays."""
    docs, before = documents(spark, sf_dir), len(KEPT)
    for name, stage in STAGES:
        docs = stored(spark, f"pipeline-{name}", stage(spark, docs, sf_dir))
        clear(spark, first=before, but=1)
    return docs
