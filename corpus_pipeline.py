"""Training-data pipeline over `documents`: five stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last keep the
columns of `documents`, with n_chars following the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import bpe, line_dedup, mixing, near_dedup, toxicity
from kpiloom.llm.common import table
from kpiloom.session import land, remove_folder, work_folder

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of 50 words or more that an earlier one has."""
    out = line_dedup.dedup_lines(docs).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the text that they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The first three stages learn, compare by hash families and walk chains of links.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before, folder = folder, work_folder(spark, name)
        docs = land(stage(spark, docs, sf_dir), folder)
        if before:
            remove_folder(spark, before)
    return docs
