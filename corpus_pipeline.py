"""The corpus pipeline: language, exact copies, near copies, mixture, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, all but the last with the columns of `documents`. Each stage's result is written
as Parquet to the cluster's shared checkpoint folder and read again by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspan.llm import exact_dedup, language_id, mixing, packing, queries, simhash
from lexspan.llm.common import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language: null texts, and texts without a letter."""
    texts = language_id.references(docs.where(language_id.fold("doc_id", 4) != 2))
    judged = language_id.identify(docs, texts, lang_pred="__lang", score="__lang_score")
    # Without any labelled text no language is known, and whatever has letters stays.
    return (judged.where(F.col("__lang") != "und") if texts else language_id.with_letters(docs)).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8), the row with the smallest doc_id stays."""
    return simhash.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, in training order."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: Fingerprints, automata and tokens can't be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), _folder(spark)
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
