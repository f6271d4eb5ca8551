"""From raw documents to token ids: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it as Parquet into the
session's shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, common, langid, mixing, queries, rlz, simhash

#: No SQL expresses a trained model or the mix's draws; tests hold the stages against plain Python.
ORACLE_SQL = None


def _sized(docs: DataFrame, like: DataFrame) -> DataFrame:
    """n_chars brought in line with a changed text."""
    if "n_chars" not in like.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID rejects go: no letters, or a calibrated score below the threshold."""
    model = langid.fit(docs, langid.learnable("doc_id"))
    return langid.identify(docs, model).where(~F.col("rejected")).select(*(common.quoted(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash group stays."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut; documents of which nothing is left go."""
    return _sized(rlz.remove(docs), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight; a document comes out up to three times, its parts as often as drawn."""
    return _sized(mixing.mixed(docs), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with a check that they decode to it.  Null texts count as empty."""
    coded = bpe.encode(docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path(queries.BYTE_BPE), public_tokenizers.PATTERN, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
