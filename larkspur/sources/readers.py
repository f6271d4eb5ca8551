"""Readers for the file formats of the four workloads.

Schemas are declared, never inferred, so no reader makes an extra pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the published rating, tag and encounter files.
RATING_FIELDS = [
    ("userId", T.LongType()),
    ("movieId", T.LongType()),
    ("rating", T.DoubleType()),
    ("timestamp", T.StringType()),
]
TAG_SCORE_FIELDS = [
    ("movieId", T.IntegerType()),
    ("tagId", T.IntegerType()),
    ("relevance", T.DoubleType()),
]
TAG_NAME_FIELDS = [("tagId", T.IntegerType()), ("tag", T.StringType())]
DRUG_COLUMNS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin", "glyburide-metformin", "glipizide-metformin",
    "glimepiride-pioglitazone", "metformin-rosiglitazone", "metformin-pioglitazone",
]
READMITTED = "readmitted"
STAY = "time_in_hospital"
VECTOR_BITS = 128


def _schema(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def log_lines(spark: SparkSession, path: str, spread: int | None = None) -> DataFrame:
    """Access-log text (plain or compressed), one row per line, column ``value``.

    A gzip file is read by a single task.  When few such files hold much data,
    ``spread`` deals the lines out over that many partitions once, before the
    parsing; with many files leave it unset and save the shuffle.
    """
    lines = spark.read.text(path)
    return lines.repartition(spread) if spread else lines


def bit_vectors(spark: SparkSession, path: str, bits: int = VECTOR_BITS) -> DataFrame:
    """Headerless CSV of ``bits`` 0/1 columns and a -1/1 label in the last column."""
    fields = [(f"_c{i}", T.ByteType()) for i in range(bits + 1)]
    return spark.read.schema(_schema(fields)).csv(path)


def ratings(spark: SparkSession, path: str) -> DataFrame:
    """Rating CSV with header: user, item, rating, epoch seconds as text."""
    return spark.read.schema(_schema(RATING_FIELDS)).option("header", True).csv(path)


def tag_scores(spark: SparkSession, path: str) -> DataFrame:
    """Tag relevance CSV with header."""
    return spark.read.schema(_schema(TAG_SCORE_FIELDS)).option("header", True).csv(path)


def tag_names(spark: SparkSession, path: str) -> DataFrame:
    """Tag name CSV with header."""
    return spark.read.schema(_schema(TAG_NAME_FIELDS)).option("header", True).csv(path)


def encounters(spark: SparkSession, path: str) -> DataFrame:
    """Encounter CSV with header, cut down to the columns the models use.

    Only the header line is read ahead (names, all text); the executors read the
    rows, and only the columns selected here are parsed.
    """
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        *[F.col(f"`{c}`") for c in DRUG_COLUMNS],
        READMITTED,
        F.col(STAY).try_cast("int").alias(STAY),
    )
