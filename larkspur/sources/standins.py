"""The workloads' inputs, built from the given tables.

Each builder reads whole tables and stays a plain plan: nothing is collected.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.layout import spread
from larkspur.sources.readers import table

EMBEDDING_SIZE = 64
CHALLENGE_BITS = 128
#: The columns that hold the bits of a packed vector.
WORDS = ["high", "low"]
BIT_COLUMNS = [f"b{i:02d}" for i in range(EMBEDDING_SIZE)]
#: The four bits of 0 to 15 as SQL arrays of doubles.
QUADS = ", ".join(f"array({', '.join(f'{b}D' for b in f'{i:04b}')})" for i in range(16))

#: Text that means "off" per categorical column of ``encounters``.
ENCOUNTER_OFF = {
    "priority": "5-LOW",
    "returned": "N",
    "linestatus": "O",
    "discounted": "No",
}


#: The text columns of ``wide_encounters``; as many as the flags of the published analysis.
MEDICINES = [f"m{i:02d}" for i in range(23)]


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` written as access-log lines, column ``value``.

    Every 50th event has ``-`` for its bytes.
    """
    user = F.col("user_id")
    suffix = (
        F.when(user % 4 == 0, ".ac.uk")
        .when(user % 4 == 1, ".edu")
        .when(user % 4 == 2, ".edu.au")
        .otherwise(".com")
    )
    size = F.when(F.col("event_id") % 50 == 0, F.lit("-")).otherwise(
        F.floor(F.col("value") * 100).cast("string")
    )
    line = F.concat(
        F.lit("h"), user.cast("string"), suffix,
        F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'),
        F.col("event_type"), F.lit(' HTTP/1.0" '),
        F.when(F.col("event_type") == "error", "500").otherwise("200"),
        F.lit(" "), size,
    )
    return table(spark, folder, "events").select(line.alias("value"))


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with lines: categorical text columns, outcome, number of lines."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_returnflag").alias("returned"),
            F.min("l_linestatus").alias("linestatus"),
            F.when(F.min("l_discount") > 0.02, "Yes").otherwise("No").alias("discounted"),
            F.count(F.lit(1)).alias("stay"),
        )
    )
    orders = table(spark, folder, "orders")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select(
        F.col("o_orderkey").alias("encounter_id"),
        F.col("o_orderpriority").alias("priority"),
        "returned",
        "linestatus",
        "discounted",
        F.col("o_orderstatus").alias("outcome"),
        "stay",
    )


def wide_encounters(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with lines and one text column per ``MEDICINES``: ``No``, ``Steady`` or ``Up``.

    A line stands for the medicine its part number names; more than 25 pieces is ``Up``.
    """
    medicine, dose = F.col("l_partkey") % len(MEDICINES), F.when(F.col("l_quantity") > 25, 2).otherwise(1)
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            *[F.max(F.when(medicine == i, dose)).alias(name) for i, name in enumerate(MEDICINES)],
            F.count(F.lit(1)).alias("stay"),
        )
    )
    said = [
        F.when(F.col(name) == 2, "Up").when(F.col(name) == 1, "Steady").otherwise("No").alias(name)
        for name in MEDICINES
    ]
    orders = table(spark, folder, "orders")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select(
        F.col("o_orderkey").alias("encounter_id"), *said, F.col("o_orderstatus").alias("outcome"), "stay"
    )


def packed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors of ``challenge_vectors`` with their bits in two longs, ``high`` and ``low``.

    Two numbers a row are read, shuffled and stored; ``unpacked`` makes the vectors where
    a model reads them.
    """
    parts = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    keys = spread(table(spark, folder, "lineitem").select(*parts), parts)
    halves = [
        F.conv(F.substring("vec_key", 1 + 16 * half, 16), 16, -10).cast("long") for half in (0, 1)
    ]
    digest = keys.select(F.md5(F.concat_ws("|", *parts)).alias("vec_key"))
    packed = digest.select("vec_key", halves[0].alias("high"), halves[1].alias("low"))
    more = F.bit_count("high") > F.bit_count("low")
    return packed.select("vec_key", F.when(more, "1").otherwise("-1").alias("lbl"), "high", "low")


def unpacked(rows: DataFrame, keep_words: bool = False) -> DataFrame:
    """``high`` and ``low`` as a vector of 128 bits, the highest bit first.

    Four bits at a time are looked up in a literal table: an expression per bit took several
    times as long in every pass of a fit.
    """
    quad = F.expr(f"array({QUADS})")
    quads = [
        F.get(quad, F.shiftright(F.col(word), 60 - place).bitwiseAND(F.lit(15).cast("long")).cast("int"))
        for word in WORDS
        for place in range(0, 64, 4)
    ]
    keep = [c for c in rows.columns if keep_words or c not in WORDS]
    return rows.select(*keep, array_to_vector(F.concat(*quads)).alias("features"))


def bit_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Signs of the embeddings as text columns ``b00``.. and a ``-1``/``1`` text label."""
    bits = [
        F.when(F.col("embedding")[i] > 0, "1").otherwise("0").alias(name)
        for i, name in enumerate(BIT_COLUMNS)
    ]
    label = F.when(F.col("label") % 2 == 0, "-1").otherwise("1")
    return table(spark, folder, "embeddings").select("vec_id", *bits, label.alias("lbl"))


def challenge_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """128-bit vectors with a ``-1``/``1`` text label, one per order line.

    The bits are the digest of the line's key.  The label says whether the first
    half has more ones than the second, so models have something to learn.
    """
    return unpacked(packed_vectors(spark, folder))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Mean ordered quantity per (customer, part) as a rating of 0.1 to 5."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg((F.sum("l_quantity") / F.count(F.lit(1)) / 10).alias("rating"))
    )


def item_tag_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Relevance of a tag (supplier nation) for an item (part): its mean discount.

    Lines are summed per (part, supplier) before the supplier join, so copies of
    a hot pair do not travel.
    """
    pairs = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.sum(F.col("l_discount").cast("decimal(12,2)")).alias("discount"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    mean = F.sum("discount").cast("double") / F.sum("lines")
    return (
        pairs.join(suppliers, pairs["l_suppkey"] == suppliers["s_suppkey"])
        .groupBy(F.col("l_partkey").alias("item_id"), F.col("s_nationkey").alias("tag_id"))
        .agg(F.round(mean, 6).cast("decimal(18,6)").alias("relevance"))
    )


def tag_names(spark: SparkSession, folder: str) -> DataFrame:
    """Tag dimension: nation names."""
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("tag_id"), F.col("n_name").alias("tag")
    )


def fixed_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """A given assignment of items to clusters."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster")
    )
