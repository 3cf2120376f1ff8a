"""Interactions derived from an order / line-item star schema.

Stands in for a ratings file: a customer is the user, a part the book. Ratings
run 0..5 with 0 as the placeholder for "no rating".
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFFER_BASE = 1_000_000
#: Line items that a task groups by a key that hardly repeats.
ROWS_PER_TASK = 500_000


def _facts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/lineitem.parquet").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        (F.col("l_quantity").cast("int") % 6).alias("rating"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_read"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_reviewed"),
    )


def raw_interactions(spark: SparkSession, root: str) -> DataFrame:
    """One row per line item: keys may repeat."""
    orders = spark.read.parquet(f"{root}/orders.parquet").select("o_orderkey", "o_custkey")
    joined = _facts(spark, root).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("book_id"),
        "is_read",
        "rating",
        "is_reviewed",
    )


def one_per_key(raw: DataFrame) -> DataFrame:
    return raw.groupBy("user_id", "book_id").agg(
        F.max("is_read").alias("is_read"),
        F.max("rating").alias("rating"),
        F.max("is_reviewed").alias("is_reviewed"),
    )


def interactions(spark: SparkSession, root: str) -> DataFrame:
    """One row per (customer, part)."""
    return one_per_key(raw_interactions(spark, root))


def baskets(spark: SparkSession, root: str) -> DataFrame:
    """One row per (order, part-supplier offer): many small users and rare items.

    On this view some users have no train row and some items are never observed,
    which the customer view is too dense to show. Keys hardly repeat, so rows are
    dealt by key before they are grouped: a map task that grouped its split first
    would hold nearly all of its rows, and the split grows with the input.
    """
    raw = _facts(spark, root).select(
        F.col("l_orderkey").alias("user_id"),
        (F.col("l_partkey") * OFFER_BASE + F.col("l_suppkey")).alias("book_id"),
        "is_read",
        "rating",
        "is_reviewed",
    )
    rows = spark.read.parquet(f"{root}/lineitem.parquet").count()  # from the files' footers
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))
    return one_per_key(raw.repartition(tasks, "user_id", "book_id"))


def user_map(spark: SparkSession, root: str) -> DataFrame:
    customers = spark.read.parquet(f"{root}/customer.parquet")
    return customers.select(F.col("c_custkey").cast("int").alias("user_id_csv"), F.col("c_name").alias("user_id"))


def book_map(spark: SparkSession, root: str) -> DataFrame:
    parts = spark.read.parquet(f"{root}/part.parquet")
    return parts.select(F.col("p_partkey").cast("int").alias("book_id_csv"), F.col("p_name").alias("book_id"))
