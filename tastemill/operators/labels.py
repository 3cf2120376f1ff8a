"""What a recommender is scored against: the items a held-out user liked."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemill.operators.cleaning import distinct_users, relevant_items
from tastemill.schema import ITEM, USER

LABEL_BUCKETS = 4096


def true_labels(held: DataFrame) -> DataFrame:
    """Distinct (user, relevant item) pairs. The metrics read this long form."""
    return relevant_items(held).select(USER, ITEM).distinct()


def eval_users_and_labels(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Users to recommend for, including those who liked nothing, and the labels."""
    return distinct_users(held), true_labels(held)


def true_label_lists(labels: DataFrame, max_items: int = 100_000) -> DataFrame:
    """The labels as one sorted array per user, ``(user_id, part, true_item)``.

    A user with more than ``max_items`` labels gets several rows (``part`` 0, 1,
    ...), so that no array and no task has to hold an unbounded user. The parts
    come from counts per hash bucket: at most 4096 small rows per user.
    """
    bucket = F.pmod(F.xxhash64(ITEM), F.lit(LABEL_BUCKETS))
    bucketed = labels.withColumn("_bucket", bucket)
    sizes = bucketed.groupBy(USER, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(USER).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    part = F.floor((F.sum("_n").over(upto) - 1) / F.lit(max_items)).cast("int")
    parts = sizes.select(USER, "_bucket", part.alias("part"))
    return (
        bucketed.join(parts, [USER, "_bucket"])
        .groupBy(USER, "part")
        .agg(F.array_sort(F.collect_list(ITEM)).alias("true_item"))
    )
