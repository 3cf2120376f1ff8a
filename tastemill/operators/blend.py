"""Blend explicit and implicit recommendation lists by weighted score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.operators.metrics import evaluate
from tastemill.operators.topk import as_lists, full_length, top_k
from tastemill.schema import ITEM, RATING, REVIEWED, USER

DEFAULT_WEIGHTS = (-1.0, 0.0, 0.5, 1.0, 5.0)
WEIGHT = "weight"


def attach_review_flag(split: DataFrame, full: DataFrame) -> DataFrame:
    """Add ``is_reviewed`` from the full table to the rows of a split.

    The full table is first reduced to one row per key, so copies in it do not
    multiply the split. The two-column key spreads hot users and items.
    """
    flags = full.groupBy(USER, ITEM).agg(F.max(REVIEWED).alias(REVIEWED))
    return split.join(flags, [USER, ITEM], "inner")


def blend_scores(explicit: DataFrame, implicit: DataFrame) -> DataFrame:
    """``(user_id, book_id, from_ratings, from_reviews)`` of items on either list, 0 where missing.

    This is the full outer join of two lists with unique (user, item) keys,
    written as one aggregation. Lists hold at most k items per user, so placing
    them by user is safe and lets the ranking that follows reuse the shuffle.
    """
    none = F.lit(0.0)
    stacked = explicit.select(
        USER, ITEM, F.col(RATING).cast("double").alias("from_ratings"), none.alias("from_reviews")
    ).unionByName(
        implicit.select(USER, ITEM, none.alias("from_ratings"), F.col(RATING).cast("double").alias("from_reviews"))
    )
    return (
        stacked.repartition(USER)
        .groupBy(USER, ITEM)
        .agg(F.sum("from_ratings").alias("from_ratings"), F.sum("from_reviews").alias("from_reviews"))
    )


def weighted(blended: DataFrame, weight) -> DataFrame:
    """Add ``rating = weight * from_reviews + from_ratings``; ``weight`` is a number or a column."""
    factor = weight if not isinstance(weight, (int, float)) else F.lit(float(weight))
    return blended.withColumn(RATING, factor * F.col("from_reviews") + F.col("from_ratings"))


def hybrid_top_k(explicit: DataFrame, implicit: DataFrame, k: int, weight: float) -> DataFrame:
    """The k best items per user by weighted score, as ranked rows.

    ``explicit`` and ``implicit`` are long recommendation lists of bounded
    length; cut score tables with ``top_k`` first.
    """
    scores = weighted(blend_scores(explicit, implicit), weight)
    return top_k(scores.select(USER, ITEM, RATING), k)


def hybrid_lists(
    explicit: DataFrame, implicit: DataFrame, k: int, weight: float, min_len: int | None = None
) -> DataFrame:
    """Blended lists as arrays; by default only full lists of k items are kept."""
    lists = as_lists(hybrid_top_k(explicit, implicit, k, weight))
    return full_length(lists, k) if min_len is None else lists.filter(F.size(ITEM) >= min_len)


def weight_sweep(
    explicit: DataFrame,
    implicit: DataFrame,
    labels: DataFrame,
    k: int,
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    min_len: int | None = None,
) -> DataFrame:
    """Metrics per blend weight; the lists are blended once for all weights.

    Users whose blended list is shorter than ``min_len`` (default: k) are left out.
    """

    def each_weight():
        return F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias(WEIGHT)

    blended = blend_scores(explicit, implicit)
    scores = weighted(blended.select("*", each_weight()), F.col(WEIGHT))
    ranked = top_k(scores.select(WEIGHT, USER, ITEM, RATING), k, by=(WEIGHT,))
    min_len = k if min_len is None else min_len
    return evaluate(ranked, labels.select("*", each_weight()), k, (WEIGHT,), min_len)
