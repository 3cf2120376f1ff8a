"""MAP, NDCG@k and precision@k as plain aggregations.

Predictions and labels are stacked and grouped, first by (user, item) to find
the hits, then by user. Both groupings combine map-side, a user's group holds
no more than the hits in one list, and nothing is joined or broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.ranking import average_precision, ndcg, precision
from tastemill.operators.topk import RANK
from tastemill.schema import ITEM, USER


def explode_lists(lists: DataFrame) -> DataFrame:
    """``(user_id, book_id ARRAY)`` to rows with ``rank``."""
    return lists.select(USER, F.posexplode(ITEM).alias("_pos", ITEM)).select(
        USER, ITEM, (F.col("_pos") + 1).alias(RANK)
    )


def pred_true_pairs(preds: DataFrame, labels: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per user what the metrics need: ``n_pred``, ``n_relevant`` and the hit positions.

    ``preds`` has ``(user_id, book_id, rank)``, ``labels`` ``(user_id, book_id)``.
    A user missing on either side has no row. ``by`` names extra grouping columns
    that both sides carry.
    """
    keys = [*by, USER]
    stacked = preds.select(*keys, ITEM, F.col(RANK).cast("int").alias(RANK), F.lit(0).alias("_label")).unionByName(
        labels.select(*keys, ITEM, F.lit(None).cast("int").alias(RANK), F.lit(1).alias("_label"))
    )
    pairs = stacked.groupBy(*keys, ITEM).agg(F.min(RANK).alias(RANK), F.max("_label").alias("_label"))
    hit = F.when(F.col("_label") == 1, F.col(RANK))
    per_user = pairs.groupBy(*keys).agg(
        F.count(RANK).alias("n_pred"),
        F.sum("_label").alias("n_relevant"),
        F.array_sort(F.collect_list(hit)).alias("hits"),
    )
    return per_user.filter((F.col("n_pred") > 0) & (F.col("n_relevant") > 0))


def user_metrics(pairs: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    hits, n = F.col("hits"), F.col("n_relevant")
    return pairs.select(
        *by,
        USER,
        average_precision(hits, n).alias("ap"),
        ndcg(hits, n, k).alias("ndcg"),
        precision(hits, k).alias("precision"),
    )


def evaluate(
    preds: DataFrame, labels: DataFrame, k: int, by: tuple[str, ...] = (), min_len: int = 1
) -> DataFrame:
    """``(users, map, ndcg, precision)``: one row, or one per value of ``by``.

    Lists shorter than ``min_len`` are not scored.
    """
    pairs = pred_true_pairs(preds, labels, by).filter(F.col("n_pred") >= min_len)
    per_user = user_metrics(pairs, k, by)
    return per_user.groupBy(*by).agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("ap").alias("map"),
        F.avg("ndcg").alias("ndcg"),
        F.avg("precision").alias("precision"),
    )
