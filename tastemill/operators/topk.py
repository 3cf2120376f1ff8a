"""Top-k lists per user, in long and in array form.

``row_number() <= k`` lets Catalyst prune to k rows per user in every map task
before the shuffle (``WindowGroupLimit``), so a user with very many scored
items costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemill.schema import ITEM, RATING, USER

RANK = "rank"
PRUNED_UP_TO = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k(scores: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """The k best items per user as rows with ``rank`` 1..k; ties go to the lower item id."""
    spark = scores.sparkSession
    if int(spark.conf.get(PRUNED_UP_TO)) < k:  # else longer lists would not be pruned
        spark.conf.set(PRUNED_UP_TO, str(k))
    best_first = Window.partitionBy(*by, USER).orderBy(F.desc(RATING), F.asc(ITEM))
    return scores.withColumn(RANK, F.row_number().over(best_first)).filter(F.col(RANK) <= k)


def topk_list(scores: DataFrame, k: int, min_len: int = 1) -> DataFrame:
    """``(user_id, book_id ARRAY)`` best first; lists shorter than ``min_len`` are left out."""
    lists = as_lists(top_k(scores, k))
    return lists if min_len <= 1 else lists.filter(F.size(ITEM) >= min_len)


def as_lists(ranked: DataFrame) -> DataFrame:
    """Ranked rows to one array per user."""
    pairs = F.array_sort(F.collect_list(F.struct(RANK, ITEM)))
    return ranked.groupBy(USER).agg(F.transform(pairs, lambda p: p[ITEM]).alias(ITEM))


def as_recommendations(ranked: DataFrame) -> DataFrame:
    """Ranked rows to ``(user_id, recommendations ARRAY<STRUCT<book_id, rating>>)``."""
    triples = F.array_sort(F.collect_list(F.struct(RANK, ITEM, RATING)))
    items = F.transform(triples, lambda t: F.struct(t[ITEM].alias(ITEM), t[RATING].alias(RATING)))
    return ranked.groupBy(USER).agg(items.alias("recommendations"))


def recs_long(recs: DataFrame) -> DataFrame:
    """Recommendations to rows; ``rank`` is the position in the list, from 1."""
    exploded = recs.select(USER, F.posexplode("recommendations").alias("_pos", "_rec"))
    return exploded.select(USER, "_rec.*", (F.col("_pos") + 1).alias(RANK))


def pred_labels(recs: DataFrame) -> DataFrame:
    """Recommendations to ``(user_id, book_id ARRAY)``."""
    return recs.select(USER, f"recommendations.{ITEM}")


def full_length(lists: DataFrame, k: int) -> DataFrame:
    """Lists of exactly k items."""
    return lists.filter(F.size(ITEM) == k)


def running_list(scores: DataFrame, k: int) -> DataFrame:
    """Growing item lists by falling score, keeping those of exactly k items.

    Has the result of ``collect_list`` over a window with the default RANGE
    frame, where tied items share one list: a tie across position k leaves the
    user without a row, and a tie that ends at k gives one row per tied item.
    The k + 1 best rows per user decide which case holds, so the full running
    lists are never built.
    """
    head = F.array_sort(F.collect_list(F.struct(RANK, ITEM, RATING)))
    users = top_k(scores, k + 1).groupBy(USER).agg(head.alias("_head"))
    last = F.get("_head", F.lit(k - 1))[RATING]
    crossing = (F.size("_head") > k) & F.get("_head", F.lit(k))[RATING].eqNullSafe(last)
    tied = F.size(F.filter("_head", lambda t: t[RATING].eqNullSafe(last)))
    return (
        users.filter((F.size("_head") >= k) & ~crossing)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), tied)))
        .select(USER, F.transform(F.slice("_head", 1, k), lambda t: t[ITEM]).alias(ITEM))
    )
