"""Explicit and implicit ALS, and top-k recommendation from its factors."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.ids import int_id
from tastemill.operators import als_wide
from tastemill.operators.cleaning import distinct_users
from tastemill.operators.factors import factor_topk
from tastemill.operators.topk import as_recommendations
from tastemill.schema import ITEM, RATING, REVIEWED, USER
from tastemill.session import ensure_checkpoint_dir
from tastemill.staging import collected

#: Explicit fits of a larger rank solve systems of a user's ratings, not of the rank.
WIDE_RANK = 100
#: Ratings that a block of MLlib's should not exceed: a task holds a block several times over while it is built, outside of
#: the memory that Spark manages.
RATINGS_PER_BLOCK = 2_000_000


@dataclass(frozen=True)
class ALSConfig:
    rank: int = 10
    reg: float = 1.0
    implicit: bool = False
    alpha: float = 1.0
    max_iter: int = 10
    seed: int = 42
    #: User and item blocks, at least; there are more of them for more than RATINGS_PER_BLOCK ratings each.
    #: MLlib seeds the factors block by block, so their number is part of what is fitted: it follows the
    #: data and not the cluster.
    blocks: int = 10
    #: With a checkpoint, MLlib lets go of the shuffles before it; those of an iteration have each vector up to once a block.
    checkpoint_interval: int = 1

    @property
    def rating_col(self) -> str:
        return REVIEWED if self.implicit else RATING

    @property
    def kind(self) -> str:
        return "implicit" if self.implicit else "explicit"


def fit_als(ratings: DataFrame, config: ALSConfig) -> ALSModel:
    """Fit on ``rating`` or, if implicit, on ``is_reviewed``.

    The seed is always set, so that a refit is comparable. Factors are cut loose
    from their lineage after each iteration. A wide rank, explicit and with
    regularization, has the same equations and order of steps but a start of its own.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    rows = ratings.select(int_id(USER), int_id(ITEM), F.col(config.rating_col).cast("float").alias("r"))
    if config.rank > WIDE_RANK and config.reg > 0 and config.max_iter > 0 and not config.implicit:
        return als_wide.fit(rows, config.rank, config.reg, config.max_iter, config.seed)
    blocks = max(config.blocks, math.ceil(rows.count() / RATINGS_PER_BLOCK))
    als = ALS(
        rank=config.rank,
        regParam=config.reg,
        maxIter=config.max_iter,
        implicitPrefs=config.implicit,
        alpha=config.alpha,
        userCol=USER,
        itemCol=ITEM,
        ratingCol="r",
        coldStartStrategy="drop",
        seed=config.seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=config.checkpoint_interval,
    )
    # Implicit fits keep the shuffles of the items' vectors, which only a collection lets go.
    with collected(ratings.sparkSession):
        return als.fit(rows)


def recommend_long(model: ALSModel, users: DataFrame, k: int) -> DataFrame:
    """The k best items for each user that has factors, as ranked rows.

    Items the user has already seen are not excluded. Users without factors
    get no rows.
    """
    ids = distinct_users(users).select(int_id(USER).alias("id"))
    wanted = model.userFactors.join(ids, "id", "left_semi")
    ranked = factor_topk(wanted, model.itemFactors, k)
    return ranked.withColumn(RATING, F.col(RATING).cast("float"))


def recommend(model: ALSModel, users: DataFrame, k: int, method: str = "blocked") -> DataFrame:
    """``(user_id, recommendations ARRAY<STRUCT<book_id, rating>>)``, one row per user.

    ``method="mllib"`` uses the model's own recommender, which pairs its factor
    blocks through a cartesian product; ``blocked`` gives the same lists.
    """
    if method == "mllib":
        ids = distinct_users(users).select(int_id(USER))
        return model.recommendForUserSubset(ids, k)
    if method != "blocked":
        raise ValueError(f"unknown method {method!r}")
    return as_recommendations(recommend_long(model, users, k))
