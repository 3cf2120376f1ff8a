"""User-level downsampling and the user and item draws of the split.

All of these are row-local. Draws through ``sample``, ``randomSplit`` or
``sampleBy`` are left out on purpose: with a seed they still depend on the
partition layout, so a recomputed partition could put a row into two splits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.hashing import (
    DOWNSAMPLE_TAG,
    ITEM_HOLDOUT_TAG,
    USER_GROUP_TAG,
    hash_below,
    validate_fraction,
)
from tastemill.schema import ITEM, SPLIT, TEST, TRAIN, USER, VAL

GROUP = "user_group"
DEFAULT_WEIGHTS = (0.6, 0.2, 0.2)


def downsample(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """All rows of about ``fraction`` of the users."""
    fraction = validate_fraction(fraction)
    return df if fraction == 1 else df.filter(hash_below(fraction, seed, DOWNSAMPLE_TAG, USER))


def user_group(weights: tuple[float, float, float] = DEFAULT_WEIGHTS, seed: int = 42) -> Column:
    """train, val or test, drawn per user."""
    shares = [Decimal(str(w)) for w in weights]
    total = sum(shares)
    if len(shares) != 3 or min(shares) < 0 or total <= 0:
        raise ValueError(f"three weights, none negative and not all zero, are needed, got {weights}")
    draw = lambda share: hash_below(share / total, seed, USER_GROUP_TAG, USER)
    return F.when(draw(shares[0]), TRAIN).when(draw(shares[0] + shares[1]), VAL).otherwise(TEST)


def split_user_groups(
    df: DataFrame, weights: tuple[float, float, float] = DEFAULT_WEIGHTS, seed: int = 42
) -> DataFrame:
    return df.withColumn(GROUP, user_group(weights, seed))


def holdout(share: float = 0.5, seed: int = 42) -> Column:
    """True for about ``share`` of each user's items; copies of a row stay together."""
    return hash_below(share, seed, ITEM_HOLDOUT_TAG, USER, ITEM)


def tag_splits(
    df: DataFrame,
    seed: int = 42,
    weights: tuple[float, float, float] = DEFAULT_WEIGHTS,
    share: float = 0.5,
) -> DataFrame:
    """Add ``split``: train users whole, half of each val and test user held out.

    The half that is not held out gets ``train`` in the same projection, so no
    set difference and no union is needed to give it back. Rows without a user or
    an item belong to no split.
    """
    df = df.filter(F.col(USER).isNotNull() & F.col(ITEM).isNotNull())
    grouped = split_user_groups(df, weights, seed)
    held = (F.col(GROUP) != TRAIN) & holdout(share, seed)
    return grouped.withColumn(SPLIT, F.when(held, F.col(GROUP)).otherwise(TRAIN)).drop(GROUP)
