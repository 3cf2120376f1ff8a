"""Leak-free train, val and test sets on one tagged frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.operators.sampling import DEFAULT_WEIGHTS, tag_splits
from tastemill.operators.skew import apply_verdicts, key_verdicts
from tastemill.schema import ITEM, SPLIT, TEST, TRAIN, USER, VAL
from tastemill.staging import Stage, stage_nothing, stage_table


def profile(tagged: DataFrame, key: str) -> DataFrame:
    """Rows and train rows per user or item; combined before the shuffle."""
    return tagged.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(SPLIT) == TRAIN).alias("n_train"),
    )


def user_verdicts(
    tagged: DataFrame, threshold: int = 0, move_unseen: bool = True, min_rows: int | None = None, stage: Stage = stage_nothing
) -> DataFrame:
    """Users to drop (``low``: at most ``threshold`` rows) or to move to train (no train row)."""
    low, unseen = F.col("n_rows") <= threshold, F.col("n_train") == 0
    users = stage("user-profile", profile(tagged, USER).withColumn("low", low))
    return key_verdicts(users, USER, (low | unseen) if move_unseen else low, min_rows, keep=("low",))


def unseen(tagged: DataFrame, key: str, min_rows: int | None = None, stage: Stage = stage_nothing) -> DataFrame:
    """Users or items without a train row."""
    return key_verdicts(stage(f"{key}-profile", profile(tagged, key)), key, F.col("n_train") == 0, min_rows)


def apply_user_verdicts(tagged: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Drop the rows of low users and move those of the other exceptions to train."""
    joined = apply_verdicts(tagged, verdicts, USER, "left")
    return (
        joined.filter(~F.coalesce(F.col("low"), F.lit(False)))
        .withColumn(SPLIT, F.when(F.col("low").isNotNull(), TRAIN).otherwise(F.col(SPLIT)))
        .drop("low")
    )


def put_back_users(tagged: DataFrame, stage: Stage = stage_table, min_rows: int | None = None) -> DataFrame:
    """Move the held-out rows of users that have no train row to train."""
    return apply_user_verdicts(tagged, stage("users", user_verdicts(tagged, min_rows=min_rows, stage=stage)))


def drop_unobserved_users(
    tagged: DataFrame, stage: Stage = stage_table, min_rows: int | None = None
) -> DataFrame:
    """Keep held-out rows only of users that have a train row."""
    return apply_verdicts(tagged, stage("users", unseen(tagged, USER, min_rows, stage)), USER, "left_anti")


def drop_unobserved_items(
    tagged: DataFrame, stage: Stage = stage_table, min_rows: int | None = None
) -> DataFrame:
    """Keep held-out rows only of items that have a train row.

    An unobserved item has no train row by definition, so taking away all its
    rows touches the held-out sets alone.
    """
    return apply_verdicts(tagged, stage("items", unseen(tagged, ITEM, min_rows, stage)), ITEM, "left_anti")


def train_val_test_split(
    df: DataFrame,
    seed: int = 42,
    rm_unobserved: bool = True,
    weights: tuple[float, float, float] = DEFAULT_WEIGHTS,
    share: float = 0.5,
    stage: Stage = stage_table,
    min_rows: int | None = None,
) -> DataFrame:
    """Tag every row with its split.

    Users come first: moving a user to train can make an item observed.
    """
    tagged = tag_splits(df, seed, weights, share)
    if not rm_unobserved:
        return tagged
    # Draws are made once; every later pass reads them.
    tagged = stage("tagged", tagged)
    return drop_unobserved_items(put_back_users(tagged, stage, min_rows), stage, min_rows)


def pick(tagged: DataFrame, *splits: str) -> DataFrame:
    """The rows of the named splits, without the tag."""
    return tagged.filter(F.col(SPLIT).isin(*splits)).drop(SPLIT)


def final_fit_frame(tagged: DataFrame) -> DataFrame:
    """What the final model is fitted on; test stays unseen."""
    return pick(tagged, TRAIN, VAL)


def as_frames(tagged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return pick(tagged, TRAIN), pick(tagged, VAL), pick(tagged, TEST)
