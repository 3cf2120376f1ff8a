"""Projections and filters on the interaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.operators.skew import apply_verdicts, key_verdicts
from tastemill.schema import ITEM, RATING, READ, REVIEWED, TRIPLE, USER
from tastemill.staging import Stage, stage_table


def project_triples(df: DataFrame) -> DataFrame:
    return df.select(*TRIPLE)


def drop_flags(df: DataFrame) -> DataFrame:
    return df.drop(READ, REVIEWED)


def remove_zeros(df: DataFrame) -> DataFrame:
    """Drop placeholder ratings."""
    return df.filter(F.col(RATING) > 0)


def relevant_items(df: DataFrame, above: int = 3) -> DataFrame:
    """Interactions that count as liked: 4 and 5 stars."""
    return df.filter(F.col(RATING) > above)


def distinct_users(df: DataFrame) -> DataFrame:
    return df.select(USER).distinct()


def distinct_items(df: DataFrame) -> DataFrame:
    return df.select(ITEM).distinct()


def check_threshold(threshold: int) -> int:
    if isinstance(threshold, bool) or not isinstance(threshold, int) or threshold < 0:
        raise ValueError(f"threshold must be a non-negative integer, got {threshold!r}")
    return threshold


def active_users(df: DataFrame, threshold: int = 10) -> DataFrame:
    """Users with strictly more than ``threshold`` interactions, and how many."""
    counts = df.groupBy(USER).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > check_threshold(threshold))


def remove_low_users(
    df: DataFrame, threshold: int = 10, stage: Stage = stage_table, min_rows: int | None = None
) -> DataFrame:
    """Keep the interactions of active users; a threshold of 0 keeps everybody."""
    if check_threshold(threshold) == 0:
        return df
    counts = df.groupBy(USER).agg(F.count(F.lit(1)).alias("n_rows"))
    low = key_verdicts(stage("low-profile", counts), USER, F.col("n_rows") <= threshold, min_rows)
    return apply_verdicts(df.filter(F.col(USER).isNotNull()), stage("low-users", low), USER, "left_anti")
