"""Joins of a large table with a list of exceptional keys, safe for hot keys.

The cleaning and splitting steps single out some users or items (too few rows,
never seen in train) and act on their rows. A plain join would send every row
of a key to one task, and since the key list comes out of an aggregation, the
adaptive skew rule cannot see it (it looks for a shuffle right below the sort).

The aggregation that finds the exceptions also counts the rows of each key, so
it can name the hottest keys. Their rows are cut into slices; an exception among
them is repeated once per slice. Most hot keys are no exception (they are
active, and they have train rows) and then cost nothing on the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one part in so many of all rows is hot, so there are fewer hot keys than this.
HOT_KEYS = 100_000
ROWS_PER_SLICE = 1_000_000


def key_verdicts(
    profile: DataFrame,
    key: str,
    exceptional: Column,
    min_rows: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, *keep, slices)``: all exceptional keys, and the hottest keys of either kind.

    ``profile`` has one row per key, with its number of rows as ``n_rows``.
    Exceptions are listed with null ``slices``. A key of more than ``min_rows``
    rows and of more than one part in ``HOT_KEYS`` of all rows is also listed with
    its number of slices. By arithmetic fewer than HOT_KEYS keys can be, which
    bounds what is broadcast; no ordering or gathering is needed to choose them,
    and no slice or unlisted key holds more than the larger of the two bounds.
    """
    total = profile.agg(F.sum("n_rows") / F.lit(HOT_KEYS)).scalar()
    bound = F.greatest(F.lit(float(min_rows or ROWS_PER_SLICE)), F.coalesce(total, F.lit(0.0)))
    slices = F.ceil(F.col("n_rows") / bound).cast("int")
    listed = profile.filter(exceptional).select(key, *keep, F.lit(None).cast("int").alias("slices"))
    hot = (
        profile.filter(F.col("n_rows") > bound)
        .select(key, *keep, slices.alias("slices"))
    )
    return listed.unionByName(hot)


def apply_verdicts(rows: DataFrame, verdicts: DataFrame, key: str, how: str) -> DataFrame:
    """Join ``rows`` with the exceptions among ``verdicts`` (``left`` or ``left_anti``).

    The slice of a row mixes in its partition number, so that exact copies of a
    row spread as well.
    """
    hot = F.broadcast(verdicts.filter(F.col("slices").isNotNull()).select(key, "slices"))
    slice_of_row = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.col("slices"))
    # Only rows of hot keys are hashed.
    sliced = (
        rows.join(hot, key, "left")
        .withColumn("_slice", F.when(F.col("slices").isNull(), 0).otherwise(slice_of_row.cast("int")))
        .drop("slices")
    )
    every_slice = F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)
    # Grouped, not joined with the hot keys: a join is planned as the product of its sides, which is never
    # broadcast, and all rows would be shuffled for a list of a few keys.
    kept = [c for c in verdicts.columns if c not in (key, "slices")]
    listed = (
        verdicts.groupBy(key)
        .agg(*[F.max(c).alias(c) for c in kept], F.max("slices").alias("slices"), F.max(F.col("slices").isNull()).alias("_listed"))
        .filter("_listed")
        .select(key, *kept, F.explode(every_slice).alias("_slice"))
    )
    extra = kept if how == "left" else []
    return sliced.join(listed, [key, "_slice"], how).select(*rows.columns, *extra)
