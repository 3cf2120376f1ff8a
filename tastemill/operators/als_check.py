"""Whether a fit is a fit: the normal equations that ALS solves last, put to the test.

An ALS iteration ends with the users. So with the item vectors v as they are, each user's vector x
solves ``(sum c v v' + reg n) x = sum b v`` over the user's ratings r: for explicit ratings c = 1,
b = r and n is their number; for implicit ones c = alpha |r|, b = 1 + c where r > 0 (else 0), n is the
number of those, and ``sum v v'`` over *all* items comes on top. The residual of these equations says
whether seed, regularisation, alpha, block sizes and storage left the solution as it should be.

No user's matrix is formed: ``sum c v v' x`` is ``sum c (v . x) v``, so a rating contributes one vector. The join
puts a user's ratings side by side, and a batch of them is added up to one row for each user in it. Only the sum over all items is a matrix, of rank by rank numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.ids import int_id
from tastemill.operators.als import ALSConfig
from tastemill.schema import ITEM, USER

#: Relative residual up to which a solution in single precision counts as one.
TOLERANCE = 1e-4
Batches = Iterator[pa.RecordBatch]


def _vectors(factors: DataFrame, key: str, name: str) -> DataFrame:
    """As they are stored, in single precision: half the bytes when they go with every rating."""
    return factors.select(F.col("id").alias(key), F.col("features").alias(name))


def _double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("array<double>") for name in names})


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def gram(factors: DataFrame) -> np.ndarray:
    """``sum v v'`` over all rows: the rows of each task's matrix, added up by number of the row."""

    def run(batches: Batches) -> Batches:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column("v"))
                total = own.T @ own if total is None else total + own.T @ own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total.tolist(), pa.list_(pa.float64()))], ["row", "v"])

    rows = factors.select(F.col("features").cast("array<double>").alias("v")).mapInArrow(run, "row bigint, v array<double>")
    summed = rows.groupBy("row").agg(Summarizer.sum(array_to_vector("v")).alias("v")).orderBy("row").collect()
    return np.array([r.v.toArray() for r in summed])


def _scaled(vector: Column, by: Column) -> Column:
    return F.transform(vector, lambda a: a * by)


def _largest(vector: Column) -> Column:
    return F.array_max(F.transform(vector, F.abs))


def _user_sums(config: ALSConfig):
    """A function of batches of ``user_id, r, v, x``: the sums over each run of a user's ratings."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            user, r, x = batch.column(USER).to_numpy(), batch.column("r").to_numpy(), batch.column("x")
            v = _matrix(batch.column("v")).astype(np.float64)
            known = x.is_valid().to_numpy(zero_copy_only=False)
            dot = np.zeros(len(v))
            if known.any():
                dot[known] = np.einsum("ij,ij->i", v[known], _matrix(x.drop_null()).astype(np.float64))
            weight = np.abs(r) * config.alpha if config.implicit else np.ones(len(r))
            positive = (r > 0).astype(np.float64) if config.implicit else np.ones(len(r))
            wanted = positive * (1 + weight) if config.implicit else r
            term = weight * dot - wanted
            starts = np.concatenate([[0], np.flatnonzero(user[1:] != user[:-1]) + 1])
            left = np.add.reduceat(v * term[:, None], starts)
            scale = (np.abs(term) + np.abs(wanted)) * np.abs(v).max(axis=1)
            offsets = np.arange(len(starts) + 1, dtype=np.int32) * v.shape[1]
            columns = [
                pa.array(user[starts], pa.int32()),
                pa.array(np.diff(np.append(starts, len(user)))),
                pa.array(np.add.reduceat(positive, starts)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(left.reshape(-1))),
                pa.array(np.add.reduceat(scale, starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [USER, "n", "weighted", "left", "scale"])

    return run


def user_residuals(model: ALSModel, ratings: DataFrame, config: ALSConfig) -> DataFrame:
    """``user_id, n, residual, scale`` of every user with ratings: largest component of the residual, and of its terms.

    A user without factors has a null residual. Ratings of items without factors count as missing.
    """
    rows = ratings.select(int_id(USER), int_id(ITEM), F.col(config.rating_col).cast("float").cast("double").alias("r"))
    users, items = _vectors(model.userFactors, USER, "x"), _vectors(model.itemFactors, ITEM, "v")
    joined = rows.join(items, ITEM).join(users, USER, "left").select(USER, "r", "v", "x")
    parts = joined.mapInArrow(_user_sums(config), f"{USER} int, n bigint, weighted double, left array<double>, scale double")
    sums = parts.groupBy(USER).agg(
        F.sum("n").alias("n"),
        F.sum("weighted").alias("weighted"),
        F.array(*[F.sum(F.col("left")[i]) for i in range(config.rank)]).alias("left"),
        F.sum("scale").alias("scale"),
    )
    solved = _double(sums.join(users, USER, "left"), "x")
    if config.implicit:
        total = gram(model.itemFactors)
        solved = _with_product(solved, total)
        left = F.zip_with("left", "g", lambda a, b: a + b)
        scale = F.col("scale") + _largest(F.col("g"))
    else:
        left, scale = F.col("left"), F.col("scale")
    ridge = F.col("weighted") * config.reg
    residual = F.zip_with(left, _scaled(F.col("x"), ridge), lambda a, b: a + b)
    return solved.select(USER, "n", _largest(residual).alias("residual"), (scale + ridge * _largest(F.col("x"))).alias("scale"))


def _with_product(solved: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``solved`` with ``g``, the matrix times ``x``."""
    names = solved.columns

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = batch.column("x")
            known = x.drop_null()
            products = iter((_matrix(known) @ matrix).tolist() if len(known) else [])
            g = [next(products) if valid else None for valid in x.is_valid().to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(g, pa.list_(pa.float64()))], [*names, "g"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in solved.dtypes)
    return solved.mapInArrow(run, f"{kinds}, g array<double>")


def fit_check(model: ALSModel, ratings: DataFrame, config: ALSConfig, tolerance: float = TOLERANCE) -> DataFrame:
    """One row ``users, above``: users with ratings, and those whose vector does not solve their equations."""
    checked = user_residuals(model, ratings, config)
    solved = F.col("residual") <= tolerance * F.col("scale")
    return checked.agg(F.count(F.lit(1)).alias("users"), F.count_if(~F.coalesce(solved, F.lit(False))).alias("above"))
