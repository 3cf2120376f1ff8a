"""Fitted users solve their normal equations, and others do not."""

from types import SimpleNamespace

import data
import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.operators import als_check
from tastemill.operators.als import ALSConfig, fit_als


@pytest.fixture(scope="module", params=[False, True])
def fitted(spark, request):
    config = ALSConfig(rank=5, reg=0.1, max_iter=3, blocks=2, implicit=request.param, alpha=1.5)
    ratings = data.few_reviewed(spark)
    return fit_als(ratings, config), ratings, config


def test_a_fit_solves_its_equations(fitted):
    assert tuple(als_check.fit_check(*fitted).first()) == (8, 0)


def test_residuals_against_matrices(fitted):
    """The residual without a matrix equals the one from each user's matrix."""
    model, ratings, config = fitted
    items = {r.id: np.array(r.features, dtype=float) for r in model.itemFactors.collect()}
    every = sum(np.outer(v, v) for v in items.values()) if config.implicit else 0
    wrong = {r.id: np.array(r.features, dtype=float) + 0.3 for r in model.userFactors.collect()}
    moved = model.userFactors.withColumn("features", F.transform("features", lambda x: x + F.lit(0.3).cast("float")))
    got = {r.user_id: r.residual for r in als_check.user_residuals(SimpleNamespace(userFactors=moved, itemFactors=model.itemFactors), ratings, config).collect()}
    for user, x in wrong.items():
        own = [(items[r.book_id], float(r[config.rating_col])) for r in ratings.filter(f"user_id = {user}").collect()]
        c = [config.alpha * abs(r) if config.implicit else 1.0 for _, r in own]
        b = [(1 + w if r > 0 else 0.0) if config.implicit else r for w, (_, r) in zip(c, own)]
        n = sum(r > 0 for _, r in own) if config.implicit else len(own)
        matrix = every + sum(w * np.outer(v, v) for w, (v, _) in zip(c, own)) + config.reg * n * np.eye(5)
        left = matrix @ x - sum(w * v for w, (v, _) in zip(b, own))
        assert got[user] == pytest.approx(np.abs(left).max(), rel=1e-4)


def test_a_wrong_vector_or_setting_shows(spark, fitted):
    model, ratings, config = fitted
    bent = model.userFactors.withColumn("features", F.when(F.col("id") == 3, F.transform("features", lambda x: x * F.lit(1.05).cast("float"))).otherwise(F.col("features")))
    one = als_check.fit_check(SimpleNamespace(userFactors=bent, itemFactors=model.itemFactors), ratings, config).first()
    assert (one.users, one.above) == (8, 1)
    gone = SimpleNamespace(userFactors=model.userFactors.filter("id <> 2"), itemFactors=model.itemFactors)
    assert als_check.fit_check(gone, ratings, config).first().above == 1
    other = ALSConfig(rank=5, reg=0.5, implicit=config.implicit, alpha=config.alpha)
    assert als_check.fit_check(model, ratings, other).first().above >= 6


def test_ratings_carry_vectors_in_single_precision(spark):
    """What goes with every rating through the joins is half as wide as what is computed with."""
    from tastemill.operators import als_check

    factors = spark.createDataFrame([(1, [1.0, 2.0])], "id INT, features ARRAY<FLOAT>")
    vectors = als_check._vectors(factors, "book_id", "v")
    assert vectors.dtypes == [("book_id", "int"), ("v", "array<float>")]
    assert als_check._double(vectors, "v").dtypes[1] == ("v", "array<double>")


def test_ratings_meet_the_aggregation_in_sums(spark):
    """A batch of the join gives one row for each run of a user, not one for each rating."""
    import pyarrow as pa

    from tastemill.operators import als_check

    user, r = pa.array([1, 1, 1, 2, 2, 1], pa.int32()), pa.array([1.0, 0.0, 2.0, 3.0, 1.0, 1.0])
    v = pa.array([[1.0, k] for k in range(6)], pa.list_(pa.float32()))
    x = pa.array([[1.0, 2.0]] * 3 + [None] * 2 + [[1.0, 2.0]], pa.list_(pa.float32()))
    batch = pa.RecordBatch.from_arrays([user, r, v, x], ["user_id", "r", "v", "x"])
    (out,) = als_check._user_sums(ALSConfig(rank=2))(iter([batch]))
    assert out.to_pydict() == {
        "user_id": [1, 2, 1],
        "n": [3, 2, 1],
        "weighted": [3.0, 2.0, 1.0],
        # Errors: 0, 3, 3; without a vector -3, -1; 10.
        "left": [[6.0, 9.0], [-4.0, -13.0], [10.0, 50.0]],
        "scale": [1.0 + 3.0 + 10.0, 18.0 + 8.0, 55.0],
    }
