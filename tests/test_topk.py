import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tastemill.operators import factors, topk

TIES = [
    (1, "a", 3), (1, "b", 2), (1, "c", 2), (1, "d", 1),
    (2, "a", 0), (2, "b", 0), (2, "c", 0),
    (3, "x", 3), (3, "y", 2), (3, "z", 1),
]


@pytest.fixture(scope="module")
def ties(spark):
    return spark.createDataFrame(TIES, "user_id INT, book_id STRING, rating INT")


def test_running_list_with_ties(ties):
    def users(k):
        return [r[0] for r in rows(topk.running_list(ties, k), "user_id")]

    assert users(1) == [1, 3]
    assert users(2) == [3]
    assert users(3) == [1, 1, 2, 2, 2, 3]
    assert users(4) == [1]
    assert users(5) == []


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8])
def test_running_list_equals_the_window(spark, k):
    rng = np.random.default_rng(k)
    data = [(int(u), i, int(rng.integers(0, 4))) for u in range(30) for i in range(int(rng.integers(1, 10)))]
    scores = spark.createDataFrame(data, "user_id INT, book_id INT, rating INT")
    w = Window.partitionBy("user_id").orderBy(F.desc("rating"))
    literal = scores.withColumn("book_id", F.collect_list("book_id").over(w)).filter(F.size("book_id") == k)
    want = literal.select("user_id", F.array_sort("book_id").alias("book_id"))
    got = topk.running_list(scores, k).select("user_id", F.array_sort("book_id").alias("book_id"))
    assert rows(got) == rows(want)


def test_lists(ties):
    assert rows(topk.topk_list(ties, 2)) == [(1, ["a", "b"]), (2, ["a", "b"]), (3, ["x", "y"])]
    assert rows(topk.topk_list(ties, 4, min_len=4)) == [(1, ["a", "b", "c", "d"])]
    recs = topk.as_recommendations(topk.top_k(ties, 2))
    assert rows(topk.pred_labels(recs)) == rows(topk.topk_list(ties, 2))
    assert rows(topk.recs_long(recs), "user_id", "book_id", "rating", "rank") == rows(
        topk.top_k(ties, 2), "user_id", "book_id", "rating", "rank"
    )


def vectors(spark, n, width, seed, low=0):
    rng = np.random.default_rng(seed)
    data = np.round(rng.normal(size=(n, width)), 1).astype(np.float32)
    frame = spark.createDataFrame([(low + i, v.tolist()) for i, v in enumerate(data)], "id INT, features ARRAY<FLOAT>")
    return data.astype(np.float64), frame


@pytest.mark.parametrize("k", [1, 7, 200])
@pytest.mark.parametrize("block_bytes", [None, 8 * 4 * 20])
def test_factor_topk_matches_brute_force(spark, monkeypatch, k, block_bytes):
    """Rounded vectors make many ties; small blocks make several to merge."""
    if block_bytes:
        monkeypatch.setattr(factors, "BLOCK_BYTES", block_bytes)
        monkeypatch.setattr(factors, "SCORES_PER_BATCH", 50)
    users, u_frame = vectors(spark, 37, 4, 1, low=100)
    items, i_frame = vectors(spark, 90, 4, 2)
    scores = np.round(users @ items.T, 9)
    want = []
    for u, row in enumerate(scores):
        best = np.lexsort((np.arange(len(row)), -row))[:k]
        want += [(100 + u, int(i), float(row[i]), rank) for rank, i in enumerate(best, 1)]
    got = rows(factors.factor_topk(u_frame, i_frame, k), "user_id", "book_id", "rating", "rank")
    assert got == sorted(want)


def test_factor_topk_with_all_scores_equal(spark):
    zeros = spark.range(50).select(F.col("id"), F.array(F.lit(0.0), F.lit(0.0)).alias("features"))
    got = rows(factors.factor_topk(zeros, zeros, 3), "user_id", "book_id", "rank")
    assert got == [(u, i, i + 1) for u in range(50) for i in range(3)]


def test_factor_topk_of_nothing(spark):
    empty = spark.createDataFrame([], "id INT, features ARRAY<FLOAT>")
    _, frame = vectors(spark, 5, 4, 1)
    assert factors.factor_topk(empty, frame, 3).count() == 0
    assert factors.factor_topk(frame, empty, 3).count() == 0
