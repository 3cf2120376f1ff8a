import data
from conftest import rows
from pyspark.sql import functions as F

from tastemill.operators import blend, metrics, topk

DDL = "user_id INT, book_id INT, rating FLOAT"


def lists(spark):
    explicit = spark.createDataFrame([(1, 10, 4.0), (1, 11, 3.0), (2, 10, 1.0)], DDL)
    implicit = spark.createDataFrame([(1, 11, 0.5), (1, 12, 0.25), (3, 13, 1.0)], DDL)
    return explicit, implicit


def test_blend_equals_the_full_outer_join(spark):
    explicit, implicit = lists(spark)
    joined = (
        explicit.withColumnRenamed("rating", "from_ratings")
        .join(implicit.withColumnRenamed("rating", "from_reviews"), ["user_id", "book_id"], "full_outer")
        .na.fill(0, subset=["from_ratings", "from_reviews"])
    )
    columns = ("user_id", "book_id", "from_ratings", "from_reviews")
    assert rows(blend.blend_scores(explicit, implicit), *columns) == rows(joined, *columns)


def test_weighted_ranking(spark):
    explicit, implicit = lists(spark)
    got = blend.hybrid_top_k(explicit, implicit, 2, 4.0)
    assert rows(got, "user_id", "rank", "book_id", "rating") == [
        (1, 1, 11, 5.0), (1, 2, 10, 4.0), (2, 1, 10, 1.0), (3, 1, 13, 4.0),
    ]
    assert rows(blend.hybrid_lists(explicit, implicit, 2, 4.0)) == [(1, [11, 10])]
    assert len(rows(blend.hybrid_lists(explicit, implicit, 2, 4.0, min_len=1))) == 3


def test_sweep_equals_single_weights(spark):
    explicit, implicit = lists(spark)
    labels = spark.createDataFrame([(1, 10), (1, 12), (2, 10), (3, 13)], "user_id INT, book_id INT")
    swept = {r.weight: r for r in blend.weight_sweep(explicit, implicit, labels, 2, min_len=1).collect()}
    assert set(swept) == set(blend.DEFAULT_WEIGHTS)
    for weight, row in swept.items():
        one = metrics.evaluate(blend.hybrid_top_k(explicit, implicit, 2, weight), labels, 2).first()
        assert (row.users, row.map, row.ndcg, row.precision) == (one.users, one.map, one.ndcg, one.precision)


def test_review_flag_does_not_multiply_rows(spark):
    full = data.few_reviewed(spark)
    twice = full.unionByName(full)
    split = data.few(spark).filter("user_id < 4").withColumn("split", F.lit("train"))
    got = blend.attach_review_flag(split, twice)
    assert got.count() == 15
    assert rows(got, "user_id", "book_id", "is_reviewed") == rows(
        full.filter("user_id < 4"), "user_id", "book_id", "is_reviewed"
    )


def test_top_k_breaks_ties_by_item(spark):
    scores = spark.createDataFrame([(1, 3, 1.0), (1, 2, 1.0), (1, 9, 5.0)], DDL)
    assert rows(topk.top_k(scores, 2), "rank", "book_id") == [(1, 9), (2, 2)]
