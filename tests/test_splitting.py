from collections import defaultdict

import pytest
import data
from conftest import SF, rows
from pyspark.sql import functions as F

from tastemill.operators import audit, cleaning, quality, sampling, skew, splitting
from tastemill.plans import prep
from tastemill.plans.prep import PrepConfig
from tastemill.sources import star
from tastemill.staging import stage_nothing, stage_table


def brute_force(tagged, threshold=0):
    """The same rules, over a list of rows."""
    by_user = defaultdict(list)
    for r in tagged:
        by_user[r.user_id].append(r)
    put = []
    for user_rows in by_user.values():
        if len(user_rows) <= threshold:
            continue
        unseen = all(r.split != "train" for r in user_rows)
        put += [(r.user_id, r.book_id, r.rating, "train" if unseen else r.split) for r in user_rows]
    observed = {r[1] for r in put if r[3] == "train"}
    return sorted(r for r in put if r[3] == "train" or r[1] in observed)


@pytest.fixture(scope="module")
def basket_rows(spark):
    return stage_table("t", star.baskets(spark, SF).select("user_id", "book_id", "rating"))


@pytest.mark.parametrize("stage", [stage_nothing, stage_table])
@pytest.mark.parametrize("min_rows", [None, 1, 3])
def test_rules_match_brute_force(basket_rows, stage, min_rows):
    """A low ``min_rows`` makes many keys hot, so their rows take the spread path."""
    tagged = sampling.tag_splits(basket_rows)
    got = splitting.train_val_test_split(basket_rows, stage=stage, min_rows=min_rows)
    want = brute_force(tagged.collect())
    assert rows(got) == want
    assert len(want) < basket_rows.count()  # the item rule removed something
    moved = splitting.put_back_users(tagged, stage, min_rows)
    assert moved.filter("split = 'train'").count() > tagged.filter("split = 'train'").count()


def test_without_rules_only_the_tags_remain(basket_rows):
    plain = splitting.train_val_test_split(basket_rows, rm_unobserved=False)
    assert rows(plain) == rows(sampling.tag_splits(basket_rows))


def test_splits_are_disjoint_and_leak_free(basket_rows):
    train, val, test = splitting.as_frames(splitting.train_val_test_split(basket_rows))
    keys = [set(map(tuple, df.select("user_id", "book_id").collect())) for df in (train, val, test)]
    assert not (keys[0] & keys[1] or keys[0] & keys[2] or keys[1] & keys[2])
    users, items = ({k[i] for k in keys[0]} for i in (0, 1))
    for held in keys[1:]:
        assert {u for u, _ in held} <= users and {i for _, i in held} <= items
    assert users == {r.user_id for r in basket_rows.select("user_id").distinct().collect()}


@pytest.mark.parametrize("threshold", [0, 4, 10])
@pytest.mark.parametrize("fraction", [0.3, 1.0])
def test_fused_prep_equals_the_single_steps(spark, threshold, fraction):
    large = data.many(spark)
    config = PrepConfig(fraction=fraction, low_threshold=threshold)
    low = cleaning.remove_low_users(cleaning.remove_zeros(large), threshold)
    want = splitting.train_val_test_split(sampling.downsample(low, fraction))
    assert rows(prep.prep_splits(large, config)) == rows(want)


def test_prep_flags(spark):
    large = data.many(spark)
    everything = PrepConfig(fraction=1.0, rm_unobserved=False, rm_zeros=False, low_threshold=0)
    assert rows(prep.prep_splits(large, everything)) == rows(sampling.tag_splits(large))
    no_rules = PrepConfig(fraction=1.0, rm_unobserved=False, low_threshold=4)
    want = sampling.tag_splits(cleaning.remove_low_users(cleaning.remove_zeros(large), 4))
    assert rows(prep.prep_splits(large, no_rules)) == rows(want)


def test_hot_copies_spread_and_survive(spark):
    """One user, one item and one row make up most of the table."""
    hot = spark.range(3000).select(F.lit(7).alias("user_id"), F.lit(9).alias("book_id"), F.lit(4).alias("rating"))
    rest = data.many(spark)
    df = hot.unionByName(rest).repartition(8)
    kept = cleaning.remove_low_users(df, 4, min_rows=50)
    want = rest.groupBy("user_id").count().filter("count > 4").select("user_id")
    assert kept.filter("book_id = 9").count() == 3000
    assert kept.filter("book_id <> 9 AND user_id <> 7").count() == rest.join(want, "user_id").filter("user_id <> 7").count()

    counts = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))
    verdicts = skew.key_verdicts(counts, "user_id", F.col("n_rows") <= 4, min_rows=50)
    assert rows(verdicts.filter("slices IS NOT NULL")) == [(7, 61)]


def test_hot_list_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 40)
    profile = spark.range(1, 101).select(F.col("id").alias("user_id"), (F.col("id") * F.col("id")).alias("n_rows"))
    verdicts = skew.key_verdicts(profile, "user_id", F.col("n_rows") < 1, min_rows=10)
    assert [r[0] for r in rows(verdicts)] == list(range(92, 101))  # more than a fortieth of 338,350 rows each


def test_hot_exceptions_spread_too(spark):
    """An item that makes up most of the table and is never in train."""
    held = spark.range(3000).select(
        F.lit(1).alias("user_id"), F.lit(9).alias("book_id"), F.lit(4).alias("rating"), F.lit("val").alias("split")
    )
    rest = sampling.tag_splits(data.many(spark))
    tagged = held.repartition(8).unionByName(rest)
    got = splitting.drop_unobserved_items(tagged, min_rows=50)
    assert rows(got) == rows(splitting.drop_unobserved_items(rest, min_rows=10**6))
    only_held = tagged.filter("user_id = 1 AND split = 'val'")
    assert splitting.put_back_users(only_held, min_rows=50).filter("split = 'train'").count() == 3000


def test_audit_finds_a_broken_split(basket_rows):
    good = splitting.train_val_test_split(basket_rows)
    assert all(r.expected == r.actual for r in audit.split_audit(basket_rows, good).collect())
    leaky = sampling.tag_splits(basket_rows).unionByName(good.filter("split = 'val'").withColumn("split", F.lit("train")))
    broken = {r.check for r in audit.split_audit(basket_rows, leaky).collect() if r.expected != r.actual}
    assert {"rows in no input", "keys in two splits", "held-out items not in train"} <= broken


def test_conservation(basket_rows):
    final = splitting.train_val_test_split(basket_rows)
    removed = basket_rows.count() - final.count()
    got = dict(map(tuple, quality.conservation(basket_rows, final.drop("split")).collect()))
    assert got == {"down - recombined": removed, "recombined - down": 0}


@pytest.mark.parametrize("weights", [(0.8, 0.2, 0), (1, 0, 0), (0, 0, 1), (0.5, 0, 0.5)])
def test_a_zero_share_gets_nobody(spark, weights):
    users = spark.range(2000).select(F.col("id").alias("user_id"))
    counts = dict(map(tuple, sampling.split_user_groups(users, weights).groupBy("user_group").count().collect()))
    assert all((name in counts) == (share > 0) for name, share in zip(("train", "val", "test"), weights))
    for share, name in zip(weights, ("train", "val", "test")):
        assert abs(counts.get(name, 0) / 2000 - share) < 0.05


def test_weights_are_checked():
    for bad in ((1, 2), (0.5, -0.1, 0.6), (0, 0, 0)):
        with pytest.raises(ValueError):
            sampling.user_group(bad)


def test_rows_without_a_key_are_in_no_split(spark):
    """As with inner joins on users and items, a null key matches nothing."""
    extra = spark.createDataFrame([(None, 700, 4), (3, None, 4), (None, None, 5)], data.INTERACTION)
    rows_ = data.many(spark)
    config = PrepConfig(fraction=1.0, low_threshold=0)
    assert rows(prep.prep_splits(rows_.unionByName(extra), config)) == rows(prep.prep_splits(rows_, config))
    assert rows(sampling.tag_splits(rows_.unionByName(extra))) == rows(sampling.tag_splits(rows_))


def test_published_split_sizes(spark):
    """Known sizes of the sf0.01 interactions view, seed 42."""
    tagged = prep.prep_splits(star.interactions(spark, "/root/testdata/sf0.01"), PrepConfig(fraction=1.0))
    got = {
        r.split: (r.n_rows, r.n_users, r.n_items, r.total)
        for r in audit.split_counts(tagged)
        .join(tagged.groupBy("split").agg(F.sum("rating").alias("total")), "split")
        .collect()
    }
    assert got == {
        "train": (39274, 1472, 2000, 115681),
        "val": (5292, 318, 1849, 15834),
        "test": (4976, 294, 1832, 14671),
    }


def test_the_input_is_read_once_for_the_splits(spark):
    """Tagged rows and counts per key are staged; later passes do not draw or count again."""
    from tastemill.plans.prep import PrepConfig, prep_splits

    names = []

    def stage(name, df):
        names.append(name)
        return stage_table(name, df)

    facts = data.many(spark).withColumn("is_read", F.lit(0)).withColumn("is_reviewed", F.lit(0))
    got = prep_splits(facts, PrepConfig(fraction=1.0, low_threshold=2), stage)
    assert names == ["tagged", "user-profile", "users", "book_id-profile", "items"]
    assert rows(got) == rows(prep_splits(facts, PrepConfig(fraction=1.0, low_threshold=2), stage_nothing))


def test_a_short_list_of_keys_does_not_shuffle_the_rows(spark):
    """The planner knows that the list is small; it is not the product of two lists."""
    tagged = sampling.tag_splits(data.many(spark))
    plan = splitting.drop_unobserved_items(tagged)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
