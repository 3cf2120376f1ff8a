import hashlib
from decimal import Decimal

import pytest
import data
from conftest import SF, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tastemill.functions.hashing import hash_cut, validate_fraction
from tastemill.functions.ids import int_id
from tastemill.operators import sampling
from tastemill.sources import star


def draw(tag, key, seed=42):
    return int(hashlib.md5(f"{seed}:{tag}:{key}".encode()).hexdigest()[:8], 16) / 2**32


@given(st.integers(0, 2**32 - 1), st.floats(1e-9, 0.999999))
@settings(max_examples=500, deadline=None)
def test_cut_orders_like_the_number(value, fraction):
    digest = f"{value:08x}" + "0" * 24
    assert (digest < hash_cut(fraction)) == (value / 2**32 < fraction)


def test_fraction_is_taken_as_written():
    assert validate_fraction(0.29) == Decimal("0.29")
    assert validate_fraction(0.005) == Decimal("0.005")
    for bad in (0, -0.1, 1.01, 2):
        with pytest.raises(ValueError):
            validate_fraction(bad)


def test_downsample_takes_whole_users(spark):
    large = data.many(spark)
    want = {u for u in range(1, 47) if draw("d", u) < 0.3}
    sample = sampling.downsample(large, 0.3)
    assert {r.user_id for r in sample.collect()} == want
    assert rows(sample) == rows(large.filter(F.col("user_id").isin(list(want))))
    assert sampling.downsample(large, 1) is large


def test_tags_follow_the_draws(spark):
    tagged = sampling.tag_splits(data.many(spark)).collect()
    for row in tagged:
        u = draw("u", row.user_id)
        group = "train" if u < 0.6 else "val" if u < 0.8 else "test"
        held = draw("i", f"{row.user_id}:{row.book_id}") < 0.5
        assert row.split == (group if held else "train")


def test_split_does_not_depend_on_partitioning(spark):
    raw = star.raw_interactions(spark, SF).select("user_id", "book_id", "rating")
    want = rows(sampling.tag_splits(raw))
    for n in (1, 7):
        assert rows(sampling.tag_splits(raw.repartition(n))) == want


def test_seed_changes_the_draw(spark):
    large = data.many(spark)
    assert rows(sampling.tag_splits(large, seed=1)) != rows(sampling.tag_splits(large, seed=2))


def test_row_local_operators_run_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    large = data.many(spark)
    large.write.parquet(path)
    stream = spark.readStream.schema(large.schema).parquet(path)
    query = (
        sampling.tag_splits(sampling.downsample(stream, 0.5))
        .writeStream.format("memory")
        .queryName("tagged_stream")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    assert rows(spark.table("tagged_stream")) == rows(sampling.tag_splits(sampling.downsample(large, 0.5)))


def test_int_id_rejects_what_does_not_fit(spark):
    ids = spark.createDataFrame([(2**31 - 1,), (-(2**31),)], "user_id BIGINT")
    assert ids.select(int_id("user_id")).dtypes == [("user_id", "int")]
    assert rows(ids.select(int_id("user_id"))) == rows(ids)
    with pytest.raises(Exception, match="does not fit INT"):
        spark.createDataFrame([(2**31,)], "user_id BIGINT").select(int_id("user_id")).collect()
