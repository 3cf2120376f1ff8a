import os

import pytest
import data
from conftest import SF, rows
from pyspark.sql import functions as F

from tastemill import session
from tastemill.plans import cli, prep
from tastemill.plans.experiments import tune as cli_tune
from tastemill.sources import scans, star, storage
from tastemill.sources.storage import ArtifactStore, materialize


def test_csv_scans(spark, tmp_path):
    star.interactions(spark, SF).write.csv(str(tmp_path / "i"), header=True)
    back = scans.read_csv(spark, "interactions", str(tmp_path / "i"))
    assert back.dtypes == [(c, "int") for c in ("user_id", "book_id", "is_read", "rating", "is_reviewed")]
    assert rows(back) == rows(star.interactions(spark, SF), *back.columns)
    star.user_map(spark, SF).write.csv(str(tmp_path / "u"), header=True)
    assert rows(scans.read_csv(spark, "users", str(tmp_path / "u"))) == rows(star.user_map(spark, SF))
    with pytest.raises(ValueError):
        scans.read_csv(spark, "authors", str(tmp_path / "u"))


def test_materialize_writes_once(spark, tmp_path):
    path = str(tmp_path / "t")
    small = data.few(spark)
    assert rows(materialize(small, spark, path)) == rows(small)

    def never():
        raise AssertionError("the table exists")

    assert rows(materialize(never, spark, path)) == rows(small)


def test_files_are_ordered_by_user_and_a_hot_user_spreads(spark, tmp_path):
    hot = spark.range(20_000).select(F.lit(5).alias("user_id"), F.col("id").cast("int").alias("book_id"))
    rest = spark.range(100).select(F.col("id").cast("int").alias("user_id"), F.lit(1).alias("book_id"))
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = materialize(hot.unionByName(rest), spark, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = (
        stored.withColumn("f", F.input_file_name())
        .groupBy("f")
        .agg(F.min("user_id").alias("lo"), F.max("user_id").alias("hi"), F.count_if(F.col("user_id") == 5).alias("hot"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:]))
    assert sum(r.hot > 0 for r in per_file) > 1


def test_unfinished_table_is_not_read_and_not_overwritten(spark, tmp_path):
    path = str(tmp_path / "t")
    small = data.few(spark)
    small.write.parquet(path)
    os.remove(f"{path}/_SUCCESS")
    with pytest.raises(FileExistsError):
        materialize(small, spark, path)
    assert rows(materialize(small, spark, path, replace_incomplete=True)) == rows(small)


def test_other_errors_are_not_taken_for_a_missing_table(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "_SUCCESS").touch()
    (path / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        materialize(data.few(spark), spark, str(path)).collect()


def test_stored_splits_are_read_by_split(spark, tmp_path):
    store = ArtifactStore(spark, str(tmp_path), "large")
    config = prep.PrepConfig(fraction=1.0, low_threshold=0)
    tagged = prep.load_splits(data.many(spark), config, store)
    assert rows(tagged, "user_id", "book_id", "rating", "split") == rows(
        prep.prep_splits(data.many(spark), config), "user_id", "book_id", "rating", "split"
    )
    plan = tagged.filter("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert rows(prep.load_splits(data.few(spark), config, store)) == rows(tagged)


def test_save_splits_summary(spark, tmp_path):
    store = ArtifactStore(spark, str(tmp_path), "large")
    summary = prep.save_splits(data.many(spark), store, fractions=(0.5, 1.0), low_threshold=4)
    assert {r.fraction for r in summary.collect()} == {0.5, 1.0}


def test_shared_root_comes_from_the_session(spark):
    assert session.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark, "a") != session.shared_dir(spark, "a")


class FakeSession:
    """A cluster session without a shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(FakeSession)


def test_arguments():
    args = cli.parse_args(["test", "0.05", "20", "10", "--interactions", "i", "--work", "w"])
    assert (args.task, args.fraction, args.k, args.rank, args.reg) == ("test", 0.05, 20, 10, None)
    for bad in (["predict", "1", "5"], ["hybrid-tune", "1", "5", "10"]):
        with pytest.raises(SystemExit):
            cli.parse_args([*bad, "--interactions", "i", "--work", "w"])


@pytest.fixture(scope="module")
def csv_input(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "interactions.csv")
    star.interactions(spark, SF).write.csv(path, header=True)
    return path


@pytest.mark.parametrize("task", cli.TASKS)
def test_every_task_runs(spark, csv_input, tmp_path, monkeypatch, task):
    small_grid = {"ranks": (2,), "regs": (0.1,)}
    monkeypatch.setattr(cli, "tune", lambda *a, **k: cli_tune(*a, **small_grid))
    args = cli.parse_args([task, "1", "5", "2", "0.1", "--interactions", csv_input, "--work", str(tmp_path)])
    result = cli.run_task(spark, args)
    want = {"tune": 1, "hybrid-tune": 5, "test": 2, "save-splits": 12}[task]
    got = result.count()
    assert got == want or (task == "save-splits" and 0 < got <= want)
    if task in ("tune", "hybrid-tune", "test"):
        assert storage.read_results(spark, f"{tmp_path}/results").count() == want



def test_staged_rows_of_few_bytes_are_spread(spark):
    """However little a row takes, no task reads tens of millions of a staged table."""
    from pyspark.sql import functions as F

    from tastemill.staging import ROWS_PER_FILE, stage_table

    staged = stage_table("narrow", spark.range(0, 8 * ROWS_PER_FILE, 1, 1).selectExpr("CAST(id % 3 AS INT) AS a"))
    parts = staged.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 8 * ROWS_PER_FILE
    assert max(r["count"] for r in parts) <= 2 * ROWS_PER_FILE
