from dataclasses import replace

import data
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tastemill import staging
from tastemill.operators.als import ALSConfig, fit_als, recommend, recommend_long
from tastemill.operators.blend import attach_review_flag
from tastemill.plans import experiments, prep
from tastemill.plans.experiments import Run
from tastemill.plans.prep import PrepConfig
from tastemill.operators.splitting import pick
from tastemill.sources import storage
from tastemill.sources.storage import ArtifactStore

QUICK = ALSConfig(rank=4, reg=0.1, max_iter=3, blocks=2)


@pytest.fixture(scope="module")
def model(spark):
    return fit_als(data.few(spark), QUICK)


def test_recommendations_follow_the_contract(spark, model):
    users = spark.createDataFrame([(1,), (1,), (4,), (999,)], "user_id BIGINT")
    recs = recommend(model, users, 5)
    assert recs.dtypes == [
        ("user_id", "int"),
        ("recommendations", "array<struct<book_id:int,rating:float>>"),
    ]
    found = {r.user_id: r.recommendations for r in recs.collect()}
    assert set(found) == {1, 4}  # a user without factors gets nothing
    for items in found.values():
        scores = [i.rating for i in items]
        assert len({i.book_id for i in items}) == 5 and scores == sorted(scores, reverse=True)


def test_blocked_and_mllib_recommenders_agree(spark, model):
    users = data.few(spark).select("user_id")
    ours, theirs = (
        {r.user_id: r.recommendations for r in recommend(model, users, 13, method).collect()}
        for method in ("blocked", "mllib")
    )
    assert set(ours) == set(theirs)
    for user, items in ours.items():
        want = {i.book_id: i.rating for i in theirs[user]}
        assert {i.book_id for i in items} == set(want)
        assert all(i.rating == pytest.approx(want[i.book_id], abs=1e-5) for i in items)
    with pytest.raises(ValueError):
        recommend(model, users, 3, "other")


def test_same_seed_same_model(spark, model):
    again = fit_als(data.few(spark), QUICK)
    users = data.few(spark).select("user_id")
    assert rows(recommend_long(again, users, 5)) == rows(recommend_long(model, users, 5))


def test_implicit_fit_reads_the_review_flag(spark):
    full = data.few_reviewed(spark)
    config = ALSConfig(rank=4, reg=0.1, implicit=True, blocks=2)
    recs = recommend_long(fit_als(attach_review_flag(data.few(spark), full), config), full, 3)
    assert recs.count() == 24


def test_cold_start_rows_are_dropped(model, spark):
    unknown = spark.createDataFrame([(1, 205), (999, 205), (1, 999)], "user_id INT, book_id INT")
    assert model.transform(unknown).count() == 1


def test_fit_does_not_depend_on_the_layout_of_its_input(spark, model):
    """The number of blocks is a setting, so neither cores nor partitions decide the result."""
    assert ALSConfig().blocks == 10
    again = fit_als(data.few(spark).repartition(7), QUICK)
    users = data.few(spark).select("user_id")
    pairs = [{r[:2] for r in rows(recommend_long(m, users, 5), "user_id", "book_id")} for m in (again, model)]
    assert pairs[0] == pairs[1]


@pytest.fixture(scope="module")
def tagged(spark):
    config = PrepConfig(fraction=1.0, low_threshold=0)
    return storage.materialize(prep.prep_splits(data.many(spark), config), spark, prep_path(spark))


def prep_path(spark):
    from tastemill.session import shared_dir

    return shared_dir(spark, "tagged")


def full_table(spark):
    return data.many(spark).withColumn("is_reviewed", (F.col("rating") > 2).cast("int"))


def test_grid_order_and_results(spark, tagged, tmp_path):
    path = str(tmp_path / "results")
    run = Run(fraction=1.0, k=5, results_path=path)
    result = experiments.tune(pick(tagged, "train"), pick(tagged, "val"), run, (2, 3), (0.01, 1), QUICK).collect()
    assert [(r["rank"], r["lambda"]) for r in result] == [(2, 0.01), (2, 1.0), (3, 0.01), (3, 1.0)]
    assert all(r.k == 5 and r.split == "val" and r.fit_s > 0 for r in result)
    experiments.train_eval(pick(tagged, "train"), pick(tagged, "val"), QUICK, run)
    assert storage.read_results(spark, path).count() == 5


def test_weight_sweep_and_final_test(spark, tagged):
    full, run = full_table(spark), Run(k=5)
    swept = experiments.tune_weight(pick(tagged, "train"), pick(tagged, "val"), full, QUICK, run).collect()
    assert [r.weight for r in swept] == [-1.0, 0.0, 0.5, 1.0, 5.0]
    basic, hybrid = experiments.final_test(tagged, full, run, QUICK).collect()
    assert (basic.split, basic.weight, hybrid.weight) == ("test", 0.0, -1.0)


def test_weight_zero_ranks_like_the_explicit_model(spark, tagged):
    train, users = pick(tagged, "train"), pick(tagged, "val").select("user_id").distinct()
    run = Run(k=5)
    explicit, _ = experiments.hybrid_recs(train, full_table(spark), users, QUICK, run)
    blended = experiments.hybrid_pred(train, full_table(spark), users, QUICK, run, weight=0.0)
    positive = explicit.filter("rating > 0").select("user_id", "book_id", "rank")
    assert rows(positive.join(blended, ["user_id", "book_id", "rank"], "left_anti")) == []


def test_stored_artifacts_are_keyed_by_everything(spark, tagged, tmp_path):
    store = ArtifactStore(spark, str(tmp_path), "fixture")
    train, users = pick(tagged, "train"), pick(tagged, "val").select("user_id").distinct()
    full = full_table(spark)
    run = Run(k=5, store=store)
    explicit, implicit = experiments.hybrid_recs(train, full, users, QUICK, run)
    assert rows(explicit) != rows(implicit)  # the implicit run does not read the explicit lists back
    again, _ = experiments.hybrid_recs(train, full, users, QUICK, run)
    assert rows(again) == rows(explicit)
    keys = [store.path("recs", k=5), store.path("recs", k=6), store.path("models", k=5)]
    other = ArtifactStore(spark, str(tmp_path), "other data").path("recs", k=5)
    assert len({*keys, other}) == 4


@pytest.mark.parametrize("change", [{"low_threshold": 4}, {"seed": 7}, {"rm_zeros": False}, {"share": 0.3}, {"weights": (0.4, 0.3, 0.3)}])
def test_another_preparation_is_not_served_from_the_store(spark, tmp_path, change):
    facts, config = data.many(spark), PrepConfig(fraction=1.0, low_threshold=0)

    def lists(prepared, folder):
        tagged = prep.prep_splits(facts, prepared)
        run = Run(k=5, store=ArtifactStore(spark, folder, "many"), prep=prepared)
        users = pick(tagged, "val").select("user_id").distinct()
        return rows(experiments.get_recs(pick(tagged, "train"), users, QUICK, run), "user_id", "book_id", "rank")

    lists(config, str(tmp_path / "shared"))
    changed = replace(config, **change)
    assert lists(changed, str(tmp_path / "shared")) == lists(changed, str(tmp_path / "fresh"))


def test_laps_of_stored_runs(spark, tagged, tmp_path):
    run = Run(k=5, store=ArtifactStore(spark, str(tmp_path), "many"))
    first, again = (experiments.train_eval(pick(tagged, "train"), pick(tagged, "val"), QUICK, run).first() for _ in range(2))
    assert first.fit_s > 0 and again.fit_s == 0 and first.rec_s > again.rec_s > 0
    liked = pick(tagged, "val").filter("rating > 3").select("user_id").distinct()
    assert first.users == again.users == liked.count()


@pytest.mark.parametrize("most,blocks", [(10**6, 2), (20, 9)])
def test_blocks_and_shuffles_of_a_fit_are_bounded(spark, monkeypatch, most, blocks):
    """Blocks hold a bounded number of ratings, whatever the data; each iteration lets go of the shuffles before it."""
    from tastemill.operators import als

    made, whole = {}, als.ALS

    def seen(**settings):
        made.update(settings)
        return whole(**settings)

    monkeypatch.setattr(als, "ALS", seen)
    monkeypatch.setattr(als, "RATINGS_PER_BLOCK", most)
    ratings = data.many(spark).limit(180)
    n = ratings.count()
    model = fit_als(ratings, QUICK)
    assert n == 180 and model.userFactors.count() == ratings.select("user_id").distinct().count()
    assert made["numUserBlocks"] == made["numItemBlocks"] == blocks
    assert made["checkpointInterval"] == 1 and ALSConfig().checkpoint_interval == 1


def test_how_often_lineage_is_cut_does_not_change_a_fit(spark):
    """A checkpoint is about files, not about what is fitted."""
    from dataclasses import replace

    models = [fit_als(data.few(spark), replace(QUICK, max_iter=6, checkpoint_interval=every)) for every in (1, 5)]
    first, second = (rows(m.userFactors) for m in models)
    assert [r[0] for r in first] == [r[0] for r in second]
    assert all(abs(x - y) < 1e-5 for a, b in zip(first, second) for x, y in zip(a[1], b[1]))


def test_garbage_is_collected_while_a_fit_runs(spark, monkeypatch):
    """Shuffles that nothing reads any more go while the step still runs, not half an hour later."""
    import os
    import time

    monkeypatch.setattr(staging, "COLLECT_EVERY", 0.2)
    folder = spark.conf.get("spark.checkpoint.dir")
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return sum(str(f).endswith(".data") for f in local.getAllFiles().mkString("\n").splitlines())

    assert os.path.isdir(folder)
    with staging.collected(spark):
        time.sleep(3)
        before = files()
        for _ in range(3):
            spark.range(1_000).repartition(3, "id").write.format("noop").mode("overwrite").save()
        for _ in range(60):
            if files() <= before:
                break
            time.sleep(0.5)
        assert files() <= before
