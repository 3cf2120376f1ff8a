"""Concurrent fits, leases, committed results and the life of staged tables."""

import os
import threading
import time
from dataclasses import replace

import data
import pytest

from tastemill import staging
from tastemill.operators.als import ALSConfig
from tastemill.plans import catalog, experiments, prep
from tastemill.plans.experiments import Run
from tastemill.plans.together import run_together
from tastemill.operators.splitting import pick
from tastemill.session import shared_root
from tastemill.sources import lease as leases
from tastemill.sources import star, storage
from tastemill.sources.storage import ArtifactStore

SF = "/root/testdata/sf0.001"
QUICK = ALSConfig(rank=2, reg=0.1, max_iter=2, blocks=2)


def row(value):
    return (None, 1.0, "val", 5, 2, 0.1, 0.0, value, 0.5, 0.5, 0.5, 1.0, 1.0, 1.0, None)


def test_results_come_in_order_and_together(spark):
    inside, most = [0], [0]
    gate = threading.Lock()

    def job(k):
        with gate:
            inside[0] += 1
            most[0] = max(most[0], inside[0])
        time.sleep(0.2 if k == 0 else 0.05)
        assert spark.range(10).count() == 10
        with gate:
            inside[0] -= 1
        return k

    assert run_together(spark, [lambda k=k: job(k) for k in range(9)], 3) == list(range(9))
    assert most[0] == 3


def test_costs_stay_within_the_budget(spark):
    held, most = [0.0], [0.0]
    gate = threading.Lock()

    def job(cost):
        with gate:
            held[0] += cost
            most[0] = max(most[0], held[0])
        time.sleep(0.05)
        with gate:
            held[0] -= cost

    costs = [4, 4, 4, 4, 30, 4]
    run_together(spark, [lambda c=c: job(c) for c in costs], 6, costs, 10)
    assert most[0] == 30  # the large one, alone
    most[0] = 0.0
    run_together(spark, [lambda c=c: job(c) for c in costs[:4]], 4, costs[:4], 10)
    assert most[0] <= 10


def test_one_failure_cancels_the_others(spark):
    def slow():
        def wait(batches):
            time.sleep(60)
            yield from batches

        return spark.range(1).mapInArrow(wait, "id bigint").count()

    def fail():
        time.sleep(1)
        raise ValueError("broken")

    start = time.monotonic()
    with pytest.raises(ValueError, match="broken"):
        run_together(spark, [slow, fail, slow, slow], 2)
    assert time.monotonic() - start < 40


def test_a_parallel_grid_equals_a_sequential_one(spark):
    tagged = prep.prep_splits(data.many(spark), prep.PrepConfig(1.0, low_threshold=0))
    tagged = storage.materialize(tagged, spark, f"{shared_root(spark)}/grid-input")
    grids = [experiments.tune(pick(tagged, "train"), pick(tagged, "val"), Run(k=5), (2, 3), (0.01, 1), QUICK, parallel=n).drop("ts", "fit_s", "rec_s", "eval_s").collect() for n in (1, 3)]
    assert grids[0] == grids[1] and len(grids[0]) == 4


def test_two_writers_build_once(spark, tmp_path):
    store, built = ArtifactStore(spark, str(tmp_path), "x"), []

    def build():
        built.append(threading.current_thread().name)
        time.sleep(1)
        return spark.range(5)

    def read(found, k):
        found[k] = store.frame("table", build, ("id",), key=1).count()

    found: dict[int, int] = {}
    threads = [threading.Thread(target=read, args=(found, k)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found == {0: 5, 1: 5, 2: 5} and len(built) == 1
    assert not [f for f in os.listdir(tmp_path / "table") if "lease" in f]


def test_a_dead_holder_is_replaced(spark, tmp_path):
    path = str(tmp_path / "a")
    files, target = leases._file_system(spark, f"{path}.lease")
    files.mkdirs(target.getParent())
    files.createNewFile(target)
    files.setTimes(target, int((time.time() - 500) * 1000), -1)
    with leases.lease(spark, path, lambda: False, expiry=100) as mine:
        assert mine
    assert not os.path.exists(f"{path}.lease")
    # A living one is waited for.
    files.createNewFile(target)
    finished = threading.Event()
    threading.Timer(1.0, finished.set).start()
    with leases.lease(spark, path, finished.is_set, expiry=100, look=0.1) as mine:
        assert not mine


def test_a_lease_is_renewed_and_returned_after_failure(spark, tmp_path):
    path = str(tmp_path / "b")
    with pytest.raises(ValueError):
        with leases.lease(spark, path, lambda: False, expiry=1.0):
            before = os.path.getmtime(f"{path}.lease")
            time.sleep(1.5)
            assert os.path.getmtime(f"{path}.lease") > before
            raise ValueError
    assert not os.path.exists(f"{path}.lease")


def test_a_killed_and_repeated_run_is_one_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "results")
    assert storage.read_results(spark, path).count() == 0
    storage.commit_results(spark, path, [row(1)], rank=2)

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(storage, "rename", killed)
        with pytest.raises(KeyboardInterrupt):
            storage.commit_results(spark, path, [row(2)], rank=3)
    assert [r.users for r in storage.read_results(spark, path).collect()] == [1]
    storage.commit_results(spark, path, [row(3)], rank=3)
    storage.commit_results(spark, path, [row(4)], rank=2)
    assert sorted(r.users for r in storage.read_results(spark, path).collect()) == [3, 4]


def test_results_are_checked_by_mllib(spark):
    tagged = prep.prep_splits(data.many(spark), prep.PrepConfig(1.0, low_threshold=0))
    result = experiments.train_eval(pick(tagged, "train"), pick(tagged, "val"), QUICK, replace(Run(k=40), cross_check=True)).first()
    assert result.off_by < 1e-9 and result.map > 0


def test_staged_tables_go_with_their_owner(spark):
    root = shared_root(spark)
    before = set(os.listdir(root))
    with staging.scratch(spark):
        table = staging.stage_table("kept", spark.range(10))
        with staging.scratch(spark):
            inner = staging.stage_table("inner", table)
            assert inner.count() == 10
        assert table.count() == 10
        left = {f for f in set(os.listdir(root)) - before if f.startswith("stage-")}
        assert len(left) == 1
    with pytest.raises(ValueError):
        with staging.scratch(spark):
            staging.stage_table("failed", spark.range(10))
            raise ValueError
    assert not {f for f in set(os.listdir(root)) - before if f.startswith("stage-")}


def test_an_evaluation_leaves_nothing_behind(spark):
    tagged = prep.prep_splits(data.many(spark), prep.PrepConfig(1.0, low_threshold=0)).persist()
    tagged.count()
    before = set(os.listdir(shared_root(spark)))
    experiments.train_eval(pick(tagged, "train"), pick(tagged, "val"), QUICK, Run(k=5))
    assert not {f for f in set(os.listdir(shared_root(spark))) - before if f.startswith("stage-")}
    tagged.unpersist()


def test_baskets_are_dealt_by_key_before_they_are_grouped(spark, monkeypatch):
    """No map task groups its split: keys hardly repeat, so it would hold nearly all of its rows. Tasks grow with the rows."""
    monkeypatch.setattr(star, "ROWS_PER_TASK", 100)
    plan = star.baskets(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("HashAggregate") < plan.index("Exchange")
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert star.baskets(spark, SF).rdd.getNumPartitions() == -(-rows // 100)


def test_the_same_experiment_twice_is_fitted_once(spark, monkeypatch):
    fits = []
    fit = experiments.fit_als
    monkeypatch.setattr(experiments, "fit_als", lambda *args: fits.append(args) or fit(*args))
    assert catalog.builders()["experiment_results"](spark, SF).count() == 1
    assert len(fits) == 1
