"""Wide explicit fits: the same normal equations from smaller systems."""

import os

import numpy as np
import pytest
from data import many

from tastemill import staging
from tastemill.operators import als, als_wide
from tastemill.operators.als import ALSConfig, fit_als
from tastemill.operators.als_check import fit_check
from tastemill.session import shared_root
from tastemill.sources.storage import ArtifactStore
from tastemill.staging import scratch


@pytest.mark.parametrize("n", [1, 5, 8, 9, 40])
def test_the_smaller_system_has_the_same_solution(n):
    rng = np.random.default_rng(n)
    vectors, ratings = rng.standard_normal((n, 8)), rng.standard_normal(n)
    system = als_wide.System(8, 0.1)
    for a in range(0, n, 3):
        system.add(vectors[a : a + 3], ratings[a : a + 3])
    want = np.linalg.solve(vectors.T @ vectors + 0.1 * n * np.eye(8), vectors.T @ ratings)
    assert np.allclose(system.solution(), want)
    assert system.n_held <= 8


def test_a_wide_fit_solves_its_equations(spark, monkeypatch, tmp_path):
    """Without MLlib's solver, whose cost grows with the third power of the rank."""
    monkeypatch.setattr(als.ALS, "fit", lambda *_: pytest.fail("MLlib's solver"))
    rows, config = many(spark).filter("rating > 0"), ALSConfig(rank=150, reg=0.1, max_iter=2)
    model = fit_als(rows, config)
    n_users = rows.select("user_id").distinct().count()
    assert fit_check(model, rows, config).first().asDict() == {"users": n_users, "above": 0}
    stored = ArtifactStore(spark, str(tmp_path), "/root/testdata/sf0.001").model(lambda: model, kind="wide")
    assert stored.rank == 150 and stored.itemFactors.count() == rows.select("book_id").distinct().count()


def test_a_wide_fit_in_parts_is_the_same(spark, monkeypatch):
    """Steps are made in parts of bounded size; no step's files outlive the next one, and shuffles go with their part."""
    rows, config = many(spark).filter("rating > 0"), ALSConfig(rank=150, reg=0.1, max_iter=3)
    seen, stage = [], als_wide.stage_parts

    def staged(path, frames):
        there = {name for name in os.listdir(shared_root(spark)) if name.startswith("stage-factors")}
        frames = list(frames)
        seen.append((len(frames), len(there - before)))
        return stage(path, frames)

    def factors():
        model = fit_als(rows, config)
        return [sorted((r.id, tuple(r.features)) for r in side.collect()) for side in (model.userFactors, model.itemFactors)]

    with scratch(spark):
        whole = factors()
        before = set(os.listdir(shared_root(spark)))
        monkeypatch.setattr(als_wide, "stage_parts", staged)
        monkeypatch.setattr(staging, "PASS_BYTES", rows.count() * 150 * 4 // 3)
        parted = factors()
    for a, b in zip(whole, parted):
        assert [r[0] for r in a] == [r[0] for r in b] and np.allclose([r[1] for r in a], [r[1] for r in b], rtol=1e-4, atol=1e-5)
    assert max(n for n, _ in seen) >= 3 and len(seen) == 7
    assert max(held for _, held in seen) <= 2


def test_shuffles_of_a_part_are_removed(spark):
    """The option is on while parts are written, also by several threads, and as it was before after that."""
    before = spark.conf.get(staging.CLEANUP)
    with staging.shuffles_removed(spark):
        with staging.shuffles_removed(spark):
            assert spark.conf.get(staging.CLEANUP) == "true"
        assert spark.conf.get(staging.CLEANUP) == "true"
    assert spark.conf.get(staging.CLEANUP) == before != "true"
