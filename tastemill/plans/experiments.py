"""Fit, recommend, evaluate: single runs, grids and sweeps.

The driver loops over configurations only. Each iteration is a set of Spark
jobs, and what comes back to the driver is one row of metrics.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone

from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.operators.als import ALSConfig, fit_als, recommend_long
from tastemill.operators.blend import (
    DEFAULT_WEIGHTS,
    WEIGHT,
    attach_review_flag,
    hybrid_top_k,
    weight_sweep,
)
from tastemill.operators.labels import eval_users_and_labels
from tastemill.operators.metrics import evaluate
from tastemill.operators.sampling import downsample
from tastemill.operators.splitting import final_fit_frame, pick
from tastemill.operators.topk import as_lists
from tastemill.plans.prep import PrepConfig
from tastemill.plans.together import run_together
from tastemill.schema import ITEM, RESULTS_DDL, REVIEWED, TEST, USER, VAL
from tastemill.sources.storage import ArtifactStore, commit_results
from tastemill.staging import scratch

#: The published grid (fixed values); a full grid of 16 fits.
GRID_RANKS = (10, 20, 100, 500)
GRID_REGS = (0.01, 0.1, 1.0, 10.0)
FINAL_REG, FINAL_WEIGHT = 0.01, -1.0


@dataclass(frozen=True)
class Run:
    """Where results belong: the sample, the evaluated split, and what may be stored.

    ``prep`` is the preparation that the splits come from. All of it is part of
    the key of every stored artifact, so another threshold, seed or rule is never
    served from an earlier one; a store without it must hold one preparation only.
    """

    fraction: float = 1.0
    split: str = VAL
    k: int = 500
    store: ArtifactStore | None = None
    results_path: str | None = None
    prep: PrepConfig | None = None
    #: Also evaluate with MLlib's evaluator; results then say by how much the metrics differ (``off_by``).
    cross_check: bool = False

    def tag(self) -> dict:
        return {"fraction": self.fraction, "split": self.split, "prep": asdict(self.prep) if self.prep else None}


@contextmanager
def persisted(*frames: DataFrame):
    """Keep frames for the length of a block; lost blocks are recomputed."""
    fresh = [frame.persist() for frame in frames if not frame.is_cached]
    try:
        yield frames
    finally:
        for frame in fresh:
            frame.unpersist()


class Stopwatch:
    def __init__(self):
        self.seconds: dict[str, float] = {"fit_s": 0.0, "rec_s": 0.0, "eval_s": 0.0}

    @contextmanager
    def lap(self, name: str):
        start = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] += time.monotonic() - start


def get_recs(
    train: DataFrame, users: DataFrame, config: ALSConfig, run: Run, watch: Stopwatch | None = None
) -> DataFrame:
    """Ranked recommendation rows for ``users``.

    With a store: stored recommendations first, then a stored model, then a fit.
    Keys hold the whole configuration, the model type included.
    """
    watch = watch or Stopwatch()
    key = {**run.tag(), **asdict(config)}
    if run.store is None:
        with watch.lap("fit_s"):
            model = fit_als(train, config)
        return recommend_long(model, users, run.k)
    if not run.store.has("recs", k=run.k, **key):
        with watch.lap("fit_s"):
            model = run.store.model(lambda: fit_als(train, config), **key)
        with watch.lap("rec_s"):
            run.store.frame("recs", lambda: recommend_long(model, users, run.k), k=run.k, **key)
    return run.store.frame("recs", _must_exist, k=run.k, **key)


def _must_exist() -> DataFrame:
    raise FileNotFoundError("a stored table has gone meanwhile")


def off_by(ranked: DataFrame, labels: DataFrame, k: int, metrics, min_len: int = 1) -> float:
    """Largest difference of ``metrics`` from those that MLlib's evaluator finds for the same lists."""
    lists = as_lists(ranked).filter(F.size(ITEM) >= min_len)
    liked = labels.groupBy(USER).agg(F.collect_set(ITEM).alias("liked"))
    pairs = lists.join(liked, USER).select(F.col(ITEM).cast("array<double>").alias("prediction"), F.col("liked").cast("array<double>").alias("label"))
    names = {"map": "meanAveragePrecision", "ndcg": "ndcgAtK", "precision": "precisionAtK"}
    with persisted(pairs):
        return max(abs(RankingEvaluator(metricName=name, k=k).evaluate(pairs) - metrics[own]) for own, name in names.items())


def _result_row(run: Run, config: ALSConfig, weight: float, metrics, watch: Stopwatch, difference: float | None = None) -> tuple:
    return (
        datetime.now(timezone.utc).replace(tzinfo=None),
        float(run.fraction),
        run.split,
        run.k,
        config.rank,
        float(config.reg),
        float(weight),
        metrics["users"],
        metrics["map"],
        metrics["ndcg"],
        metrics["precision"],
        *(watch.seconds[name] for name in ("fit_s", "rec_s", "eval_s")),
        difference,
    )


def _record(spark: SparkSession, run: Run, config: ALSConfig, kind: str, row: tuple, weight: float = 0.0) -> tuple:
    """Commit one result at once, so that a later failure does not lose it; the same run again replaces it."""
    if run.results_path:
        commit_results(spark, run.results_path, [row], kind=kind, weight=weight, k=run.k, **run.tag(), **asdict(config))
    return row


def fit_bytes(config: ALSConfig, n_users: int, n_items: int, n_ratings: int) -> float:
    """About what a fit holds at its peak: ratings in both orders, factors, and the messages of an iteration."""
    return 2 * 16.0 * n_ratings + 3 * 4.0 * config.rank * (n_users + n_items)


def _results(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RESULTS_DDL)


def _score(
    ranked: DataFrame,
    labels: DataFrame,
    run: Run,
    config: ALSConfig,
    watch: Stopwatch,
    weight: float = 0.0,
    min_len: int = 1,
) -> tuple:
    """Time and evaluate one set of ranked rows."""
    with persisted(ranked):
        with watch.lap("rec_s"):
            ranked.count()
        with watch.lap("eval_s"):
            metrics = evaluate(ranked, labels, run.k, min_len=min_len).first()
        difference = off_by(ranked, labels, run.k, metrics, min_len) if run.cross_check else None
    return _result_row(run, config, weight, metrics, watch, difference)


def _fit_and_score(
    train: DataFrame, users: DataFrame, labels: DataFrame, config: ALSConfig, run: Run
) -> tuple:
    watch = Stopwatch()
    return _score(get_recs(train, users, config, run, watch), labels, run, config, watch)


def train_eval(train: DataFrame, held: DataFrame, config: ALSConfig, run: Run) -> DataFrame:
    """One configuration; one row of the results table."""
    users, labels = eval_users_and_labels(held)
    spark = train.sparkSession
    with scratch(spark), persisted(train):
        row = _fit_and_score(train, users, labels, config, run)
    return _results(spark, [_record(spark, run, config, "single", row)])


def tune(
    train: DataFrame,
    held: DataFrame,
    run: Run,
    ranks: Sequence[int] = GRID_RANKS,
    regs: Sequence[float] = GRID_REGS,
    base: ALSConfig = ALSConfig(),
    parallel: int = 1,
    memory: float = float("inf"),
) -> DataFrame:
    """Grid over rank and regularization; the latter varies fastest, ranks grow.

    ``parallel`` fits run at a time as long as, by ``fit_bytes``, they hold no more than ``memory`` bytes
    together. Results come in the order of the grid, whatever finishes first.
    """
    users, labels = eval_users_and_labels(held)
    spark = train.sparkSession
    grid = [replace(base, rank=rank, reg=float(reg)) for rank, reg in itertools.product(ranks, regs)]
    with persisted(train, users, labels):
        # Cached once, before several fits ask for it.
        n = train.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(USER).alias("users"), F.approx_count_distinct(ITEM).alias("items")).first()

        def job(config: ALSConfig) -> tuple:
            with scratch(spark):
                row = _fit_and_score(train, users, labels, config, run)
            return _record(spark, run, config, "single", row)

        costs = [fit_bytes(config, n.users, n.items, n.rows) for config in grid]
        rows = run_together(spark, [lambda config=config: job(config) for config in grid], parallel, costs, memory)
    return _results(spark, rows)


def review_split(train: DataFrame, full: DataFrame, run: Run) -> DataFrame:
    """The train rows with their review flag, stored if there is a store.

    Rows that carry the flag are taken as they are, without a join. The flag of a sample needs the sample's users only: the full table is cut
    down to them, row by row, before it is aggregated.
    """
    if REVIEWED in train.columns:
        return train
    if run.prep:
        full = downsample(full, run.prep.fraction, run.prep.seed)

    def build() -> DataFrame:
        return attach_review_flag(train, full)

    return build() if run.store is None else run.store.frame("reviews", build, **run.tag())


def hybrid_recs(
    train: DataFrame,
    full: DataFrame,
    users: DataFrame,
    config: ALSConfig,
    run: Run,
    watch: Stopwatch | None = None,
    implicit_watch: Stopwatch | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Explicit recommendations from ratings, implicit ones from review flags."""
    with persisted(train, review_split(train, full, run)) as (ratings, reviews):
        explicit = get_recs(ratings, users, replace(config, implicit=False), run, watch)
        implicit = get_recs(reviews, users, replace(config, implicit=True), run, implicit_watch or watch)
    return explicit, implicit


def hybrid_pred(
    train: DataFrame, full: DataFrame, users: DataFrame, config: ALSConfig, run: Run, weight: float = 1.0, watch: Stopwatch | None = None
) -> DataFrame:
    """The k best blended items per user, as ranked rows."""
    explicit, implicit = hybrid_recs(train, full, users, config, run, watch)
    return hybrid_top_k(explicit, implicit, run.k, weight)


def tune_weight(
    train: DataFrame,
    held: DataFrame,
    full: DataFrame,
    config: ALSConfig,
    run: Run,
    weights: Sequence[float] = DEFAULT_WEIGHTS,
) -> DataFrame:
    """Metrics per blend weight; both models are fitted once."""
    users, labels = eval_users_and_labels(held)
    watch = Stopwatch()
    with scratch(train.sparkSession):
        explicit, implicit = hybrid_recs(train, full, users, config, run, watch)
        with persisted(explicit, implicit):
            with watch.lap("rec_s"):
                explicit.count()
                implicit.count()
            with watch.lap("eval_s"):
                swept = weight_sweep(explicit, implicit, labels, run.k, weights).collect()
            found = {row[WEIGHT]: row for row in swept}
            off = {}
            for w in found if run.cross_check else ():
                off[w] = off_by(hybrid_top_k(explicit, implicit, run.k, w), labels, run.k, found[w], run.k)
    empty = {"users": 0, "map": None, "ndcg": None, "precision": None}
    spark = train.sparkSession
    return _results(spark, [_record(spark, run, config, "hybrid", _result_row(run, config, w, found.get(float(w), empty), watch, off.get(float(w))), float(w)) for w in weights])


def final_test(
    tagged: DataFrame,
    full: DataFrame,
    run: Run,
    config: ALSConfig = ALSConfig(reg=FINAL_REG),
    weight: float = FINAL_WEIGHT,
) -> DataFrame:
    """Fit on train and val, score the basic and the hybrid lists on test."""
    run = replace(run, split=TEST)
    train, held = final_fit_frame(tagged), pick(tagged, TEST)
    users, labels = eval_users_and_labels(held)
    spark = tagged.sparkSession
    with scratch(spark), persisted(train, users, labels):
        # A watch for each row: the hybrid one has both models' times, and its own evaluation only.
        watch, other = Stopwatch(), Stopwatch()
        explicit, implicit = hybrid_recs(train, full, users, config, run, watch, other)
        with persisted(explicit):
            basic = _record(spark, run, config, "single", _score(explicit, labels, run, config, watch))
            for name in ("fit_s", "rec_s"):
                other.seconds[name] += watch.seconds[name]
            blended = hybrid_top_k(explicit, implicit, run.k, weight)
            hybrid = _record(spark, run, config, "hybrid", _score(blended, labels, run, config, other, weight, min_len=run.k), weight)
    return _results(spark, [basic, hybrid])
