"""``spark-submit`` entry point: ``task fraction k [rank] [reg]``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tastemill.operators.als import ALSConfig
from tastemill.operators.splitting import pick
from tastemill.plans.experiments import FINAL_REG, GRID_RANKS, GRID_REGS, Run, final_test, tune, tune_weight
from tastemill.plans.prep import PrepConfig, load_splits, save_splits
from tastemill.schema import ITEM, REVIEWED, TRAIN, USER, VAL
from tastemill.session import build_session
from tastemill.sources.scans import read_csv, read_parquet
from tastemill.sources.storage import ArtifactStore, identity, materialize

TASKS = ("tune", "hybrid-tune", "test", "save-splits")


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tastemill")
    parser.add_argument("task", choices=TASKS)
    parser.add_argument("fraction", type=float)
    parser.add_argument("k", type=int)
    parser.add_argument("rank", type=int, nargs="?", default=10)
    parser.add_argument("reg", type=float, nargs="?", default=None)
    parser.add_argument("--interactions", required=True, help="CSV file or Parquet table")
    parser.add_argument("--work", required=True, help="shared folder for stored artifacts and results")
    parser.add_argument("--low-threshold", type=int, default=10)
    parser.add_argument("--parallel", type=int, default=1, help="fits of a grid at a time")
    args = parser.parse_args(argv)
    if args.task == "hybrid-tune" and args.reg is None:
        parser.error("hybrid-tune needs rank and reg")
    return args


def load_interactions(spark: SparkSession, path: str, work: str) -> DataFrame:
    """The input as Parquet ordered by user; a CSV is converted once."""
    if not path.lower().endswith((".csv", ".csv.gz")):
        return read_parquet(spark, path)
    target = f"{work}/interactions/{identity(spark, path)}"
    return materialize(lambda: read_csv(spark, "interactions", path), spark, target, (USER, ITEM), replace_incomplete=True)


def run_task(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    full = load_interactions(spark, args.interactions, args.work)
    store = ArtifactStore(spark, args.work, identity(spark, args.interactions))
    if args.task == "save-splits":
        return save_splits(full, store, low_threshold=args.low_threshold, carry=(REVIEWED,))
    config = PrepConfig(args.fraction, low_threshold=args.low_threshold, carry=(REVIEWED,))
    tagged = load_splits(full, config, store)
    run = Run(args.fraction, VAL, args.k, store, f"{args.work}/results", config)
    train, val = pick(tagged, TRAIN), pick(tagged, VAL)
    if args.task == "tune":
        return tune(train, val, run, ranks=GRID_RANKS, regs=GRID_REGS, parallel=args.parallel)
    if args.task == "hybrid-tune":
        return tune_weight(train, val, full, ALSConfig(args.rank, args.reg), run)
    reg = FINAL_REG if args.reg is None else args.reg
    return final_test(tagged, full, run, ALSConfig(args.rank, reg))


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = build_session(f"tastemill-{args.task}-{args.fraction}")
    run_task(spark, args).show(100, truncate=False)


if __name__ == "__main__":
    main()
