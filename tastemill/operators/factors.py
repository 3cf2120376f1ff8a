"""Exact top-k items per user by dot product of given factors: maximum inner product search.

Items are put in order of their norms and cut into blocks. By Cauchy and Schwarz no
score of a block exceeds the user's norm times the block's largest norm, so a user
whose k-th best score is above that needs neither this block nor any later one.

1. *Seed.* The items with the largest norms, a bounded number, go to all tasks. Every
   user's k-th best score among them says how far down the blocks the user has to look.
2. *Blocks.* Users are put in order of that depth and cut into blocks, so that users
   who look equally far stand together. A block of users gets the item blocks that one
   of its users needs, and no others.
3. *Walk.* One task per user block takes them in order of their norms, as a sorted
   stream. It keeps k rows per user, and its rising k-th best scores, which start
   from the seed's, close blocks that the seed had left open. Nothing is merged
   afterwards: a user's list is complete.

Users who have to look far stand together, so one user block may have most of the
work. A block with more than a task's share is cut into strips of item blocks, each
walked by a task of its own; only then are k rows per user and strip merged.

Each user block is sent the item blocks it needs. If that is more than ``PASS_BYTES``
in all, user blocks are walked in passes, whose results are written and whose shuffles go.

With equal norms and scores far below them nothing can be skipped, and the work is
that of all products; the result is exact in any case.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill import staging
from tastemill.operators.topk import RANK, top_k
from tastemill.schema import ITEM, RATING, USER
from tastemill.staging import scratch_dir, stage_parts, stage_table

Batches = Iterator[pa.RecordBatch]

#: Bytes of factors in an item block, and the most blocks there are (what a task knows of all blocks is 8 bytes each).
BLOCK_BYTES, MAX_BLOCKS = 4 * 2**20, 65_536
#: Rows of results that a task holds, those that it sorts at once, and scores that it computes at once.
ROWS_PER_RESULT, ROWS_PER_GROUP, SCORES_PER_BATCH = 4_000_000, 200_000, 500_000
#: Units for each task that a large user block could keep busy, and products below which none is cut.
STRIPS_PER_TASK, LEAST_WORK = 4, 1e8
#: Bytes of a row that is sent to a unit, without its factors.
ROW_BYTES = 56
#: Items of the seed, if k is not larger.
SEED_ITEMS = 2_048
#: Relative room for rounding in a norm times a norm.
ROUNDING = 1e-9


def _matrix(features: pa.Array) -> np.ndarray:
    """Rows of factors in double precision."""
    flat = features.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(features), -1)


def _norm(features: str) -> Column:
    zero = F.lit(0.0)
    return F.sqrt(F.aggregate(features, zero, lambda total, x: total + x.cast("double") * x.cast("double")))


def in_blocks(rows: DataFrame, order: Column, rows_per_block: int) -> DataFrame:
    """``rows`` with a ``block`` number: stretches of the given order, of at most ``rows_per_block`` rows.

    Partitions follow the order (equal values that of their ids, so they can be spread), and each is
    cut where it is too long. Numbers are not dense.
    """
    names = rows.columns

    def run(batches: Batches) -> Batches:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            number = (part << 32) + (at + np.arange(batch.num_rows)) // rows_per_block
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number)], [*names, "block"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    dealt = rows.repartitionByRange(order, "id").sortWithinPartitions(order, "id")
    return dealt.mapInArrow(run, f"{kinds}, block bigint")


class Best:
    """The k best (score, item) of each user so far; equal scores by item.

    ``floor`` may name a score of each user that at least k items reach.
    """

    def __init__(self, users: pa.Array, factors: np.ndarray, k: int, decimals: int, floor: np.ndarray | None = None):
        self.users, self.factors, self.k, self.decimals = users, factors, k, decimals
        self.norms = np.sqrt((factors * factors).sum(axis=1))
        #: A score below this is not among the k best, nor is an equal one of an item after ``last``.
        self.floor = np.full(len(factors), -np.inf) if floor is None else floor.copy()
        self.last = np.full(len(factors), np.iinfo(np.int64).max)
        self.row, self.item, self.score = (np.zeros(0, dtype=t) for t in (np.int32, np.int64, np.float64))
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_new = 0
        self.products = 0

    def open(self, largest_norm: float) -> np.ndarray:
        """Users who may find one of their k best among items up to this norm."""
        bound = self.norms * largest_norm * (1 + ROUNDING) + 10.0**-self.decimals
        return np.flatnonzero(bound >= self.floor)

    def look(self, items: np.ndarray, factors: np.ndarray, largest_norm: float) -> None:
        """Take in a block of items."""
        users = self.open(largest_norm)
        if not len(users):
            return
        if (items[1:] < items[:-1]).any():
            order = np.argsort(items)
            items, factors = items[order], factors[order]
        batch = max(1, SCORES_PER_BATCH // max(1, len(items)))
        for start in range(0, len(users), batch):
            some = users[start : start + batch]
            scores = self.factors[some] @ factors.T
            self.products += scores.size
            # Only what may count is rounded.
            least = self.floor[some] - 10.0**-self.decimals - ROUNDING * np.abs(self.floor[some])
            row, column = np.nonzero(scores >= least[:, None])
            score = np.round(scores[row, column], self.decimals)
            floor = self.floor[some[row]]
            counts = (score > floor) | ((score == floor) & (items[column] < self.last[some[row]]))
            row, column, score = row[counts], column[counts], score[counts]
            many = np.flatnonzero(np.bincount(row, minlength=len(some)) > self.k)
            if len(many):
                few = ~np.isin(row, many)
                found, place, value = self._k_best(np.round(scores[many], self.decimals), some[many], items)
                row, column = np.concatenate([row[few], many[found]]), np.concatenate([column[few], place])
                score = np.concatenate([score[few], value])
            self.new.append((some[row].astype(np.int32), items[column], score))
            self.n_new += len(row)
            if self.n_new > max(SCORES_PER_BATCH, self.k * len(self.factors) // 2):
                self.settle()

    def _k_best(self, scores: np.ndarray, users: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and score of each row's k best; their floors rise to the last of these. ``items`` are in order."""
        width = scores.shape[1]
        kth = np.partition(scores, width - self.k, axis=1)[:, width - self.k]
        above, tied = scores > kth[:, None], scores == kth[:, None]
        room = self.k - above.sum(axis=1)
        tied &= np.cumsum(tied, axis=1, dtype=np.int32) <= room[:, None]
        self.floor[users], self.last[users] = kth, items[width - 1 - np.argmax(tied[:, ::-1], axis=1)]
        row, column = np.nonzero(above | tied)
        return row, column, scores[row, column]

    def settle(self) -> None:
        """Put what is new in its place and raise the floors."""
        row, item, score = (np.concatenate([old, *(n[c] for n in self.new)]) for c, old in enumerate((self.row, self.item, self.score)))
        self.new, self.n_new = [], 0
        order = np.lexsort((item, -score, row))
        row, item, score = row[order], item[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        full = place == self.k - 1
        self.floor[row[full]], self.last[row[full]] = score[full], item[full]
        self.row, self.item, self.score = row[best], item[best], score[best]

    def result(self, schema: pa.Schema) -> pa.RecordBatch:
        self.settle()
        rank = np.arange(len(self.row)) - np.searchsorted(self.row, self.row) + 1
        columns = [self.users.take(pa.array(self.row)), pa.array(self.item), pa.array(self.score), pa.array(rank)]
        return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)


def _walk(batches: Batches, k: int, decimals: int, schema: pa.Schema) -> Batches:
    """Rows of one unit of work after the other: its users, then items by block.

    A unit's users are kept in groups, so that what is sorted at once is small.
    """
    groups: list[Best] | None = None
    current = None
    users: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
    size = max(1, ROWS_PER_GROUP // max(1, k))

    def results() -> Batches:
        while groups:
            yield groups.pop(0).result(schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("unit", "kind", "place")], axis=1)
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
            part, (unit, kind, _) = batch.slice(start, stop - start), keys[start].tolist()
            if unit != current:
                yield from results()
                current, groups, users = unit, None, []
            ids, factors = part.column("id"), _matrix(part.column("features"))
            weight = part.column("weight").to_numpy()
            if kind == 0:
                users.append((ids, factors, weight))
                continue
            if groups is None:
                every, vectors, floors = pa.concat_arrays([u[0] for u in users]), np.concatenate([u[1] for u in users]), np.concatenate([u[2] for u in users])
                cuts = [slice(at, at + size) for at in range(0, len(every), size)]
                groups, users = [Best(every[own], vectors[own], k, decimals, floors[own]) for own in cuts], []
            for group in groups:
                group.look(ids.to_numpy(), factors, float(weight.max()))
    yield from results()


def _stats(factors: DataFrame):
    return factors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width")).first()


def _depths(users: DataFrame, seed: list, k: int, decimals: int) -> DataFrame:
    """``users`` with the score that k items are known to reach (``floor``), and the largest norm below which no item is among the k best (``depth``; 0: none is known)."""
    kind = users.schema["id"].dataType.simpleString()
    element = users.schema["features"].dataType.simpleString()
    best_items = np.array([r.features for r in seed], dtype=np.float64)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            factors = _matrix(batch.column("features"))
            depth, floor = np.zeros(len(factors)), np.full(len(factors), -np.inf)
            if len(best_items) >= k and len(factors):
                norms = np.sqrt((factors * factors).sum(axis=1))
                for start in range(0, len(factors), max(1, SCORES_PER_BATCH // len(best_items))):
                    own = slice(start, start + max(1, SCORES_PER_BATCH // len(best_items)))
                    floor[own] = np.partition(np.round(factors[own] @ best_items.T, decimals), -k, axis=1)[:, -k]
                    kth = floor[own] - 10.0**-decimals
                    depth[own] = np.where(norms[own] > 0, kth / (np.maximum(norms[own], 1e-300) * (1 + ROUNDING)), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(depth), pa.array(floor)], ["id", "features", "depth", "floor"])

    return users.select("id", "features").mapInArrow(run, f"id {kind}, features {element}, depth double, floor double")


def _reach(user_blocks: DataFrame, norms: np.ndarray, upto: np.ndarray) -> DataFrame:
    """``ub, reach, work, size``: of each user block, how many item blocks one of its users needs, the products that makes and the items in them.

    ``norms`` fall; ``upto`` are the items up to each block.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            reach = np.searchsorted(-norms, -batch.column("depth").to_numpy(), side="right")
            size = np.concatenate([[0.0], upto])[reach]
            work = batch.column("n").to_numpy() * size
            yield pa.RecordBatch.from_arrays([batch.column("ub"), pa.array(reach), pa.array(work), pa.array(size)], ["ub", "reach", "work", "size"])

    profile = user_blocks.groupBy("ub").agg(F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n"))
    return profile.select("ub", "depth", "n").mapInArrow(run, "ub bigint, reach bigint, work double, size double").filter("reach > 0")


def _units(reached: DataFrame, tasks: int) -> DataFrame:
    """``reached`` with ``strips``, and ``first``, the number of a block's first unit.

    A user block with more than its share of the work is cut into strips of item blocks, several
    for each task it could keep busy; its users are the same in all of them.
    """
    total = reached.agg(F.sum("work")).scalar()
    share = F.col("work") * F.lit(float(tasks)) / total
    dealt = F.least(F.col("reach"), F.ceil(share * STRIPS_PER_TASK))
    strips = F.when((share > 1.5) & (F.col("work") > LEAST_WORK), dealt).otherwise(1).cast("int")
    before = Window.orderBy("ub").rowsBetween(Window.unboundedPreceding, -1)
    # One small row for each user block.
    return reached.withColumn("strips", strips).withColumn("first", F.coalesce(F.sum("strips").over(before), F.lit(0)).cast("int"))


def _needed(units: DataFrame, places: np.ndarray) -> DataFrame:
    """``ub, unit, place, block``: the item blocks that one of a block's users needs, dealt to the block's units."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for ub, reach, strips, first in zip(*(batch.column(c).to_pylist() for c in ("ub", "reach", "strips", "first"))):
                for start in range(0, reach, 100_000):
                    place = np.arange(start, min(reach, start + 100_000))
                    columns = [np.full(len(place), ub), (first + place % strips).astype(np.int32), place.astype(np.int32), places[place]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["ub", "unit", "place", "block"])

    return units.select("ub", "reach", "strips", "first").mapInArrow(run, "ub bigint, unit int, place int, block bigint")


def _blocks(users: DataFrame, items: DataFrame, k: int, decimals: int, tasks: int):
    """Written blocks of users and items, the reach of the former, the numbers of the latter in order, and how many there are of both."""
    user_stats, item_stats = _stats(users), _stats(items)
    width = max(1, user_stats["width"] or 1, item_stats["width"] or 1)
    n_users, n_items = user_stats["n"], item_stats["n"]
    per_item_block = max(1, BLOCK_BYTES // (8 * width), math.ceil(n_items / MAX_BLOCKS))
    normed = items.select("id", "features", _norm("features").alias("norm"))
    item_blocks = stage_table("items", in_blocks(normed, F.desc("norm"), per_item_block))
    # At most MAX_BLOCKS rows, but for the ends of partitions.
    directory = item_blocks.groupBy("block").agg(F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n")).collect()
    directory.sort(key=lambda r: (-r.norm, r.block))
    norms = np.array([r.norm for r in directory], dtype=np.float64)
    blocks = np.array([r.block for r in directory], dtype=np.int64)
    upto = np.cumsum([r.n for r in directory], dtype=np.float64)

    # The seed is bounded by max(k, SEED_ITEMS) and one block.
    first, held = [], 0
    for row in directory:
        if held >= max(k, SEED_ITEMS):
            break
        first.append(row.block)
        held += row.n
    best = item_blocks.filter(F.col("block").isin(first)).orderBy(F.desc("norm"), "id").limit(max(k, SEED_ITEMS))
    deep = _depths(users, best.select("features").collect() if first else [], k, decimals)
    per_user_block = max(1, min(ROWS_PER_RESULT // max(1, k), BLOCK_BYTES * 8 // (8 * width), math.ceil(n_users / tasks)))
    user_blocks = stage_table("users", in_blocks(deep, F.desc("depth"), per_user_block).withColumnRenamed("block", "ub"))
    n_blocks = max(1, math.ceil(n_users / per_user_block))
    return user_blocks, item_blocks, stage_table("reach", _reach(user_blocks, norms, upto)), blocks, (n_blocks, len(directory))


def _plan(reached: DataFrame, blocks: np.ndarray, tasks: int) -> tuple[DataFrame, int]:
    """Which blocks meet in which unit, and the largest number of units that a user block has."""
    units = stage_table("units", _units(reached, tasks))
    strips = units.agg(F.max("strips")).first()[0] or 1
    return stage_table("needed", _needed(units, blocks)), strips


def _tasks(users: DataFrame, min_tasks: int | None) -> int:
    return min_tasks or users.sparkSession.sparkContext.defaultParallelism


def block_plan(users: DataFrame, items: DataFrame, k: int, decimals: int = 9, min_tasks: int | None = None):
    """Written blocks of users and items, and which of them meet: ``(users, items, needed, strips, shares)``.

    ``strips`` is the largest number of units that a user block has; ``shares`` are the numbers of user
    blocks and item blocks, for reports.
    """
    tasks = _tasks(users, min_tasks)
    user_blocks, item_blocks, reached, blocks, shares = _blocks(users, items, k, decimals, tasks)
    return user_blocks, item_blocks, *_plan(reached, blocks, tasks), shares


def _passes(reached: DataFrame, row_bytes: int) -> tuple[DataFrame, int]:
    """``reached`` with the ``pass`` of each user block, and the number of passes: stretches of blocks that get about PASS_BYTES of items, and the items of one block at least."""
    found = reached.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    total = found["size"] or 1.0
    n = max(1, min(found.n, math.ceil(total * row_bytes / staging.PASS_BYTES)))
    before = F.coalesce(F.sum("size").over(Window.orderBy("ub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    # One small row for each user block.
    return reached.withColumn("pass", F.floor(before / total * n)), n


def factor_topk(
    users: DataFrame, items: DataFrame, k: int, decimals: int = 9, min_tasks: int | None = None
) -> DataFrame:
    """``(user_id, book_id, rating, rank)``: the k best items of each user.

    ``users`` and ``items`` are ``(id, features ARRAY)`` with unique ids. Scores
    equal to ``decimals`` places count as ties, which go to the lower id.
    ``min_tasks`` (default: the cluster's parallelism) makes more, smaller units of
    work when there are few users. Null features are no factors: such rows take no part.
    """
    users, items = (side.select("id", "features").filter("features IS NOT NULL") for side in (users, items))
    tasks = _tasks(users, min_tasks)
    user_blocks, item_blocks, reached, blocks, _ = _blocks(users, items, k, decimals, tasks)
    id_type, item_type = (side.schema["id"].dataType.simpleString() for side in (users, items))
    arrow = {"int": pa.int32(), "bigint": pa.int64()}
    out = pa.schema([(USER, arrow[id_type]), (ITEM, arrow[item_type]), (RATING, pa.float64()), (RANK, pa.int32())])

    # Single precision stays as it is until it is multiplied.
    element = "double" if "array<double>" in (user_blocks.schema["features"].dataType.simpleString(), item_blocks.schema["features"].dataType.simpleString()) else "float"

    def side(rows: DataFrame, kind: int, weight: str) -> DataFrame:
        features = F.col("features").cast(f"array<{element}>")
        return rows.select("unit", F.lit(kind).alias("kind"), "place", F.col("id").cast("bigint").alias("id"), features.alias("features"), F.col(weight).alias("weight"))

    def walked(some: DataFrame) -> DataFrame:
        needed, strips = _plan(some, blocks, tasks)
        walkers = needed.select("ub", "unit").distinct()
        first = side(user_blocks.join(walkers, "ub").withColumn("place", F.lit(-1)), 0, "floor")
        then = side(needed.join(item_blocks, "block"), 1, "norm")
        # Units have dense numbers, and each its own task.
        n_units = (needed.agg(F.max("unit")).first()[0] or 0) + 1
        stream = first.union(then).repartitionById(n_units, F.col("unit")).sortWithinPartitions("unit", "kind", "place")
        ranked = stream.mapInArrow(
            lambda batches: _walk(batches, k, decimals, out), f"{USER} {id_type}, {ITEM} {item_type}, {RATING} double, {RANK} int"
        )
        # A strip has ranked its own items only.
        return ranked if strips == 1 else top_k(ranked.drop(RANK), k)

    width = item_blocks.agg(F.max(F.size("features"))).first()[0] or 1
    dealt, n = _passes(reached, ROW_BYTES + width * (8 if element == "double" else 4))
    if n == 1:
        return walked(reached)
    dealt = stage_table("passes", dealt)
    path = scratch_dir(users.sparkSession, "stage-ranked")
    return stage_parts(path, (walked(dealt.filter(F.col("pass") == p).drop("pass")) for p in range(n)))
