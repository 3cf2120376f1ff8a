"""Near-duplicate embeddings by cross-polytope hashing.

A hash rotates a unit vector (random signs, fast Hadamard transform, three
times) and names the nearest corner of the cross-polytope: the largest
coordinate and its sign. A bucket of a table joins ``HASHES`` of these. Each
vector is also put into the buckets of the ``PROBES`` likeliest other corners
(multiprobe). Candidate pairs from shared buckets are verified by their cosine
in double precision; see ``graph.bucket_components`` for how pairs inside large
groups are avoided.

All links lie inside components, so direct links are counted there: a component
is dealt into tiles, and products of tiles give each vector's number of
neighbours. Equal vectors are one class throughout, with a count.

Defined results: a vector that is null, zero, or holds a null or non-finite
component has no link and is its own component; equal rows count as separate
vectors that carry one id; vectors of different lengths are never linked; a null
vec_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, list_array
from tastemill.llm.graph import bucket_components, tile_pairs
from tastemill.staging import stage_table

COSINE = 0.95
TABLES, HASHES, PROBES = 16, 3, 5
SEED = 11
TILE = 1024
#: Cosines this near to the bound are computed again, exactly.
CLOSE = 1e-9


def rotations(size: int, count: int) -> np.ndarray:
    """Signs of three rounds for each of ``count`` rotations of ``size`` coordinates."""
    return np.random.default_rng([SEED, size]).choice(np.array([-1.0, 1.0]), (count, 3, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the last axis, scaled to keep lengths."""
    size, width = x.shape[-1], 1
    while width < size:
        pairs = x.reshape(*x.shape[:-1], size // (2 * width), 2, width)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(x.shape)
        width *= 2
    return x / np.sqrt(size)


def bucket_keys(vectors: np.ndarray) -> np.ndarray:
    """For each unit vector the keys of its bucket and of its probes, in every table."""
    n, dim = vectors.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = vectors
    signs = rotations(size, TABLES * HASHES)
    best, second, loss = [], [], []
    for r in range(TABLES * HASHES):
        x = padded
        for round_ in range(3):
            x = hadamard(x * signs[r, round_])
        top = np.argpartition(-np.abs(x), 1, axis=1)[:, :2]
        value = np.take_along_axis(x, top, axis=1)
        order = np.argsort(-np.abs(value), axis=1)
        top, value = np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)
        corner = 2 * top + (value < 0)
        best.append(corner[:, 0])
        second.append(corner[:, 1])
        loss.append((np.abs(value[:, 0]) - np.abs(value[:, 1])) ** 2)
    best, second, loss = (np.stack(x, axis=1).reshape(n, TABLES, HASHES) for x in (best, second, loss))
    # Every choice of best or second corner per hash, in order of what it loses.
    choices = np.array([[c >> h & 1 for h in range(HASHES)] for c in range(1 << HASHES)])
    costs = np.einsum("nth,ch->ntc", loss, choices)
    ranked = np.argsort(costs, axis=2, kind="stable")[:, :, : PROBES + 1]
    chosen = choices[ranked]
    corners = np.where(chosen == 1, second[:, :, None, :], best[:, :, None, :])
    keys = np.broadcast_to(np.arange(TABLES)[None, :, None], corners.shape[:3]).astype(np.int64) + TABLES * size
    for h in range(HASHES):
        keys = keys * (2 * size) + corners[..., h]
    return keys.reshape(n, -1)


def units(vectors: DataFrame) -> DataFrame:
    """``vec_id, node binary, unit array<double>``: class and direction, null for vectors that link with nothing."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            nodes, values, sizes = [], [], []
            for row in batch.column("embedding").to_pylist():
                x = np.array([np.nan if v is None else v for v in row or []], dtype=np.float64)
                top = np.abs(x).max() if len(x) else 0.0
                if not np.isfinite(top) or top == 0.0:
                    nodes.append(None)
                    sizes.append(0)
                    continue
                x = x / top  # so that the length neither overflows nor vanishes
                nodes.append(xxhash.xxh3_128_digest(np.array(row, dtype=np.float64).tobytes()))
                values.append(x / np.linalg.norm(x))
                sizes.append(len(x))
            flat = np.concatenate(values) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(nodes, pa.binary()), list_array(flat, np.array(sizes, dtype=np.int64))], ["vec_id", "node", "unit"]
            )

    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, node binary, unit array<double>")


def _matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    return column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim)


def buckets(classes: DataFrame) -> DataFrame:
    """``node, n, bucket`` of all buckets and probes; ``n`` is the vector's length in coordinates."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            dims = np.diff(batch.column("unit").offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                for rows in np.array_split(np.flatnonzero(dims == dim), 1 + len(dims) // 2000):
                    if len(rows):
                        keys = bucket_keys(_matrix(batch.column("unit"), rows, dim))
                        nodes = batch.column("node").take(pa.array(rows))
                        per_row = np.full(len(rows), keys.shape[1])
                        yield pa.RecordBatch.from_arrays(
                            [nodes, pa.array(np.full(len(rows), dim), pa.int64()), list_array(keys.reshape(-1), per_row)], ["node", "n", "keys"]
                        )

    keyed = classes.select("node", "unit").mapInArrow(run, "node binary, n bigint, keys array<bigint>")
    return keyed.select("node", "n", F.explode("keys").alias("bucket"))


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """Those of the pairs whose cosine is large enough."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            dim = np.diff(batch.column("x").offsets.to_numpy())
            rows = np.repeat(np.arange(len(dim)), dim)
            x, y = (batch.column(c).flatten().to_numpy() for c in ("x", "y"))
            found = np.bincount(rows, x * y, minlength=len(dim))
            keep = found >= cosine
            ends = np.cumsum(dim)
            for k in np.flatnonzero(np.abs(found - cosine) < CLOSE).tolist():
                own = slice(ends[k] - dim[k], ends[k])
                keep[k] = exact_product(x[own], y[own]) >= cosine
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    x = classes.select(F.col("node").alias("a"), F.col("unit").alias("x"))
    y = classes.select(F.col("node").alias("b"), F.col("unit").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return stage_table("links", both.mapInArrow(run, "a binary, b binary"))


def exact_product(x: np.ndarray, y: np.ndarray) -> float:
    """The sum of products without the error of its order, so that a pair near the bound is judged alike everywhere."""
    return math.fsum((x * y).tolist())


def near(x: pa.Array, y: pa.Array, cosine: float) -> np.ndarray:
    """Which unit vectors of ``x`` and ``y`` are as near as ``cosine``."""
    mine, theirs = (side.flatten().to_numpy().reshape(len(side), -1) for side in (x, y))
    found = mine @ theirs.T
    keep = found >= cosine
    for i, j in np.argwhere(np.abs(found - cosine) < CLOSE).tolist():
        keep[i, j] = exact_product(mine[i], theirs[j]) >= cosine
    return keep


def neighbour_counts(members: DataFrame, cosine: float) -> DataFrame:
    """``node, n_near``: vectors as near as ``cosine`` in its component, itself included, for ``root, node, copies, unit``."""
    sizes = stage_table("sizes", members.groupBy("root").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")))
    dealt = members.join(sizes, "root").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    row = F.struct("node", "copies", "unit")
    tiles = stage_table("tiles", dealt.groupBy("root", "tile").agg(F.collect_list(row).alias("rows")))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = batch.column("x")[k].values, batch.column("y")[k].values
                found = near(x.field("unit"), y.field("unit"), cosine)
                sides = [(x, found @ y.field("copies").to_numpy(zero_copy_only=False))]
                if batch.column("s")[k].as_py() != batch.column("t")[k].as_py():
                    sides.append((y, x.field("copies").to_numpy(zero_copy_only=False) @ found))
                for side, count in sides:
                    yield pa.RecordBatch.from_arrays([side.field("node"), pa.array(count, pa.int64())], ["node", "n"])

    pairs = tile_pairs(tiles, sizes, "root").select("s", "t", "x", "y")
    return pairs.mapInArrow(run, "node binary, n bigint").groupBy("node").agg(F.sum("n").alias("n_near"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; see the module text."""
    described = stage_table("units", units(vectors))
    real = described.filter("node IS NOT NULL")
    classes = stage_table(
        "classes", real.groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.any_value("unit").alias("unit"))
    )
    roots = bucket_components(
        buckets(classes).distinct(),
        lambda pairs: verified(pairs, classes, cosine),
        lambda a, b: a == b,
        lambda nodes: classes.join(nodes.hint("merge"), "node").select("node", F.col("unit").alias("data"), F.size("unit").cast("bigint").alias("size")),
        lambda x, y: near(x, y, cosine),
    )
    named = classes.join(roots, "node", "left").select("node", "vec_id", "copies", "unit", F.coalesce("root", "node").alias("root"))
    named = stage_table("named", named)
    smallest = stage_table("smallest", named.groupBy("root").agg(F.min("vec_id").alias("component_id"), F.count("*").alias("classes")))
    shared = named.join(smallest.filter("classes > 1").select("root"), "root").select("root", "node", "copies", "unit")
    counts = stage_table("counts", neighbour_counts(stage_table("shared", shared), cosine))
    of_class = named.select("node", "root", "copies").join(smallest, "root").join(counts, "node", "left")
    of_class = stage_table("of_class", of_class.select("node", "component_id", (F.coalesce("n_near", "copies") - 1).alias("n_links")))
    rows = described.select("vec_id", "node").join(of_class, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    links = F.coalesce("n_links", F.lit(0)).cast("bigint")
    return rows.select("vec_id", links.alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))
