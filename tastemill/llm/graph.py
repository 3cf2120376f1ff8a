"""Connected components by alternating stars, as Spark joins and aggregations.

Each round writes its edges to the shared folder and reads them back, so plans
stay short and a lost executor costs one round at most. A node with very many
neighbours is no problem: minima are combined map-side, and the joins have plain
shuffles on both sides, which the adaptive skew rule can split.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches
from tastemill.staging import stage_table

#: Members up to which a bucket's open pairs are made one by one.
FEW = 16
#: Bounds of a tile: numbers in its data, and rows.
TILE_SIZE, TILE_ROWS = 200_000, 1_000


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` but the roots; the root is the smallest node.

    Edges may repeat, run either way or be loops. No edges, no rows.
    """
    a, b = F.col("a"), F.col("b")
    now = stage_table("edges", edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = mark
        now = stage_table("edges", _small_star(stage_table("edges", _large_star(now))))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest neighbour."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = stage_table("least", both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    larger = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest neighbour."""
    least = stage_table("least", edges.groupBy("hi").agg(F.min("lo").alias("m")))
    joined = edges.join(least, "hi")
    moved = joined.filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def bucket_components(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    possible: Callable[[Column, Column], Column],
    items: Callable[[DataFrame], DataFrame],
    alike: Callable[[pa.Array, pa.Array], np.ndarray],
) -> DataFrame:
    """``(node, root)`` of the confirmed links between ``members (node, n, bucket)`` that share a bucket.

    ``confirm`` keeps those of the candidate pairs ``(a, b)`` that are links;
    ``possible`` says of two values of ``n`` whether a link can be at all.

    First every member is tried with its bucket's center: a star, whose edges grow
    with the members. The center is the member with the most company over all of
    its buckets, as that is likeliest to be what the others were copied from.
    Where a bucket's members are still in different components, the links across
    these components follow, so that none inside a bucket is lost: pair by pair in
    buckets of at most ``FEW`` members, and by ``links_in_tiles`` in all others,
    for which ``items`` gives the data of nodes and ``alike`` compares it.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("k"))
    crowded = stage_table("crowded", sizes.filter("k > 1"))
    inside = stage_table("inside", members.join(crowded.hint("merge"), "bucket"))
    company = stage_table("company", inside.groupBy("node").agg(F.sum("k").alias("w")))
    ranked = inside.join(company.hint("merge"), "node")
    best = ranked.groupBy("bucket").agg(F.max(F.struct("w", "node", "n")).alias("c"))
    centers = stage_table("centers", best.select("bucket", F.col("c.node").alias("a"), F.col("c.n").alias("a_n")))
    star = inside.join(centers.hint("merge"), "bucket").filter((F.col("node") != F.col("a")) & possible(F.col("n"), F.col("a_n")))
    star = stage_table("star", star.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
    links = confirm(star)
    roots = components(links)

    labelled = inside.select("bucket", "node", "n", "k").join(roots.hint("merge"), "node", "left")
    labelled = stage_table("labelled", labelled.select("bucket", "node", "n", "k", F.coalesce("root", "node").alias("root")))
    ends = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    split = stage_table("split", ends.filter("x != y").select("bucket"))
    open_ = stage_table("open", labelled.join(split.hint("merge"), "bucket"))
    few = open_.filter(F.col("k") <= FEW)
    left = few.select("bucket", F.col("root").alias("ra"), F.col("node").alias("a"), F.col("n").alias("a_n"))
    right = few.select("bucket", F.col("root").alias("rb"), F.col("node").alias("b"), F.col("n").alias("b_n"))
    pairs = left.join(right.hint("merge"), "bucket").filter((F.col("ra") < F.col("rb")) & possible(F.col("a_n"), F.col("b_n")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = confirm(stage_table("pairs", pairs.join(star, ["a", "b"], "left_anti")))
    many = open_.filter(F.col("k") > FEW).select("bucket", "node", "root")
    return components(links.union(more).union(links_in_tiles(many, items(many.select("node").distinct()), alike)))


def links_in_tiles(members: DataFrame, items: DataFrame, alike: Callable[[pa.Array, pa.Array], np.ndarray]) -> DataFrame:
    """Links ``(a, b)`` that join different roots of ``members (bucket, node, root)`` inside a bucket.

    ``items (node, data, size)`` has what ``alike`` compares: it says of two lists
    of data which pairs are links. A bucket is dealt into tiles of bounded size,
    and two tiles are compared in one task, which puts out links that connect
    what was not connected and no others: at most one less than its members.
    """
    rows = members.join(items.hint("merge"), "node")
    tiles = F.ceil(F.greatest(F.sum("size") / TILE_SIZE, F.count("*") / TILE_ROWS)).cast("int")
    sizes = stage_table("sizes", rows.groupBy("bucket").agg(tiles.alias("tiles")))
    dealt = rows.join(sizes.hint("merge"), "bucket").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    row = F.struct("node", "root", "data")
    tiled = stage_table("tiles", dealt.groupBy("bucket", "tile").agg(F.collect_list(row).alias("rows")))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = batch.column("x")[k].values, batch.column("y")[k].values
                near = alike(x.field("data"), y.field("data"))
                roots = [side.field("root").to_pylist() for side in (x, y)]
                nodes = [side.field("node").to_pylist() for side in (x, y)]
                top = {r: r for side in roots for r in side}
                number = {r: n for n, r in enumerate(top)}
                codes = [np.array([number[r] for r in side]) for side in roots]
                near &= codes[0][:, None] != codes[1][None, :]

                def find(r, top=top):
                    while top[r] != r:
                        top[r] = top[top[r]]
                        r = top[r]
                    return r

                found = []
                for i, j in zip(*(v.tolist() for v in np.nonzero(near))):
                    p, q = find(roots[0][i]), find(roots[1][j])
                    if p != q:
                        top[p] = q
                        found.append((nodes[0][i], nodes[1][j]))
                yield pa.RecordBatch.from_arrays([pa.array([f[side] for f in found], pa.binary()) for side in (0, 1)], ["a", "b"])

    pairs = tile_pairs(tiled, sizes, "bucket").select("x", "y")
    return stage_table("links", pairs.mapInArrow(run, "a binary, b binary"))


def tile_pairs(tiled: DataFrame, sizes: DataFrame, group: str) -> DataFrame:
    """Every pair of tiles s <= t of a group with their rows as ``x`` and ``y``, dealt by (group, s, t).

    The pairs come from the number of tiles alone, each tile is fetched by its own key, and each product
    is a unit of work of its own: a group with very many tiles is spread over all tasks.
    """
    every = lambda low, name: F.explode(F.sequence(low, F.col("tiles") - 1)).alias(name)
    named = sizes.select(group, "tiles", every(F.lit(0), "s")).select(group, "s", every(F.col("s"), "t"))
    first = tiled.select(group, F.col("tile").alias("s"), F.col("rows").alias("x"))
    second = tiled.select(group, F.col("tile").alias("t"), F.col("rows").alias("y"))
    fetched = named.join(first.hint("merge"), [group, "s"]).join(second.hint("merge"), [group, "t"])
    return fetched.repartition(group, "s", "t")
