"""Near-duplicate documents by one-permutation hashing.

One hash per shingle fills all bins of a signature: the leading bits choose the
bin, the smallest of the rest is its value. An empty bin takes the value of a
bin that a fixed sequence of draws for its number finds filled (optimal
densification). Bands of the signature are buckets. A bucket's members get an
edge to its smallest member, a star, so edges grow with the members and not with
their square. Edges are confirmed on the full sets.

A star alone can miss a link between two members that are both unlike its
center. Where members of one bucket are still in different components after
that, the pairs across these components are confirmed too, so no pair that
shares a bucket is lost, however large the bucket is.

Documents with equal sets are one class throughout and never expanded to pairs.

Defined results: a null, empty or blank text has an empty set and is linked with
nothing; a text with fewer words than a shingle is one shingle; rows with equal
doc_id are separate documents that carry one id; columns beyond ``doc_id`` and
``text`` are passed by; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, id_and_text, in_slices, list_array, mix, word_hashes
from tastemill.llm.graph import bucket_components
from tastemill.staging import stage_table


#: Standard deviations of the sketches' error that are allowed for.
DEVIATIONS = 5.5


@dataclass(frozen=True)
class Settings:
    """Shingles of ``words`` words; a link is a share of at least ``num / den``; ``bands`` of ``rows`` bins each."""

    words: int = 5
    num: int = 80
    den: int = 100
    bands: int = 32
    rows: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    # A polynomial in odd factors tells orders apart; mixing makes it usable as a hash.
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
        for k in range(words):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + mix(hashes[k : k + len(rolled)])
        rolled = mix(rolled)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= words:
            out.append(np.unique(rolled[end - n : end - words + 1]))
        elif n:
            raw = hashes[end - n : end].tobytes()
            out.append(np.array([xxhash.xxh3_64_intdigest(raw)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The densified signature of a non-empty sorted set of hashes."""
    half = np.uint64(32)
    which = ((hashes >> half) * np.uint64(bins)) >> half
    value = hashes & np.uint64(0xFFFFFFFF)
    first = np.flatnonzero(np.diff(which, prepend=np.uint64(bins)))
    out = np.zeros(bins, dtype=np.uint64)
    filled = np.zeros(bins, dtype=bool)
    at = which[first].astype(np.int64)
    out[at] = np.minimum.reduceat(value, first)
    filled[at] = True
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        attempt += 1
        with np.errstate(over="ignore"):
            draw = mix(empty.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(attempt))
        source = ((draw >> half) * np.uint64(bins) >> half).astype(np.int64)
        found = filled[source]
        out[empty[found]] = out[source[found]]
        empty = empty[~found]
    return out


def band_keys(signatures: np.ndarray, settings: Settings) -> np.ndarray:
    """One 64-bit bucket per band, from signatures with one row per document."""
    parts = signatures.reshape(len(signatures), settings.bands, settings.rows)
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(1, settings.bands + 1, dtype=np.uint64), parts.shape[:2])
        for k in range(settings.rows):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys.astype(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Two bits of every bin, packed into 64-bit integers."""
    bits = np.stack([signatures & np.uint64(1), signatures >> np.uint64(1) & np.uint64(1)], axis=2).astype(np.uint8)
    packed = np.packbits(bits.reshape(len(signatures), 2 * signatures.shape[1]), axis=1)
    padded = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return np.ascontiguousarray(padded).view(np.int64).reshape(len(signatures), -(-2 * signatures.shape[1] // 64))


def describe(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, node binary, buckets, sketch``; the node names the set, null if it is empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            sets = shingle_sets(batch.column("text"), settings.words)
            full = [s for s in sets if len(s)]
            signatures = np.array([signature(s, settings.bins) for s in full], dtype=np.uint64).reshape(len(full), settings.bins)
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            buckets = list_array(band_keys(signatures, settings).reshape(-1), np.where(sizes > 0, settings.bands, 0))
            sketch = sketches(signatures)
            sketch = list_array(sketch.reshape(-1), np.where(sizes > 0, sketch.shape[1], 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(nodes, pa.binary()), buckets, sketch],
                ["doc_id", "n_shingles", "node", "buckets", "sketch"],
            )

    schema = f"doc_id {kind}, n_shingles bigint, node binary, buckets array<bigint>, sketch array<bigint>"
    return id_and_text(docs).mapInArrow(run, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """``node, shingles`` for the ``wanted (node, doc_id)``, from the texts."""

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            sets = shingle_sets(batch.column("text"), settings.words)
            values = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, dtype=np.int64)
            nodes = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            same = pa.array([a == b for a, b in zip(nodes.to_pylist(), batch.column("node").to_pylist())], pa.bool_())
            rows = pa.RecordBatch.from_arrays([nodes, list_array(values, np.array([len(s) for s in sets], dtype=np.int64))], ["node", "shingles"])
            yield rows.filter(same)  # rows may share a doc_id and differ in text

    rows = id_and_text(docs).withColumnRenamed("doc_id", "other")
    # The list grows with the input: it is never broadcast, so that the plan is the same at every size.
    texts = rows.join(wanted.hint("merge"), rows.other.eqNullSafe(wanted.doc_id)).select("node", "text")
    return texts.mapInArrow(run, "node binary, shingles array<bigint>").dropDuplicates(["node"])


def possible(a: Column, b: Column, settings: Settings) -> Column:
    """Whether sets can be alike enough, by their sizes and sketches.

    Of linked sets the expected share of bins whose two bits differ is three
    quarters of the share of all that is unlike. A set fills only some bins by
    itself, and only these count for the error; ``DEVIATIONS`` standard deviations
    above the expectation no link is lost but with odds of about one in a million.
    """
    sized = F.least(a.n, b.n) * settings.den >= F.greatest(a.n, b.n) * settings.num
    unlike = 0.75 * (1 - settings.num / settings.den)
    filled = settings.bins * (1 - F.exp(-F.least(a.n, b.n) / F.lit(float(settings.bins))))
    most = settings.bins * (unlike + DEVIATIONS * F.sqrt(unlike * (1 - unlike) / filled))
    differing = F.lit(0)
    for k in range(-(-settings.bins * 2 // 64)):
        x = a.sketch[k].bitwiseXOR(b.sketch[k])
        # One bit for each pair of bits that is not all zero.
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differing = differing + F.bit_count(either)
    return sized & (differing <= most)


def sized_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """``node, data, size``: the full sets of the given nodes."""
    wanted = stage_table("wanted", classes.select("node", "doc_id").join(nodes.hint("merge"), "node"))
    sets = stage_table("sets", full_sets(docs, wanted, settings))
    return sets.select("node", F.col("shingles").alias("data"), F.size("shingles").cast("bigint").alias("size"))


def alike(x: pa.Array, y: pa.Array, settings: Settings) -> np.ndarray:
    """Which sets of ``x`` are linked with which of ``y``: products of the sets' incidence matrices."""
    sizes = [np.diff(side.offsets.to_numpy()) for side in (x, y)]
    values = [side.flatten().to_numpy() for side in (x, y)]
    known = np.intersect1d(*values)
    shared = np.zeros((len(sizes[0]), len(sizes[1])), dtype=np.float32)
    places = []
    for size, value in zip(sizes, values):
        at = np.minimum(np.searchsorted(known, value), max(0, len(known) - 1))
        hit = np.flatnonzero(known[at] == value) if len(known) else np.zeros(0, dtype=np.int64)
        order = np.argsort(at[hit], kind="stable")
        places.append((np.repeat(np.arange(len(size)), size)[hit][order], at[hit][order]))
    for start in range(0, len(known), 4096):
        parts = []
        for (row, column), size in zip(places, sizes):
            a, b = np.searchsorted(column, (start, start + 4096))
            part = np.zeros((len(size), min(4096, len(known) - start)), dtype=np.float32)
            part[row[a:b], column[a:b] - start] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    both = sizes[0][:, None] + sizes[1][None, :] - shared
    return np.rint(shared) * settings.den >= np.rint(both) * settings.num


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Those of the ``pairs (a, b)`` whose full sets are alike enough."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stage_table("wanted", classes.select("node", "doc_id").join(ends, "node"))
    sets = stage_table("sets", full_sets(docs, wanted, settings))
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    alike = shared * settings.den >= (F.size("x") + F.size("y") - shared) * settings.num
    return stage_table("links", both.filter(alike).select("a", "b"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; see the module text."""
    described = stage_table("described", describe(docs, settings))
    classes = stage_table(
        "classes",
        described.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n"), F.any_value("buckets").alias("buckets"), F.any_value("sketch").alias("sketch")),
    )
    members = classes.select("node", F.struct("n", "sketch").alias("n"), F.explode("buckets").alias("bucket"))
    roots = bucket_components(
        members,
        lambda pairs: confirmed(pairs, docs, classes, settings),
        lambda a, b: possible(a, b, settings),
        lambda nodes: sized_sets(docs, classes, nodes, settings),
        lambda x, y: alike(x, y, settings),
    )

    # The smallest doc_id of each component, over its classes, carried back to all rows.
    named = classes.select("node", "doc_id").join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    named = stage_table("named", named)
    smallest = stage_table("smallest", named.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    of_class = stage_table("of_class", named.select("node", "root").join(smallest, "root").select("node", "component_id"))
    rows = described.select("doc_id", "n_shingles", "node").join(of_class, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
