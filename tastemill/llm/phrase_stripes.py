"""Collocations by the stripes pattern.

A prefix keys an associative counter of what follows it, and such stripes are merged elementwise.
The empty prefix counts words. The stripe of a word x counts its extensions "y z", where z is empty
if the piece of text ends after y. From this one structure come the counts of three words (its
elements), of two words (its sums over z, the prefix totals of "x y"), and, as maxima over the
elements, which pairs are subsumed by a longer phrase.

Tasks tokenise blocks of text with Arrow and numpy, count inside each block, and send one row per
stripe: the word x once, then its extensions and their counts. Rows are dealt by (lang, x); Spark
unfolds them there and adds them up with its hash aggregation, which spills, so no stripe is ever
held whole. The words with more than a ``SPLIT``-th of all occurrences (fewer than ``SPLIT`` of
them, by arithmetic) have stripes in several segments, dealt by a hash of the extension, as many as
make segments of that size; their sums over z are added up once more. Copies of a text add nothing
to a block's rows, and little to a task's.

Only what occurs ``min_count`` times goes on, which is exact: every part of a phrase occurs at least
as often as the phrase. Products are decimals of 38 digits, so counts up to 10^15 are exact.

Defined results: null text is empty, null lang is ``und``. A-Z become lower case; a text is cut at
``[.,;:!?]`` and U+000A to U+000D, then at spaces and tabs. An empty table gives no rows. Texts are
read whole; a long one is cut only where pieces end. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, in_slices, list_array, mix
from tastemill.staging import stage_table

MIN_COUNT = 10
#: A candidate goes if a longer one that holds it has at least this share of its count (in hundredths).
SUBSUMED = 50
#: A stripe's segments hold at most about one part in so many of all occurrences.
SPLIT = 4_096
#: Bytes of text that are counted at once.
BLOCK = 8_000_000
UNKNOWN = "und"
END = b"\n"

_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + END * 9 + b" ")


def _blocks(batches: Batches) -> Iterator[tuple[str, bytes]]:
    """``(lang, text)`` with pieces ended by END; blocks are cut between pieces only."""
    for batch in in_slices(batches, 2 * BLOCK):
        langs = batch.column("lang").dictionary_encode()
        texts = batch.column("text")
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = texts.filter(pc.equal(langs.indices, code)).to_pylist()
            joined = END.join(t.encode() for t in own).translate(_PLAIN)
            start = 0
            while start < len(joined):
                stop = len(joined)
                if stop - start > BLOCK:
                    stop = joined.rfind(END, start, start + BLOCK)
                    stop = stop if stop >= 0 else joined.find(END, start + BLOCK)
                    stop = stop + 1 if stop >= 0 else len(joined)
                yield lang, joined[start:stop]
                start = stop


def _coded(block: bytes) -> tuple[np.ndarray, pa.Array, int]:
    """Each word's number, the words, and the number that stands between pieces."""
    data = (END + block + END).replace(END, b" \n ")
    whole = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(data)], dtype=np.int64)), pa.py_buffer(data))
    parts = pc.split_pattern(whole, " ").flatten()
    coded = parts.filter(pc.greater(pc.binary_length(parts), 0)).dictionary_encode()
    words = coded.dictionary.cast(pa.string())
    return coded.indices.to_numpy().astype(np.int64), words, words.index("\n").as_py()


def _count_words(batches: Batches) -> Batches:
    """The empty prefix's stripe of each block, unfolded."""
    for lang, block in _blocks(batches):
        codes, words, end = _coded(block)
        counts = np.bincount(codes, minlength=len(words))
        counts[end] = 0
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), words.take(pa.array(own)), pa.array(counts[own])], ["lang", "word", "n"])


def _stripes(batches: Batches, segments: dict[str, dict[str, int]]) -> Batches:
    """``lang, x, segment, extensions, counts``: the stripes of each block."""
    for lang, block in _blocks(batches):
        codes, words, end = _coded(block)
        v = len(words)
        x, y, z = codes[:-2], codes[1:-1], codes[2:]
        real = (x != end) & (y != end)
        pairs, pair = np.unique(x[real] * v + y[real], return_inverse=True)
        triples, n = np.unique(pair * v + z[real], return_counts=True)
        if not len(n):
            continue
        x, y, z = pairs[triples // v] // v, pairs[triples // v] % v, triples % v

        segment = np.zeros(len(n), dtype=np.int64)
        hot = segments.get(lang, {})
        known = pc.index_in(pa.array(list(hot), pa.string()), value_set=words).to_numpy(zero_copy_only=False)
        parts = np.ones(v, dtype=np.int64)
        for code, count in zip(known, hot.values()):
            if code == code and code is not None:
                parts[int(code)] = count
        split = np.flatnonzero(parts[x] > 1)
        if len(split):
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()], dtype=np.uint64)
            spread = mix(hashes[y[split]] ^ mix(hashes[z[split]] + np.uint64(1)))
            segment[split] = 1 + (spread % parts[x[split]].astype(np.uint64)).astype(np.int64)
            order = np.lexsort((segment, x))
            x, y, z, n, segment = x[order], y[order], z[order], n[order], segment[order]

        starts = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (segment[1:] != segment[:-1])]))
        lengths = np.diff(np.concatenate([starts, [len(n)]]))
        after = pc.if_else(pc.equal(words, "\n"), "", words)
        extensions = pc.binary_join_element_wise(words.take(pa.array(y)), after.take(pa.array(z)), " ")
        for k in range(0, len(starts), 100_000):
            own = slice(starts[k], starts[k] + lengths[k : k + 100_000].sum())
            per = lengths[k : k + 100_000]
            lists = list_array(n[own].astype(np.int32), per)
            strings = pa.ListArray.from_arrays(lists.offsets, extensions[own])
            of = starts[k : k + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(per), pa.string()), words.take(pa.array(x[of])), pa.array(segment[of].astype(np.int32)), strings, lists],
                ["lang", "x", "segment", "extensions", "counts"],
            )


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))`` in exact arithmetic."""
    wide = lambda c: c.cast("decimal(16,0)")
    product = F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a)
    return F.call_function("div", product, wide(left) * wide(right))


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``totals (lang, n)``, ``words (lang, x, a)``, ``pairs (lang, x, y, a)`` and ``triples (lang, x, y, z, a)``.

    The last three hold what occurs at least ``min_count`` times; all are written tables or short sums of one.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_count_words, "lang string, word string, n bigint")
    words = stage_table("words", counted.groupBy("lang", "word").agg(F.sum("n").alias("a")))
    totals = stage_table("totals", words.groupBy("lang").agg(F.sum("a").alias("n")))
    every = totals.agg(F.sum("n")).first()[0] or 0

    # Fewer than SPLIT rows: each has more than a SPLIT-th of all occurrences.
    frequent = words.filter(F.col("a") * SPLIT > every).collect()
    segments: dict[str, dict[str, int]] = {}
    for row in frequent:
        segments.setdefault(row.lang, {})[row.word] = -(-row.a * SPLIT // every)

    schema = "lang string, x string, segment int, extensions array<string>, counts array<int>"
    dealt = texts.mapInArrow(lambda batches: _stripes(batches, segments), schema).repartition("lang", "x", "segment")
    unfolded = dealt.select("lang", "x", "segment", F.inline(F.arrays_zip("extensions", "counts")).alias("e", "n"))
    merged = unfolded.groupBy("lang", "x", "segment", "e").agg(F.sum("n").alias("a"))
    apart = merged.select("lang", "x", "segment", F.substring_index("e", " ", 1).alias("y"), F.substring_index("e", " ", -1).alias("z"), "a")
    sums = apart.groupBy("lang", "x", "segment", "y").agg(F.sum("a").alias("a"))
    # A segment's sum is part of a count; whole ones below the limit end here.
    sums = sums.filter((F.col("segment") > 0) | (F.col("a") >= min_count)).withColumn("z", F.lit(""))
    elements = apart.filter((F.col("z") != "") & (F.col("a") >= min_count))
    found = stage_table("stripes", sums.unionByName(elements).select("lang", "x", "y", "z", "a"))

    pairs = found.filter("z = ''").groupBy("lang", "x", "y").agg(F.sum("a").alias("a")).filter(F.col("a") >= min_count)
    often = words.filter(F.col("a") >= min_count).select("lang", F.col("word").alias("x"), "a")
    return totals, often, stage_table("pairs", pairs), found.filter("z <> ''")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of two and three words that are not subsumed.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut with the lowest score
    (ties to the earliest cut), ``n`` the number of words of the lang.
    """
    totals, words, pairs, triples = phrase_counts(docs, min_count)
    two, first, last = (F.concat_ws(" ", *c) for c in (("x", "y"), ("x", "y"), ("y", "z")))
    three = F.concat_ws(" ", "x", "y", "z")
    cuts = [
        pairs.select("lang", two.alias("phrase"), "a", F.lit(1).alias("k"), F.col("x").alias("left"), F.col("y").alias("right")),
        triples.select("lang", three.alias("phrase"), "a", F.lit(1).alias("k"), F.col("x").alias("left"), last.alias("right")),
        triples.select("lang", three.alias("phrase"), "a", F.lit(2).alias("k"), first.alias("left"), F.col("z").alias("right")),
    ]
    counts = words.select("lang", F.col("x").alias("part"), F.col("a").alias("c")).union(pairs.select("lang", two, "a"))
    lefts = counts.select("lang", F.col("part").alias("left"), F.col("c").alias("l"))
    rights = counts.select("lang", F.col("part").alias("right"), F.col("c").alias("r"))
    cut = cuts[0].union(cuts[1]).union(cuts[2]).join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    scored = cut.select("lang", "phrase", "a", F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    best = scored.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min("cut").alias("cut"))

    parts = triples.select("lang", first.alias("phrase"), "a").union(triples.select("lang", last.alias("phrase"), "a"))
    longer = parts.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * SUBSUMED))
    return kept.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("bigint").alias("score"))


def top_collocations(docs: DataFrame, limit: int = 2_000, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each lang's first ``limit`` by score, count and phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, min_count).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
