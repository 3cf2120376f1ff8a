"""Removal of passages that an earlier document holds, by pairwise alignment of lines.

Candidate pairs: a run is the shortest stretch of whole lines from some line on,
or up to some line, that has at least ``min_words`` words. Such a run is long
enough to be rare, and its hash leads to the first document that holds it. A
later document is paired with the first holder of each of its runs: a star, so
the number of pairs grows with the number of lines, however many documents share
a passage. Every line with words in a block worth deleting lies in a run of that
block, from the block's first line on or up to the line itself.

Each pair is aligned by patience: the anchors are the runs that both sides hold (rare
as they are, most stand once on either side), and one pass deals them, in the order
of the later document, onto piles on which places in the earlier one only rise. The
first pile is what patience diff would follow; the others are the alignments of what
crosses it, so no block is missed, whatever its place. Along a pile, anchors on one
diagonal make a common block, which grows over the equal lines at its ends, and is
deleted from the later document: it has at least ``min_words`` words. Time goes with
the number of lines times its logarithm.

Order is by doc_id, nulls last, then by the text's hash. Rows equal in doc_id and
text are one document, and each of them gets its result. Lines end at a line
feed; a line's white space at the end does not count.

Defined results: a null text counts as empty; an empty text has nothing to
delete; an empty table gives no rows; other columns are passed on unchanged.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, fresh_name, id_and_text, in_slices, list_array
from tastemill.staging import stage_table

MIN_WORDS = 20
#: Bytes of text that are taken apart into lines at once.
SLICE = 2_000_000


def runs(lines: np.ndarray, words: np.ndarray, min_words: int, backward: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each line that starts a run: the run's hash and its end; both are 0 for other lines.

    Lines that come backward are hashed in the text's order, so that a run has one hash from both sides.
    """
    ends = np.searchsorted(np.cumsum(words), np.cumsum(words) - words + min_words) + 1
    hashes = np.zeros(len(lines), dtype=np.int64)
    n = len(lines)
    raw = (lines[::-1] if backward else lines).tobytes()
    for i, end in enumerate(ends.tolist()):
        if end <= n and words[i]:
            part = raw[8 * (n - end) : 8 * (n - i)] if backward else raw[8 * i : 8 * end]
            hashes[i] = xxhash.xxh3_64_intdigest(part) >> 1 or 1
    return hashes, np.where(hashes != 0, ends, 0)


def runs_up_to(lines: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line that ends a run: the run's hash and its first line; the hash is 0 for other lines."""
    hashes, ends = runs(lines[::-1].copy(), words[::-1], min_words, backward=True)
    return hashes[::-1], len(lines) - ends[::-1]


def anchors(a: np.ndarray, a_words: np.ndarray, b: np.ndarray, b_words: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """``(place in a, place in b, lines)`` of every run of ``b`` that ``a`` holds, by their places in ``b``.

    Of several places in ``a`` the one that goes on with the anchor before is taken, else the first.
    """
    run_a, end_a = runs(a, a_words, min_words)
    up_a, start_a = runs_up_to(a, a_words, min_words)
    first: dict[int, int] = {}
    for k, (h, g) in enumerate(zip(run_a.tolist(), up_a.tolist())):
        if h:
            first.setdefault(h, k)
        if g:
            first.setdefault(g, int(start_a[k]))
    run_b, end_b = runs(b, b_words, min_words)
    up_b, start_b = runs_up_to(b, b_words, min_words)
    spans = {(k, int(end_b[k]), h) for k, h in enumerate(run_b.tolist()) if h in first and h}
    spans |= {(int(start_b[k]), k + 1, h) for k, h in enumerate(up_b.tolist()) if h in first and h}
    found: list[tuple[int, int, int]] = []
    shift = 0
    for q, end, h in sorted(spans):
        p = q + shift
        if not (0 <= p and p + end - q <= len(a) and (run_a[p] == h or up_a[p + end - q - 1] == h)):
            p = first[h]
            shift = p - q
        found.append((p, q, end - q))
    return found


def piles(places: list[int]) -> list[list[int]]:
    """Numbers of the places on each pile: a place goes onto the pile with the highest top below it, or makes a new one."""
    tops: list[int] = []  # negative, so that they rise
    found: list[list[int]] = []
    for k, place in enumerate(places):
        # Tops fall from pile to pile; the first that is not above the place takes it.
        at = bisect_left(tops, -place)
        if at == len(tops):
            tops.append(-place)
            found.append([k])
        else:
            tops[at] = -place
            found[at].append(k)
    return found


def deleted_lines(a: np.ndarray, a_words: np.ndarray, b: np.ndarray, b_words: np.ndarray, min_words: int) -> list[int]:
    """Lines of ``b`` in blocks of at least ``min_words`` words that ``a`` holds."""
    found = anchors(a, a_words, b, b_words, min_words)
    covered = np.zeros(len(b) + 1, dtype=np.int64)
    blocks: list[tuple[int, int, int]] = []
    for pile in piles([p for p, _, _ in found]):
        start = found[pile[0]]
        p, q, end = start[0], start[1], start[1] + start[2]
        for k in pile[1:]:
            p2, q2, n = found[k]
            if p2 - q2 == p - q and q2 <= end:
                end = max(end, q2 + n)
            else:
                blocks.append((p - q, q, end))
                p, q, end = p2, q2, q2 + n
        blocks.append((p - q, q, end))
    for _, q, end in blocks:
        covered[q] += 1
        covered[end] -= 1
    inside = np.cumsum(covered[:-1]) > 0
    # Lines at the ends, as far as both sides go on alike; each is looked at once from either side.
    more = inside.copy()
    for shift, q, end in blocks:
        while end < len(b) and end + shift < len(a) and not more[end] and a[end + shift] == b[end]:
            more[end] = True
            end += 1
        while q > 0 and q + shift > 0 and not more[q - 1] and a[q + shift - 1] == b[q - 1]:
            q -= 1
            more[q] = True
    return np.flatnonzero(more).tolist()


def profile(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, lines, words, runs`` of every document: line hashes, words per line, hashes of its runs."""

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches, SLICE):
            lines, words, found, n_lines, n_runs = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                cut = [x.rstrip() for x in text.split("\n")]
                own = np.array([xxhash.xxh3_64_intdigest(x) >> 1 for x in cut], dtype=np.int64)
                count = np.array([len(x.split()) for x in cut], dtype=np.int64)
                hashes = np.unique(np.concatenate([runs(own, count, min_words)[0], runs_up_to(own, count, min_words)[0]]))
                hashes = hashes[hashes != 0]
                lines.append(own)
                words.append(count)
                found.append(hashes)
                n_lines.append(len(own))
                n_runs.append(len(hashes))
            sizes = np.array(n_lines, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    list_array(np.concatenate(lines), sizes),
                    list_array(np.concatenate(words), sizes),
                    list_array(np.concatenate(found), np.array(n_runs, dtype=np.int64)),
                ],
                ["key", "lines", "words", "runs"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(run, f"key {kind}, lines array<bigint>, words array<bigint>, runs array<bigint>")


def keyed(docs: DataFrame) -> DataFrame:
    """``key, text`` where the key orders documents."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), F.xxhash64("text").alias("h"))
    return id_and_text(docs).select(key.alias("key"), "text")


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, gone array<int>, holders array<struct>``: lines to delete, and the earlier documents that hold them.

    Documents without deletions have no row.
    """

    def align(batches: Batches) -> Batches:
        for batch in batches:
            b, gone = [], []
            columns = (batch.column(c) for c in ("a_lines", "a_words", "b_lines", "b_words"))
            for k, (al, aw, bl, bw) in enumerate(zip(*columns)):
                sides = [np.asarray(x.values, dtype=np.int64) for x in (al, aw, bl, bw)]
                lines = deleted_lines(*sides, min_words)
                if lines:
                    b.append(k)
                    gone.append(lines)
            at = pa.array(b, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("b").take(at), batch.column("a").take(at), pa.array(gone, pa.list_(pa.int32()))], ["key", "a", "gone"]
            )

    profiles = stage_table("profiles", profile(keyed(docs), min_words))
    held = profiles.select("key", F.explode("runs").alias("run"))
    bounds = held.groupBy("run").agg(F.min("key").alias("a"), F.max("key").alias("z"))
    shared = stage_table("shared", bounds.filter("a != z").select("run", "a"))
    pairs = stage_table("pairs", held.join(shared, "run").filter("key != a").select("a", F.col("key").alias("b")).distinct())
    one = stage_table("one", profiles.select("key", "lines", "words").dropDuplicates(["key"]))
    left = pairs.join(one.select(F.col("key").alias("a"), F.col("lines").alias("a_lines"), F.col("words").alias("a_words")), "a")
    both = left.join(one.select(F.col("key").alias("b"), F.col("lines").alias("b_lines"), F.col("words").alias("b_words")), "b")
    kind = pairs.schema["a"].dataType.simpleString()
    aligned = both.mapInArrow(align, f"key {kind}, a {kind}, gone array<int>")
    return aligned.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"), F.array_sort(F.collect_set("a")).alias("holders")
    )


def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """The texts without the lines of these numbers; null stays null."""
    out = []
    for k in range(len(texts)):
        text = texts[k].as_py()
        if text is not None:
            lines = text.split("\n")
            left = np.ones(len(lines), dtype=bool)
            left[gone[k].values.to_numpy()] = False
            text = "\n".join(line for line, stays in zip(lines, left.tolist()) if stays)
        out.append(text)
    return pa.array(out, pa.string())


def remove_repeated(docs: DataFrame, min_words: int = MIN_WORDS, gone_column: str | None = None, holders_column: str | None = None) -> DataFrame:
    """``docs`` with the repeated blocks taken out of ``text``; rows without any are as they were.

    The optional columns get the deleted line numbers and the holders' doc_ids (null for no deletion).
    """
    gone, holders, key, h = (fresh_name(docs, x) for x in ("gone", "holders", "key", "h"))
    found = stage_table("gone", deletions(docs, min_words)).select(
        F.col("key").alias(key), F.col("gone").alias(gone), F.col("holders").alias(holders)
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    row_key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), F.xxhash64(text).alias("h"))
    # The list grows with the input: it is never broadcast, so that the plan is the same at every size.
    joined = docs.withColumn(h, row_key).join(found.hint("merge"), F.col(h) == F.col(key), "left")
    touched = F.when(F.col(gone).isNotNull(), text)
    rest = F.arrow_udf(_without, "string")(touched, F.col(gone))
    columns = [F.when(F.col(gone).isNull(), F.col("text")).otherwise(rest).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    extra = [F.col(gone).alias(gone_column)] if gone_column else []
    ids = F.transform(holders, lambda x: F.when(~x.no_id, x.id))
    return joined.select(*columns, *extra, *([ids.alias(holders_column)] if holders_column else []))
