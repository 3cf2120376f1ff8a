"""Benchmark passages in documents, found in a latent space and confirmed word by word.

Index: the terms are the benchmark's words, weighted by their inverse document
frequency over all documents. Copies do not make a term common: frequent texts
count once, and words within ``SEED`` consecutive words of an item do not count.
No term weighs nothing. Passages are overlapping windows of words. The TF-IDF
matrix A of all benchmark items and all passages of all documents gets a randomised
SVD; documents' passages weigh as much as ``PASSAGES`` together, so that items have
their say however many documents there are. Tasks add up A'A, of which each pair of
terms that share a window is a part, and it comes to the driver once; with more than
``GRAM_TERMS`` terms its products with a thin matrix do, in a pass each.

Search: every window of every document is projected and compared by cosine with
the items, and with every window of an item that is longer than one. Close windows
are candidates; so is, whatever its words weigh, each place that has ``SEED``
consecutive words of an item. A candidate is confirmed by the longest
common subsequence of the item and the text around the window, cut to its
densest stretch: most of the item's words in order are a copy; about half of
them, together with the answer (the item's last sentence), are a paraphrase.

The benchmark is handled in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_WORDS`` words (or one item), so that the latent space has room for all of
a block and what is broadcast has a bound. All blocks share one search pass.

Defined results: null and empty texts and items hold nothing and match nothing;
repeated items are each reported; repeated rows are each searched; an empty
benchmark or table gives no rows; a null item_id is reported as null.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, bounds, fresh_name, id_and_text, in_slices, mix, split_words

WINDOW, STRIDE = 48, 16
RANK, OVERSAMPLE, POWER = 256, 16, 2
#: What the passages of all documents weigh together, in passages.
PASSAGES = 2_000
#: Terms up to which A'A is made as a whole, tasks that make it (each sends what it has of it), and its cells in a row of what is sent.
GRAM_TERMS, GRAM_TASKS, GRAM_CELLS = 5_000, 16, 1 << 18
#: An item counts as so many passages, so that the leading directions hold the items and not only frequent words.
ITEM_WEIGHT = 10
BLOCK_WORDS, BLOCK_ITEMS = 1 << 17, 200
#: Least cosine of a candidate window, and what confirms it: a share of the item alone, or a share with the answer.
COSINE, COPY, PARAPHRASE, ANSWER = 0.35, 0.7, 0.5, 0.5
#: Documents of a hundred that may hold a term before it counts for nothing.
COMMON = 0.1
#: Least weight of a benchmark term.
FLOOR = 0.1
#: Bytes of text that a task takes apart at once.
SLICE = 2_000_000
#: Consecutive words of an item (all of a shorter one) that make a place a candidate.
SEED = 6
#: Texts that hold more than one of so many rows count once in the document frequencies.
HOT_SHARE = 10_000
GAP = 0.5
TRIM = ".,;:!?|*$%&#\"'()[]{}<>"
SENTENCE_END = re.compile(r"[.!?]\s+")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in lower case without punctuation around them, and each text's number of words."""
    lists = split_words(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    offsets = lists.offsets.to_numpy()
    flat = pc.ascii_trim(lists.flatten(), TRIM)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), before[offsets[1:] - offsets[0]] - before[offsets[:-1] - offsets[0]]


def blocks_of(terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stride-wide blocks of words: first word and text of each, and blocks per text."""
    per_text = -(-counts // STRIDE)
    text = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return np.repeat(np.cumsum(counts) - counts, per_text) + nth * STRIDE, text, per_text


def grams(terms: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where ``size`` consecutive words of one text are terms, and a hash of these terms."""
    if len(terms) < size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    known = np.concatenate([[0], np.cumsum(terms >= 0)])
    at = np.flatnonzero((known[size:] - known[:-size] == size) & (text[: len(text) - size + 1] == text[size - 1 :]))
    hashes = np.full(len(at), size, dtype=np.uint64)
    for k in range(size):
        hashes = mix(hashes * np.uint64(31) + terms[at + k].astype(np.uint64) + np.uint64(1))
    return at, hashes


class Seeds:
    """The runs of ``SEED`` consecutive words of all items, with the items and places that have them."""

    def __init__(self, items: list[np.ndarray]):
        self.places: dict[int, dict[int, int]] = {}
        sizes = sorted({min(SEED, len(x)) for x in items})
        self.of_size = {}
        for size in sizes:
            own = []
            for k, item in enumerate(items):
                if min(SEED, len(item)) == size:
                    at, hashes = grams(item, np.zeros(len(item), dtype=np.int64), size)
                    own.append(hashes)
                    for a, h in zip(at.tolist(), hashes.tolist()):
                        self.places.setdefault(h, {}).setdefault(k, a)
            self.of_size[size] = np.unique(np.concatenate(own))

    def found(self, terms: np.ndarray, text: np.ndarray):
        """Places and hashes of the seeds in the texts, for each size of a seed."""
        for size, known in self.of_size.items():
            at, hashes = grams(terms, text, size)
            hit = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
            yield size, at[hit], hashes[hit]


@dataclass(frozen=True)
class Index:
    """Items of one block of the benchmark, their terms' weighted projections, and the items' latent directions."""

    item_ids: list
    items: list[list[str]]
    answers: list[int]
    terms: list[str]
    weights: np.ndarray
    #: Weight of a word that is no term.
    other: float
    projection: np.ndarray
    #: One of each item and, after it, one of each of its windows if it is longer than a window.
    directions: np.ndarray
    first_direction: np.ndarray
    seeds: Seeds

    def search(self, texts: pa.Array) -> list[list[tuple]]:
        """Confirmed (item number, first word, last word, cosine, share, answer share) of each text."""
        words, counts = words_of(texts)
        if not len(words) or not self.items:
            return [[] for _ in counts]
        found = pc.index_in(words, value_set=pa.array(self.terms, pa.large_string()))
        terms = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        weight = np.where(terms >= 0, self.weights[terms], self.other)
        starts, text, _ = blocks_of(terms, counts)
        ends = np.minimum(starts + WINDOW, np.cumsum(counts)[text])
        # A window's cosine is at most the share of its length that lies in the benchmark's terms.
        whole = np.concatenate([[0.0], np.cumsum(weight * weight)])
        inside = np.concatenate([[0.0], np.cumsum(np.where(terms >= 0, weight * weight, 0.0))])
        length = np.sqrt(np.maximum(whole[ends] - whole[starts], 1e-12))
        open_ = np.flatnonzero(inside[ends] - inside[starts] >= (COSINE * length) ** 2)
        text_start = np.cumsum(counts) - counts
        best: list[dict[int, tuple]] = [{} for _ in counts]
        for at in range(0, len(open_), 512):
            some = open_[at : at + 512]
            width = ends[some] - starts[some]
            place = np.repeat(starts[some] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            row, term = np.repeat(np.arange(len(some)), width), terms[place]
            row, term = row[term >= 0], term[term >= 0]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            sums = np.zeros((len(some), self.projection.shape[1]), dtype=np.float32)
            sums[row[first]] = np.add.reduceat(self.projection[term], first, axis=0)
            cosine = np.maximum.reduceat(sums @ self.directions.T, self.first_direction, axis=1) / length[some][:, None]
            for w, item in zip(*(x.tolist() for x in np.nonzero(cosine >= COSINE))):
                t, start, size = int(text[some[w]]), int(starts[some[w]]), len(self.items[item])
                low = max(int(text_start[t]), start - size)
                high = min(int(text_start[t] + counts[t]), start + WINDOW + size)
                known = best[t].get(item)
                if known and known[0] == 1.0 and low <= text_start[t] + known[3] and text_start[t] + known[4] < high:
                    best[t][item] = (1.0, max(known[1], float(cosine[w, item])), *known[2:])  # the same copy
                    continue
                share, answer, a, b = densest(self.items[item], words[low:high].to_pylist(), self.answers[item])
                if share >= COPY or (share >= PARAPHRASE and answer >= ANSWER):
                    hit = (share, float(cosine[w, item]), answer, low + a - int(text_start[t]), low + b - int(text_start[t]))
                    if item not in best[t] or hit[:2] > best[t][item][:2]:
                        best[t][item] = hit
        self._add_seeded(words, terms, counts, weight, best)
        return [[(i, a, b, near, share, answer) for i, (share, near, answer, a, b) in sorted(own.items())] for own in best]


    def _add_seeded(self, words: pa.Array, terms: np.ndarray, counts: np.ndarray, weight: np.ndarray, best: list[dict[int, tuple]]) -> None:
        """Confirms what seeds lead to and no window has led to."""
        text, text_start = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
        wanted: dict[tuple[int, int], list[int]] = {}
        for _, at, hashes in self.seeds.found(terms, text):
            for place, t, h in zip(at.tolist(), text[at].tolist(), hashes.tolist()):
                for item, offset in self.seeds.places[h].items():
                    if item not in best[t]:
                        wanted.setdefault((t, item), []).append(place - offset)
        for (t, item), begins in wanted.items():
            size, last = len(self.items[item]), None
            need = Counter(self.items[item])
            for begin in sorted(begins):
                # What is searched reaches an item's length to both sides.
                if last is not None and begin - last <= size // 2:
                    continue
                last = begin
                low, high = max(int(text_start[t]), begin - size), min(int(text_start[t] + counts[t]), begin + 2 * size)
                near = words[low:high].to_pylist()
                if (Counter(near) & need).total() < PARAPHRASE * size:
                    continue
                share, answer, a, b = densest(self.items[item], near, self.answers[item])
                if share >= COPY or (share >= PARAPHRASE and answer >= ANSWER):
                    own = slice(low + a, low + b + 1)
                    hit = (share, self._cosine(terms[own], weight[own], item), answer, low + a - int(text_start[t]), low + b - int(text_start[t]))
                    if item not in best[t] or hit[:2] > best[t][item][:2]:
                        best[t][item] = hit
                    if share == 1.0:
                        break

    def _cosine(self, terms: np.ndarray, weight: np.ndarray, item: int) -> float:
        """Cosine of one stretch of words and an item."""
        of_item = self.directions[self.first_direction[item] : np.append(self.first_direction, len(self.directions))[item + 1]]
        latent = self.projection[terms[terms >= 0]].sum(axis=0)
        return float((of_item @ latent).max() / math.sqrt(max(float((weight * weight).sum()), 1e-12)))


def densest(item: list[str], text: list[str], answer_from: int) -> tuple[float, float, int, int]:
    """Share of the item, and of its answer, in the densest stretch of a longest common subsequence.

    With them come the stretch's first and last word in ``text``.
    """
    known: dict[str, int] = {}
    a = np.array([known.setdefault(w, len(known)) for w in item])
    b = np.array([known.get(w, -1) for w in text])
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int32)
    for i in range(len(a)):
        row = table[i, 1:].copy()
        hit = b == a[i]
        row[hit] = np.maximum(row[hit], table[i, :-1][hit] + 1)
        table[i + 1, 1:] = np.maximum.accumulate(row)
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1] and table[i, j] == table[i - 1, j - 1] + 1:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif table[i - 1, j] >= table[i, j - 1]:
            i -= 1
        else:
            j -= 1
    pairs.reverse()
    best, best_range, now, start = 0.0, (0, -1), 0.0, 0
    for k, (_, at) in enumerate(pairs):
        gap = GAP * (at - pairs[k - 1][1] - 1) if k else 0.0
        if now - gap <= 0:
            now, start = 0.0, k
        else:
            now -= gap
        now += 1
        if now > best:
            best, best_range = now, (start, k)
    chosen = pairs[best_range[0] : best_range[1] + 1]
    if not chosen:
        return 0.0, 0.0, 0, 0
    in_answer = sum(k >= answer_from for k, _ in chosen)
    return len(chosen) / len(item), in_answer / max(1, len(item) - answer_from), chosen[0][1], chosen[-1][1]


def answer_start(text: str) -> int:
    """The number of words before the last sentence; 0 if there is only one."""
    ends = [m.end() for m in SENTENCE_END.finditer(text.rstrip())]
    if not ends:
        return 0
    return int(words_of(pa.array([text[: ends[-1]]]))[1][0])


def hot_texts(docs: DataFrame) -> dict[int, int]:
    """Rows of each text, by its hash, that holds more than one of ``HOT_SHARE`` rows and more than one row."""
    groups = docs.groupBy(F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    least = docs.count() / HOT_SHARE
    return {r.h: r.n for r in groups.filter(F.col("n") > least).collect()}


def document_counts(docs: DataFrame, terms: list[str], seeds: Seeds, hot: dict[int, int]) -> tuple[float, int, np.ndarray]:
    """Documents, windows, and documents with each term outside of seeds, over all documents; hot texts count once."""
    hot_hashes = np.array(sorted(hot), dtype=np.int64)
    shares = np.array([1.0 / hot[h] for h in hot_hashes.tolist()])

    def run(batches: Batches) -> Batches:
        known, size = pa.array(terms, pa.large_string()), len(terms)
        counts = np.zeros(size + 2)
        for batch in in_slices(batches, SLICE):
            words, per_text = words_of(batch.column("text"))
            found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)
            text = np.repeat(np.arange(len(per_text)), per_text)
            times = np.ones(len(per_text))
            if len(hot_hashes):
                h = batch.column("h").to_numpy()
                at = np.minimum(np.searchsorted(hot_hashes, h), len(hot_hashes) - 1)
                times = np.where(hot_hashes[at] == h, shares[at], 1.0)
            copied = np.zeros(len(found) + 1, dtype=np.int64)
            for width, at, _ in seeds.found(found, text):
                np.add.at(copied, at, 1)
                np.add.at(copied, at + width, -1)
            own = (found >= 0) & (np.cumsum(copied[:-1]) == 0)
            seen = np.unique((text * size + found)[own])
            counts[:size] += np.bincount(seen % size, times[seen // size], minlength=size)
            counts[size] += times.sum()
            counts[size + 1] += int((-(-per_text // STRIDE)).sum())
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["term", "n"])

    counts = np.zeros(len(terms) + 2)
    for row in docs.select("text", F.xxhash64("text").alias("h")).mapInArrow(run, "term int, n double").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row.term] = row.n
    return float(counts[-2]), int(counts[-1]), counts[:-2]


def passage_rows(docs: DataFrame, terms: list[str], weights: np.ndarray) -> DataFrame:
    """``terms array<int>, times``: the weighted terms of every window, one row each, and how often it counts."""

    def run(batches: Batches) -> Batches:
        known = pa.array(terms, pa.large_string())
        for batch in in_slices(batches, SLICE):
            words, counts = words_of(batch.column("text"))
            found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)
            starts, text, _ = blocks_of(found, counts)
            ends = np.minimum(starts + WINDOW, np.cumsum(counts)[text])
            rows = [[int(t) for t in found[a:b] if t >= 0 and weights[t] > 0] for a, b in zip(starts.tolist(), ends.tolist())]
            times = batch.column("times").take(pa.array(text))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), times], ["terms", "times"])

    return docs.select("text", "times").mapInArrow(run, "terms array<int>, times double").filter("size(terms) > 0")


def randomized_svd(product: Callable[[np.ndarray], np.ndarray], size: int, rank: int) -> np.ndarray:
    """The leading right singular vectors (terms by rank) of the rows of unit-length TF-IDF vectors, from products A'A times a basis."""
    width = min(size, rank + OVERSAMPLE)
    basis = np.random.default_rng(7).standard_normal((size, width))
    for _ in range(1 + POWER):
        basis, _ = np.linalg.qr(basis)
        basis = product(basis)
    left, _, _ = np.linalg.svd(basis, full_matrices=False)
    return left[:, : min(rank, width)]


def row_places(size: int) -> np.ndarray:
    """Where the rows of an upper triangle begin, less their number: the cell (a, b) is ``row_places[a] + b``."""
    a = np.arange(size, dtype=np.int64)
    return a * size - a * (a + 1) // 2


def add_pairs(half: np.ndarray, found: np.ndarray, counts: np.ndarray, weights: np.ndarray, times: float = 1.0) -> None:
    """Adds to ``half``, an upper triangle, what all windows of the texts have of A'A, which is ``half`` and its transpose.

    ``found`` are the texts' words as terms, -1 for others. Two words add the product of their weights over
    the squared length of each window that holds both; such windows begin in consecutive blocks.
    """
    row = row_places(len(weights))
    starts, text, per_text = blocks_of(found, counts)
    ends = np.minimum(starts + WINDOW, np.cumsum(counts)[text])
    weight = np.where(found >= 0, weights[found], 0.0)
    squares = np.concatenate([[0.0], np.cumsum(weight * weight)])
    length = squares[ends] - squares[starts]
    each = np.divide(times, length, out=np.zeros(len(length)), where=length > 1e-9)
    upto = np.concatenate([[0.0], np.cumsum(each)])
    known = np.flatnonzero(found >= 0)
    of = np.repeat(np.arange(len(counts)), counts)[known]
    first_block = np.cumsum(per_text) - per_text
    block = first_block[of] + (known - (np.cumsum(counts) - counts)[of]) // STRIDE
    earliest = np.maximum(block - (WINDOW // STRIDE - 1), first_block[of])
    term, weight = found[known], weight[known]
    np.add.at(half, row[term] + term, (weight * weight * (upto[block + 1] - upto[earliest]) / 2).astype(half.dtype))
    for lag in range(1, WINDOW):
        one = np.flatnonzero(earliest[lag:] <= block[:-lag])
        if not len(one):
            break
        other = one + lag
        value = weight[one] * weight[other] * (upto[block[one] + 1] - upto[earliest[other]])
        a, b = term[one], term[other]
        np.add.at(half, row[np.minimum(a, b)] + np.maximum(a, b), value.astype(half.dtype))


def gram(docs: DataFrame, terms: list[str], weights: np.ndarray) -> np.ndarray:
    """What all windows of all texts, each of weight one, have of A'A, as in ``add_pairs``."""
    cells = len(terms) * (len(terms) + 1) // 2

    def run(batches: Batches) -> Batches:
        known, half = pa.array(terms, pa.large_string()), np.zeros(cells, dtype=np.float32)
        for batch in in_slices(batches, SLICE):
            words, counts = words_of(batch.column("text"))
            found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)
            add_pairs(half, found, counts, weights)
        for k, start in enumerate(range(0, cells, GRAM_CELLS)):
            part = half[start : start + GRAM_CELLS]
            some = np.flatnonzero(part).astype(np.int32)
            if len(some):
                columns = [pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (some, part[some]))]
                yield pa.RecordBatch.from_arrays(columns, ["k", "cells", "part"])

    def add(pdf):
        total = np.zeros(GRAM_CELLS)
        for cells, part in zip(pdf["cells"], pdf["part"]):
            total[np.frombuffer(cells, dtype=np.int32)] += np.frombuffer(part, dtype=np.float32)
        return pdf.head(1)[["k"]].assign(part=[total.astype(np.float32).tobytes()])

    made = docs.select("text").coalesce(GRAM_TASKS).mapInArrow(run, "k int, cells binary, part binary")
    half = np.zeros(cells, dtype=np.float32)
    for row in made.groupBy("k").applyInPandas(add, "k int, part binary").collect():
        start = row.k * GRAM_CELLS
        half[start : start + GRAM_CELLS] = np.frombuffer(row.part, dtype=np.float32)[: cells - start]
    return half


def _gram_product(rows: DataFrame, weights: np.ndarray, basis: np.ndarray, block: int = 1024) -> np.ndarray:
    """A'(A basis), summed over the tasks in blocks of terms."""
    size, width = basis.shape

    def run(batches: Batches) -> Batches:
        out = np.zeros((size, width))
        for batch in batches:
            lists = batch.column("terms")
            terms = lists.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            value = weights[terms]
            norm = np.sqrt(np.bincount(row, value * value, minlength=len(lists)))
            value = value / np.maximum(norm, 1e-12)[row]
            for start in range(0, len(lists), 1000):
                a, b = np.searchsorted(row, (start, start + 1000))
                dense = np.zeros((min(1000, len(lists) - start), size))
                np.add.at(dense, (row[a:b] - start, terms[a:b]), value[a:b])
                dense *= np.sqrt(batch.column("times").to_numpy()[start : start + 1000])[:, None]
                out += dense.T @ (dense @ basis)
        for k in range(0, size, block):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([out[k : k + block].tobytes()], pa.binary())], ["k", "part"])

    def add(pdf):
        total = sum(np.frombuffer(p) for p in pdf["part"])
        return pdf.head(1).assign(part=[total.tobytes()])

    kind = "k int, part binary"
    parts = rows.coalesce(64).mapInArrow(run, kind).groupBy("k").applyInPandas(add, kind).orderBy("k").collect()
    return np.concatenate([np.frombuffer(p.part) for p in parts]).reshape(size, width) if parts else np.zeros((size, width))


def passage_product(docs: DataFrame, texts: list[str], terms: list[str], weights: np.ndarray, share: float) -> Callable[[np.ndarray], np.ndarray]:
    """A'A times a basis: of all passages of ``docs``, which count as ``share`` of a passage each, and of the items ``texts``."""
    spark = docs.sparkSession
    if len(terms) > GRAM_TERMS:
        own = spark.createDataFrame([(t, float(ITEM_WEIGHT**2)) for t in texts], "text string, times double")
        passages = passage_rows(docs.select("text", F.lit(share).alias("times")).union(own), terms, weights)
        return lambda basis: _gram_product(passages, weights, basis)
    half = gram(docs, terms, weights)
    half *= np.float32(share)
    words, counts = words_of(pa.array(texts, pa.large_string()))
    own = pc.index_in(words, value_set=pa.array(terms, pa.large_string())).to_numpy().astype(np.int64)
    add_pairs(half, own, counts, weights, float(ITEM_WEIGHT**2))
    # The only matrix of terms by terms here, in single precision: 100 MB at most.
    whole = np.zeros((len(terms), len(terms)), dtype=np.float32)
    for a, place in enumerate(row_places(len(terms)).tolist()):
        whole[a, a:] = half[place + a : place + len(terms)]
        whole[a:, a] += whole[a, a:]
    return lambda basis: (whole @ basis.astype(np.float32)).astype(np.float64)


def build_index(docs: DataFrame, item_ids: list, texts: list[str], hot: dict[int, int]) -> Index:
    """The index of one block of items over all ``docs``."""
    flat, counts = words_of(pa.array(texts, pa.large_string()))
    words, ends = flat.to_pylist(), np.cumsum(counts)
    items = [words[e - n : e] for e, n in zip(ends.tolist(), counts.tolist())]
    terms = sorted(set(words))
    number = {t: k for k, t in enumerate(terms)}
    coded = [np.array([number[w] for w in item], dtype=np.int64) for item in items]
    seeds = Seeds(coded)
    n_docs, n_windows, held = document_counts(docs, terms, seeds, hot)
    weights = np.maximum(FLOOR, np.log((n_docs + 1) / (1 + held)) + math.log(COMMON))
    if (weights <= FLOOR).all():
        weights = np.ones(len(terms))  # a handful of documents: all terms are common
    vectors = randomized_svd(passage_product(docs, texts, terms, weights, min(1.0, PASSAGES / max(1, n_windows))), len(terms), RANK)
    projection = (weights[:, None] * vectors).astype(np.float32)
    parts = [[item, *(item[k : k + WINDOW] for k in [*range(0, len(item) - WINDOW, WINDOW // 2), len(item) - WINDOW] if len(item) > WINDOW)] for item in coded]
    first_direction = np.cumsum([0, *map(len, parts)])[:-1]
    directions = np.array([projection[part].sum(axis=0) for own in parts for part in own])
    directions /= np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-9)
    return Index(item_ids, items, [min(answer_start(t), len(i) - 1) for t, i in zip(texts, items)], terms, weights, float(weights[weights > FLOOR].mean() if (weights > FLOOR).any() else 1.0), projection, directions.astype(np.float32), first_direction, seeds)


def item_blocks(benchmark: DataFrame) -> list[tuple[list, list[str]]]:
    """The benchmark's items in blocks of at most BLOCK_WORDS words."""
    out, ids, texts, size = [], [], [], 0
    items = benchmark.select("item_id", "text").filter(F.trim(F.coalesce("text", F.lit(""))) != "").orderBy("item_id", "text")
    for row in items.toLocalIterator():
        n = int(words_of(pa.array([row.text]))[1][0])
        if not n:
            continue
        if ids and (size + n > BLOCK_WORDS or len(ids) == BLOCK_ITEMS):
            out.append((ids, texts))
            ids, texts, size = [], [], 0
        ids.append(row.item_id)
        texts.append(row.text)
        size += n
    return [*out, (ids, texts)] if ids else out


FOUND = "array<struct<item_id: bigint, first_word: int, last_word: int, cosine: double, share: double, answer: double>>"


def leaks_of(docs: DataFrame, benchmark: DataFrame) -> Column:
    """A column expression on ``text``: what each text holds of the benchmark."""
    plain = id_and_text(docs)
    spark = docs.sparkSession
    blocks = item_blocks(benchmark)
    hot = hot_texts(plain) if blocks else {}
    indexes = [spark.sparkContext.broadcast(build_index(plain, ids, texts, hot)) for ids, texts in blocks]
    part = pa.struct([("item_id", pa.int64()), ("first_word", pa.int32()), ("last_word", pa.int32()), *((c, pa.float64()) for c in ("cosine", "share", "answer"))])

    def find(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for index in indexes:
            for start, stop in bounds(texts, SLICE):
                for k, own in enumerate(index.value.search(texts[start:stop]), start):
                    out[k] += [dict(zip([f.name for f in part], (index.value.item_ids[i], *rest))) for i, *rest in own]
        return pa.array(out, pa.list_(part))

    return F.arrow_udf(find, FOUND)(F.col("text"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, place in words, cosine, shares."""
    found = id_and_text(docs).select("doc_id", leaks_of(docs, benchmark).alias("found"))
    return found.select("doc_id", F.inline("found"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds an item."""
    found = fresh_name(docs, "found")
    return docs.withColumn(found, leaks_of(docs, benchmark)).filter(F.size(found) == 0).drop(found)
