"""Toxic passages as maximum-scoring segments.

Training: in labelled documents, the documents that hold a token are counted by
class, and likewise for the first five and the first four letters of tokens. A
token's toxic share has a Dirichlet prior centred on the share of its five
letters in other tokens, theirs on the share of the four, and that on the overall
share, so an unseen form of a known stem has a score too. A token's score is the
log-odds of its share, less two standard errors, against the overall share, if
that is large enough to count. A token scores where it first occurs in a text;
every token costs ``DRIFT``, so the expected score of a text is negative.

Scan: all maximal scoring segments of a text are found in one pass over its
positive tokens (Ruzzo and Tompa). Between random tokens the best segment's score
follows an extreme-value law; its decay comes from the scores of all tokens of
all documents, its offset from documents labelled clean. A segment counts as far
as its score goes beyond what a text of that length shows by chance; the sum over
segments, mapped to a probability by a logistic curve, is the document's score.

The labelled rows are a sample of at most ``SAMPLE`` rows (all, if there are no
more); everything else covers all documents. The lexicon has the features of the
sample that score, and forms of theirs that do not: it grows with the sample, not
with the documents, and none of it is cut.

Defined results: a null or empty text has no segment and gets the score of that;
without labelled rows of both classes the score is 0 everywhere; labels of a
doc_id count for each row with that doc_id, contradicting ones as both; null
labels and doc_ids teach nothing; an empty table gives no rows. Labels and other
columns are no input of a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, bounds, fresh_name, id_and_text, in_slices, split_words
from tastemill.staging import stage_table

SAMPLE = 200_000
#: Weight of the prior, in documents.
PRIOR = 4.0
#: Standard errors that are taken off a token's toxic share.
ERRORS = 2.0
#: Least log-odds of a token that count, after that; smaller ones tell languages and topics apart.
LEAST = 1.0
DRIFT = 0.05
TRIM = ".,;:!?|*$%&#\"'()[]{}<>"
#: Scores are counted in steps of this size for the extreme-value law.
STEP = 0.25
#: Bytes of text that a task takes apart at once.
SLICE = 2_000_000


def token_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Number of each token in the list of different tokens, and tokens per text."""
    words = split_words(pc.utf8_lower(texts.cast(pa.large_string())))
    offsets = words.offsets.to_numpy()
    flat = pc.ascii_trim(words.flatten(), TRIM)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    per_text = before[offsets[1:] - offsets[0]] - before[offsets[:-1] - offsets[0]]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), per_text, coded.dictionary.to_pylist()


def features(token: str) -> tuple[str, str, str]:
    """The token, its first five and its first four letters, each with a mark of its kind."""
    return "w" + token, "5" + token[:5], "4" + token[:4]


@dataclass(frozen=True)
class Model:
    """Scores of features, the extreme-value law and the logistic curve."""

    lexicon: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    offset: float = 0.0
    intercept: float = -50.0
    slope: float = 0.0

    def token_score(self, token: str) -> float:
        for feature in features(token):
            score = self.lexicon.get(feature)
            if score is not None:
                return score
        return 0.0

    def scored(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Tokens of each text and their scores; a token scores where it first occurs, as repetition shows nothing new."""
        codes, per_text, tokens = token_codes(texts)
        scores = np.array([self.token_score(t) for t in tokens])
        end = 0
        for n in per_text.tolist():
            own = codes[end : end + n]
            end += n
            values = scores[own] if n else np.zeros(0)
            places = np.flatnonzero(values > 0)
            again = np.delete(places, np.unique(own[places], return_index=True)[1])
            values[again] = 0.0
            yield n, values

    def evidence(self, texts: pa.Array) -> list[list[tuple[int, int, float]]]:
        """Significant segments of each text: first and last token, and score beyond chance."""
        out = []
        for n, own in self.scored(texts):
            chance = math.log(max(n, 1)) + self.offset
            found = []
            for first, last, score in segments(np.flatnonzero(own > 0).tolist(), own):
                beyond = self.decay * score - chance
                if beyond > 0:
                    found.append((first, last, beyond))
            out.append(found)
        return out

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, self.intercept + self.slope * math.log1p(evidence)))))


def segments(places: list[int], scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, given where the positive scores are; every token costs DRIFT."""
    # Each held segment: first, last, total before it, total up to its end.
    held: list[tuple[int, int, float, float]] = []
    gained = 0.0
    for p in places:
        before = gained - DRIFT * p
        gained += float(scores[p])
        after = gained - DRIFT * (p + 1)
        if after <= before:
            continue
        first = p
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= before:
                j -= 1
            if j < 0 or held[j][3] >= after:
                held.append((first, p, before, after))
                break
            first, before = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, right - left) for a, b, left, right in held]


def _count(docs: DataFrame) -> DataFrame:
    """``feature, n1, n0``: documents of each class that hold a feature."""

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches, SLICE):
            codes, per_text, tokens = token_codes(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            if not tokens:
                continue
            which = np.repeat(np.arange(len(per_text)), per_text)
            for kind in range(3):
                coded = pa.array([features(t)[kind] for t in tokens]).dictionary_encode()
                seen = np.unique(which * len(coded.dictionary) + coded.indices.to_numpy()[codes])
                of_text, feature = np.divmod(seen, len(coded.dictionary))
                n1 = np.bincount(feature[toxic[of_text]], minlength=len(coded.dictionary))
                n0 = np.bincount(feature[~toxic[of_text]], minlength=len(coded.dictionary))
                yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n1), pa.array(n0)], ["feature", "n1", "n0"])

    counted = docs.select("text", "toxic").mapInArrow(run, "feature string, n1 bigint, n0 bigint")
    return counted.groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _lexicon(counts: DataFrame, share: float) -> dict[str, float]:
    """Scores by feature. A token without evidence against its stem is not listed: the stem speaks for it."""
    rest, none = F.expr("substring(feature, 2)"), F.lit(0)

    def level(up: Column, source: DataFrame) -> DataFrame:
        a, b = F.col("n1") + PRIOR * up, F.col("n0") + PRIOR * (1 - up)
        mean, n = a / (a + b), a + b
        low = F.greatest(mean - ERRORS * F.sqrt(mean * (1 - mean) / (n + 1)), F.lit(1e-9))
        gain = F.log(low / (1 - low)) - math.log(share / (1 - share))
        return source.withColumn("up", up).withColumn("s", F.when(gain >= LEAST, gain).otherwise(0.0))

    def inner(mark: str, length: int, outer: DataFrame) -> DataFrame:
        """Each form with the prior that the other forms of its stem set: its own documents are not evidence twice."""
        own = counts.filter(F.substring("feature", 1, 1) == mark).select("feature", "n1", "n0", F.substring(rest, 1, length).alias("p"))
        stem = outer.select(F.expr("substring(feature, 2)").alias("p"), F.col("n1").alias("p1"), F.col("n0").alias("p0"), F.col("up").alias("p_up"), F.col("s").alias("p_s"))
        o1, o0 = F.greatest(F.col("p1") - F.col("n1"), none), F.greatest(F.col("p0") - F.col("n0"), none)
        return level((o1 + PRIOR * F.col("p_up")) / (o1 + o0 + PRIOR), own.join(stem, "p"))

    four = level(F.lit(share), counts.filter(F.substring("feature", 1, 1) == "4"))
    five = stage_table("five", inner("5", 4, four).select("feature", "n1", "n0", "up", "s", "p_s"))
    whole = inner("w", 5, five)
    # A zero matters only below a stem with a score: it clears the form.
    matters = (F.col("s") > 0) | (F.col("p_s") > 0)
    listed = four.filter("s > 0").select("feature", "s").union(five.filter(matters).select("feature", "s")).union(whole.filter(matters).select("feature", "s"))
    return {r.feature: float(r.s) for r in listed.collect()}


def _decay(docs: DataFrame, model: Model) -> float:
    """The positive root of E[exp(decay * score)] = 1 over the scores of all tokens of all documents."""

    def run(batches: Batches) -> Batches:
        steps: dict[int, int] = {}
        for batch in in_slices(batches, SLICE):
            for _, values in model.scored(batch.column("text")):
                positive = values[values > 0]
                steps[0] = steps.get(0, 0) + len(values) - len(positive)
                for step, n in zip(*np.unique(np.round(positive / STEP).astype(np.int64), return_counts=True)):
                    steps[int(step)] = steps.get(int(step), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(steps), pa.int64()), pa.array(list(steps.values()), pa.int64())], ["step", "n"])

    rows = docs.select("text").mapInArrow(run, "step bigint, n bigint").groupBy("step").agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in rows)
    score = np.array([r.step * STEP - DRIFT for r in rows])
    share = np.array([r.n / max(total, 1) for r in rows])
    low, high = 0.0, 20.0
    if not total or float(score @ share) >= 0 or not (score > 0).any():
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if float(share @ np.exp(middle * score)) > 1 else (middle, high)
    return high


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a small ridge."""
    design, weights = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - 1e-2 * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        weights = weights + np.linalg.solve(curve, slope)
    return float(weights[0]), float(max(weights[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``labels (doc_id, toxic)`` of ``docs``; the caller leaves out rows held out for a test."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", (F.col("toxic") > 0).alias("toxic")).distinct()
    n = rows.count()
    if n > SAMPLE:  # a fixed share by hash, five standard deviations below the bound
        share = (SAMPLE - 5 * math.sqrt(SAMPLE)) / n
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most SAMPLE rows of 9 bytes are broadcast.
    taught = id_and_text(docs).join(F.broadcast(rows), "doc_id").select("text", "toxic")
    taught = stage_table("taught", taught.dropDuplicates(["text", "toxic"]))
    n1, n0 = taught.agg(F.count_if(F.col("toxic")), F.count_if(~F.col("toxic"))).first()
    if not n1 or not n0:
        return Model()
    lexicon = _lexicon(stage_table("counts", _count(taught)), n1 / (n1 + n0))
    decay = _decay(id_and_text(docs), Model(lexicon))
    bare = Model(lexicon, decay)

    def best(batches: Batches) -> Batches:
        for batch in in_slices(batches, SLICE):
            top = []
            for n, own in bare.scored(batch.column("text")):
                top.append(decay * max((s for *_, s in segments(np.flatnonzero(own > 0).tolist(), own)), default=0.0) - math.log(max(n, 1)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(top)], ["toxic", "top"])

    # Mean of the law is its offset plus Euler's constant. One row comes to the driver.
    top = taught.mapInArrow(best, "toxic boolean, top double").filter("NOT toxic").agg(F.avg("top")).first()[0]
    shifted = Model(lexicon, decay, float(top) - 0.5772)

    def total(batches: Batches) -> Batches:
        for batch in in_slices(batches, SLICE):
            sums = [sum(x[2] for x in found) for found in shifted.evidence(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(sums, pa.float64())], ["toxic", "evidence"])

    # At most SAMPLE rows of two numbers come to the driver.
    pairs = taught.mapInArrow(total, "toxic boolean, evidence double").collect()
    y = np.array([float(r.toxic) for r in pairs])
    intercept, slope = _fit_logistic(np.log1p(np.array([r.evidence for r in pairs])), y)
    return Model(lexicon, decay, shifted.offset, intercept, slope)


def score(docs: DataFrame, model: Model, score_column: str, segments_column: str | None = None) -> DataFrame:
    """``docs`` with the score of each row and, if asked for, its toxic segments (token numbers, score beyond chance)."""
    model_of = docs.sparkSession.sparkContext.broadcast(model)
    temp = fresh_name(docs, "scored")
    kind = "struct<score: double, segments: array<struct<first: int, last: int, beyond: double>>>"

    def of_texts(texts: pa.Array) -> pa.Array:
        held, out = model_of.value, []
        texts = pc.fill_null(texts, "")
        for start, stop in bounds(texts, SLICE):
            for found in held.evidence(texts[start:stop]):
                out.append({"score": held.probability(sum(x[2] for x in found)), "segments": [{"first": a, "last": b, "beyond": s} for a, b, s in found]})
        part = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("beyond", pa.float64())])
        return pa.array(out, pa.struct([("score", pa.float64()), ("segments", pa.list_(part))]))

    scored = docs.withColumn(temp, F.arrow_udf(of_texts, kind)(F.col("text")))
    extra: list[Column] = [F.col(temp).getField("score").alias(score_column)]
    if segments_column:
        extra.append(F.col(temp).getField("segments").alias(segments_column))
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)
