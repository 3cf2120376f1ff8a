"""Personal data by patterns, and by a skip-chain conditional random field around them.

The patterns' spans are always kept. The field looks at candidate tokens (those
with a digit or an ``@``) and labels each with a kind or none. Neighbouring
candidates form a chain; skip edges join a token to the next one, however far,
that repeats it or is similar: the same digits or the same last seven, the same
address or the same name before the ``@``. Labels of pattern spans are observed;
loopy message passing carries them to the tokens that no pattern matches, such as
a number repeated without its country code, and these become additional spans.
Without an observed label, shapes and edges alone decide. A match that fails its
check (Luhn, number of digits, parts over 255) bars its tokens from that kind.

Training is by distant supervision on the patterns' spans of at most
``TRAIN_DOCS`` documents, with all of their candidates: a softmax on token
shapes, and smoothed log-odds of label pairs on chain and on skip edges. Tokens
that are joined to an entity and match no pattern are left out there.

Positions are code points, end exclusive. Defined results: a null text counts as
empty; texts without digits and ``@`` have no spans; repeated rows are each
searched; an empty table gives no rows; other columns are passed by.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import Batches, id_and_text, in_slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_DOCS = 20_000
ROUNDS = 10
#: Least probability of a kind for an additional span.
SURE = 0.7
#: Characters between neighbouring candidates that still form a chain.
NEAR = 3

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: what fails from its start fails from there as well.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile("[0-9@]")
_CUE = re.compile(r"([^\W\d_]+)\W*\Z")
_EDGE = ".,;:!?|\"'()[]{}<>"
_DIGITS = re.compile("[0-9]")
CUES = {"email": ("mail", "contact"), "ip": ("ip", "host", "addr", "server"), "card": ("card", "visa", "credit"), "phone": ("phone", "tel", "call", "fax", "mobile")}


def luhn(digits: str) -> bool:
    values = [int(c) for c in digits[::-1]]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each ``@`` with the run of name characters before it."""
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            out.append((start, free))
        at = text.find("@", free)
    return out


def judged_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, number of the kind, end) of all matches by start, then kind: those that pass, and those that fail their check."""
    found: tuple[list, list] = ([(a, 0, b) for a, b in emails(text)] if "@" in text else [], [])
    if not _DIGITS.search(text):
        return found
    for m in _IP.finditer(text):
        good = all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))
        found[not good].append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        good = 12 <= len(digits) <= 19 and luhn(digits)
        found[not good].append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            good = 9 <= len(_DIGITS.findall(m[0])) <= 15
            found[not good].append((m.start(), 3, m.end()))
    return sorted(found[0]), sorted(found[1])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all pattern spans, by start, then kind."""
    return judged_spans(text)[0]


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an ``@``, without punctuation around them."""
    out = []
    if not _MARK.search(text):
        return out
    for m in _TOKEN.finditer(text):
        token = m[0]
        if not _MARK.search(token):
            continue
        start = m.start() + len(token) - len(token.lstrip(_EDGE))
        end = m.end() - len(token) + len(token.rstrip(_EDGE))
        if start < end:
            out.append((start, end))
    return out


def shape(text: str, start: int, end: int) -> list[float]:
    """Features of one token; none of them repeats a pattern as a whole."""
    token = text[start:end]
    n = len(_DIGITS.findall(token))
    cue = _CUE.search(text, max(0, start - 24), start)
    word = cue[1].lower() if cue else ""
    return [
        1.0, float("@" in token), float(token.count(".") == 3), float("." in token), float("-" in token), float(n == len(token)),
        float(n == 0), float(1 <= n <= 3), float(4 <= n <= 6), float(n == 7), float(8 <= n <= 11), float(12 <= n <= 19), float(n > 19),
        float(text[max(0, start - 1) : start + 1].count("+") > 0), float("(" in text[max(0, start - 1) : start + 1]),
        float(any(c.isalpha() for c in token)), *(float(any(c in word for c in CUES[k])) for k in KINDS),
    ]


N_FEATURES = 20


def keys_of(token: str) -> list[tuple[str, str]]:
    """What makes tokens the same or similar."""
    digits = "".join(_DIGITS.findall(token))
    if "@" in token:
        name = token.lower().partition("@")
        return [("address", token.lower())] + ([("name", name[0])] if name[0] else [])
    if len(digits) < 7:
        return []
    return [("digits", digits)] + ([("tail", digits[-7:])] if "." not in token and len(digits) <= 15 else [])


def graph(text: str, tokens: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Chain edges and skip edges. A repeated token is joined to its next occurrence, so skip edges grow with the tokens."""
    chain = [(k, k + 1) for k in range(len(tokens) - 1) if tokens[k + 1][0] - tokens[k][1] <= NEAR]
    last: dict[tuple[str, str], int] = {}
    skip = set()
    for k, (a, b) in enumerate(tokens):
        for key in keys_of(text[a:b]):
            if key in last:
                skip.add((last[key], k))
            last[key] = k
        # A number written in several tokens is known by all of its digits.
        if chain and k and tokens[k][0] - tokens[k - 1][1] <= NEAR:
            first = k
            while first and tokens[first][0] - tokens[first - 1][1] <= NEAR and k - first < 4:
                first -= 1
            digits = "".join(_DIGITS.findall(text[tokens[first][0] : b]))
            if 7 <= len(digits) <= 15 and "@" not in text[a:b]:
                key = ("tail", digits[-7:])
                if key in last and last[key] != k:
                    skip.add((last[key], k))
                last[key] = k
    return np.array(chain, dtype=np.int64).reshape(-1, 2), np.array(sorted(skip - set(chain)), dtype=np.int64).reshape(-1, 2)


def observed(tokens: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The label that a pattern span gives to each token; -1 where there is none."""
    out = np.full(len(tokens), -1, dtype=np.int64)
    k = 0
    for start, kind, end in spans:
        k = np.searchsorted([b for _, b in tokens], start, side="right") if k == 0 else k
        i = int(k)
        while i and tokens[i - 1][1] > start:
            i -= 1
        while i < len(tokens) and tokens[i][1] <= start:
            i += 1
        k = i
        while i < len(tokens) and tokens[i][0] < end:
            out[i] = kind + 1 if out[i] < 0 else out[i]
            i += 1
    return out


def refused(tokens: list[tuple[int, int]], failed: list[tuple[int, int, int]]) -> np.ndarray:
    """Which labels a token cannot have: a pattern matched over it and its check (Luhn, digits, parts) failed."""
    out = np.zeros((len(tokens), len(LABELS)), dtype=bool)
    starts = np.array([a for a, _ in tokens], dtype=np.int64)
    ends = np.array([b for _, b in tokens], dtype=np.int64)
    for start, kind, end in failed:
        out[np.searchsorted(ends, start, side="right") : np.searchsorted(starts, end, side="left"), kind + 1] = True
    return out


@dataclass(frozen=True)
class Field:
    """Softmax weights of shapes, and log-potentials of label pairs on both kinds of edges."""

    shapes: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, features: np.ndarray, seen: np.ndarray, chain: np.ndarray, skip: np.ndarray, barred: np.ndarray | None = None) -> np.ndarray:
        """Marginal label probabilities by loopy sum-product message passing; exact where the edges form a tree.

        ``barred`` says which labels a token cannot have.
        """
        local = features @ self.shapes
        if barred is not None:
            local[barred] = -30.0
        local[seen >= 0] = -30.0
        local[seen >= 0, seen[seen >= 0]] = 0.0
        source = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
        target = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
        kinds = [self.chain] * len(chain) + [self.chain.T] * len(chain) + [self.skip] * len(skip) + [self.skip.T] * len(skip)
        pair = np.array(kinds).reshape(-1, len(LABELS), len(LABELS))
        back = np.concatenate([np.arange(len(chain)) + len(chain), np.arange(len(chain)), 2 * len(chain) + len(skip) + np.arange(len(skip)), 2 * len(chain) + np.arange(len(skip))]).astype(np.int64)
        message = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS if len(source) else 0):
            total = local.copy()
            np.add.at(total, target, message)
            out = (total[source] - message[back])[:, :, None] + pair
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            message = 0.5 * message + 0.5 * new
        np.add.at(local, target, message)
        local = np.exp(local - local.max(axis=1, keepdims=True))
        return local / local.sum(axis=1, keepdims=True)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """All spans of a text: the patterns' and the field's, by start, then kind."""
        base, failed = judged_spans(text)
        tokens = candidates(text)
        seen = observed(tokens, base)
        if not len(tokens) or (seen >= 0).all():
            return base
        features = np.array([shape(text, a, b) for a, b in tokens])
        chain, skip = graph(text, tokens)
        belief = self.beliefs(features, seen, chain, skip, refused(tokens, failed))
        label = np.where(seen < 0, belief.argmax(axis=1), 0)
        sure = (label > 0) & (belief.max(axis=1) >= SURE)
        added: list[tuple[int, int, int]] = []
        for k in np.flatnonzero(sure).tolist():
            a, b, kind = *tokens[k], int(label[k]) - 1
            if added and added[-1][1] == kind and sure[k - 1] and a - tokens[k - 1][1] <= NEAR:
                added[-1] = (added[-1][0], kind, b)
            else:
                added.append((a, kind, b))
        taken = np.array([[s, e] for s, _, e in base], dtype=np.int64).reshape(-1, 2)
        free = [x for x in added if not ((taken[:, 0] < x[2]) & (taken[:, 1] > x[0])).any()]
        return sorted(base + free)


def train(docs: DataFrame) -> Field:
    """A field from the patterns' spans in a bounded sample of documents."""
    n = docs.count()
    share = min(1.0, TRAIN_DOCS / max(1, n))
    sample = docs.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))).filter(F.col("text").rlike("[0-9@]"))
    pairs_kind = len(LABELS) ** 2

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            rows: dict[tuple, int] = {}
            chain_n, skip_n = np.zeros(pairs_kind), np.zeros(pairs_kind)
            for text in batch.column("text").to_pylist():
                tokens = candidates(text)
                label = np.maximum(observed(tokens, base_spans(text)), 0)
                chain, skip = graph(text, tokens)
                # What resembles an entity and matches no pattern is unknown, not an example of none.
                one = (label[skip[:, 0]] > 0) != (label[skip[:, 1]] > 0)
                known = np.ones(len(tokens), dtype=bool)
                known[skip[one].reshape(-1)] = False
                for (a, b), y, use in zip(tokens, label.tolist(), (known | (label > 0)).tolist()):
                    if use:
                        key = (y, *shape(text, a, b))
                        rows[key] = rows.get(key, 0) + 1
                for edges, counts in ((chain, chain_n), (skip[~one], skip_n)):
                    np.add.at(counts, label[edges[:, 0]] * len(LABELS) + label[edges[:, 1]], 1)
            for kind, values in (("row", [[float(n), *k] for k, n in rows.items()]), ("chain", [chain_n.tolist()]), ("skip", [skip_n.tolist()])):
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(values)), pa.array(values, pa.list_(pa.float64()))], ["kind", "v"])

    counted = sample.select("text").mapInArrow(run, "kind string, v array<double>").collect()
    tables = {k: sum((np.array(r.v) for r in counted if r.kind == k), np.zeros(pairs_kind)).reshape(len(LABELS), -1) for k in ("chain", "skip")}
    # An edge's potential compares its label pairs with independent labels, both smoothed.
    potentials = {}
    for k, strength in (("chain", 0.5), ("skip", 2.0)):
        table = tables[k] + tables[k].T + strength * np.eye(len(LABELS)) + 0.1
        joint, own = table / table.sum(), table.sum(axis=1) / table.sum()
        potentials[k] = np.clip(np.log(joint / np.outer(own, own)), -6, 6)
    rows = np.array([r.v for r in counted if r.kind == "row"]).reshape(-1, 2 + N_FEATURES)
    return Field(_softmax(rows[:, 2:], rows[:, 1].astype(int), rows[:, 0]), potentials["chain"], potentials["skip"])


def _softmax(x: np.ndarray, y: np.ndarray, times: np.ndarray, steps: int = 300) -> np.ndarray:
    """Softmax weights by gradient ascent with momentum and a ridge."""
    weights, speed = np.zeros((x.shape[1], len(LABELS))), 0.0
    weights[0, 0] = 1.0
    if not len(x):
        return weights
    target = np.eye(len(LABELS))[y]
    for _ in range(steps):
        z = x @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = x.T @ ((target - p) * times[:, None]) / times.sum() - 1e-3 * weights
        speed = 0.9 * speed + slope
        weights = weights + 0.5 * speed
    return weights


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, base, spans`` of every row; both are arrays of struct<start, kind number, end>."""
    plain = id_and_text(docs)
    used = field or train(plain)
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            texts = batch.column("text").to_pylist()
            out = [[[dict(zip(("start", "kind", "end"), s)) for s in spans] for spans in (base_spans(t), used.spans(t))] for t in texts]
            columns = [pa.array([o[k] for o in out], pa.list_(span)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    kind = plain.schema["doc_id"].dataType.simpleString()
    part = "array<struct<start: int, kind: int, end: int>>"
    return plain.mapInArrow(run, f"doc_id {kind}, base {part}, spans {part}")


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, with commas between."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s.kind], s.start.cast("string"), s.end.cast("string"))), ",")
