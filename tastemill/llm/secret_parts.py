"""Secrets, and credentials whose parts stand apart, with SQL expressions and joins only.

Plain kinds are found by pattern alone: assignments to secret-like names, access
identifiers, and long hexadecimal strings. Weak candidates are common in clean
text and count only together: an identifier (``user``, ``login``, ``account``,
``client_id`` ... = value), a secret-like value (a mixed string of 16 or more
letters and digits, or 16 to 23 hexadecimal digits) and an endpoint (a URL or a
``host:port``). A scope is a stretch of ``SCOPE`` characters. An interval join,
an equi-join on the scope-wide cells around both ends of each part, links parts
of different roles whose gap is at most a scope; an identifier or endpoint is reported when a
secret is near, and a weak secret when an identifier or an endpoint is near (for
which access identifiers and assignments count as well).

Positions come from marking the matches in the text and adding up the lengths of
what stands between the marks, so they are code points, end exclusive.

Defined results: a null text counts as empty; empty texts have no spans; rows
with equal doc_id and text each get all of their spans; overlapping spans of
different kinds are all reported; an empty table gives no rows; other columns are
passed by.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import id_and_text
from tastemill.staging import stage_table

SCOPE = 200
OPEN, CLOSE = "\x01", "\x02"
#: Pieces of a marked text that are walked in one go.
CHUNK = 256

#: Plain kinds in their order, each with its pattern. The lengths are checked after the match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PLAIN = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{24,}"}
#: Weak kinds: pattern and role. Only single classes repeat, which Java does in a loop; a repeated group takes a stack
#: frame per turn, and a host name with thousands of labels would end the executor.
WEAK = {
    "ident": (r"""(?i:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{3,}""", "who"),
    "endpoint": (r"(?:https?|jdbc:[a-z]+|ftp|postgres(?:ql)?|mysql|mongodb)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]{4,}|(?<![A-Za-z0-9.-])(?=[A-Za-z0-9-]++\.)(?![A-Za-z0-9.-]*?\.\.)[A-Za-z0-9.-]++(?<!\.):[0-9]{2,5}(?![0-9])", "where"),
    "value": (r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+", "what"),
}
#: What a text must contain, one of them, to have a match at all: spares most texts the pattern.
HINTS = {"assign": (":", "="), "access": ("AKIA",), "ident": (":", "="), "endpoint": (":",)}
_ROLE_OF_PLAIN = {"assign": "what", "access": "who", "hex": "what"}


def spans_of(text: Column, kind: str, pattern: str) -> Column:
    """An array of (start, end, match) of the pattern's matches, leftmost and not overlapping."""
    # The marks themselves cannot be part of a match; where the text has them, a character as long takes their place.
    marked_already = F.contains(text, F.lit(OPEN)) | F.contains(text, F.lit(CLOSE))
    plain = F.when(marked_already, F.translate(text, OPEN + CLOSE, "\x03\x03")).otherwise(text)
    pieces = F.split(F.regexp_replace(plain, pattern, OPEN + "$0" + CLOSE), OPEN, -1)
    none = F.array().cast("array<struct<start: int, end: int, match: string>>")

    def step(state: Column, piece: Column) -> Column:
        close = F.instr(piece, CLOSE)
        match = F.substring(piece, F.lit(1), close - 1)
        span = F.struct(state.at.alias("start"), (state.at + F.length(match)).alias("end"), match.alias("match"))
        found = F.when(close > 0, F.concat(state.found, F.array(span))).otherwise(state.found)
        return F.struct((state.at + F.length(piece) - F.when(close > 0, 1).otherwise(0)).alias("at"), found.alias("found"))

    def part(state: Column, chunk: Column) -> Column:
        """The spans of one chunk of pieces, from where the chunk before ends."""
        at = F.coalesce(F.get(state, F.size(state) - 1).getField("at"), F.lit(0))
        return F.concat(state, F.array(F.aggregate(chunk, F.struct(at.alias("at"), none.alias("found")), step)))

    # An array grows by copying, so spans are gathered per chunk: the work is CHUNK times the matches, not their square.
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / CHUNK).cast("int")), lambda k: F.slice(pieces, k * CHUNK + 1, F.lit(CHUNK)))
    parts = F.array().cast("array<struct<at: int, found: array<struct<start: int, end: int, match: string>>>>")
    marked = F.flatten(F.transform(F.aggregate(chunks, parts, part), lambda done: done.found))
    # Most texts have no match and are not rebuilt at all.
    hinted = F.lit(True)
    if kind in HINTS:
        hinted = reduce(or_, (F.contains(text, F.lit(h)) for h in HINTS[kind]))
    return F.when(hinted & text.rlike(pattern), marked).otherwise(none)


def is_long_enough(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 1)) >= 6
    if kind == "value":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.length(match) >= {"access": 20, "hex": 24}.get(kind, 0)


def candidates(texts: DataFrame) -> DataFrame:
    """``key, kind, rank, role, start, end`` of all plain and weak matches of ``key, text``."""
    arrays = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        arrays.append(_entries(F.filter(spans_of(F.col("text"), kind, pattern), _check(kind)), kind, rank, _ROLE_OF_PLAIN[kind]))
    for rank, (kind, (pattern, role)) in enumerate(WEAK.items(), len(PLAIN)):
        arrays.append(_entries(F.filter(spans_of(F.col("text"), kind, pattern), _check(kind)), kind, rank, role))
    return texts.select("key", F.inline(F.concat(*arrays)))


def _check(kind: str):
    return lambda span: is_long_enough(kind, span.match)


def _entries(spans: Column, kind: str, rank: int, role: str) -> Column:
    def entry(span: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), F.lit(role).alias("role"), span.start.alias("start"), span.end.alias("end"))

    return F.transform(spans, entry)


def linked(parts: DataFrame) -> DataFrame:
    """The weak ones of ``parts`` that have a complementary part within a scope."""
    cell = lambda position: F.floor(F.col(position) / SCOPE)
    weak = parts.filter(F.col("rank") >= len(PLAIN))
    # The gap runs from one part's end to the other's start. So a weak part's end lies in the scope before the other's
    # start, or its start in the scope after the other's end: two cells each, however long the parts are.
    near = parts.select("key", F.col("role").alias("other"), F.col("kind").alias("other_kind"), F.col("start").alias("s"), F.col("end").alias("e"), F.explode(F.array_distinct(F.array(cell("start") - 1, cell("start"), cell("end"), cell("end") + 1))).alias("cell"))
    joined = weak.withColumn("cell", F.explode(F.array_distinct(F.array(cell("start"), cell("end"))))).join(near.hint("merge"), ["key", "cell"])
    apart = F.greatest(F.col("s") - F.col("end"), F.col("start") - F.col("e"))
    complementary = ((F.col("role") == "what") & (F.col("other") != "what")) | ((F.col("role") != "what") & (F.col("other") == "what"))
    hits = joined.filter(complementary & (apart >= 0) & (apart <= SCOPE))
    return hits.select("key", "kind", "rank", "role", "start", "end").distinct()


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, spans array<struct<start, rank, kind, end>>`` of every row, ordered by start, then kind."""
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64("text").alias("h"))
    rows = id_and_text(docs).withColumn("key", key)
    # Equal rows have the same parts: one of them is searched.
    parts = stage_table("parts", candidates(rows.select("key", "text")).distinct())
    weak = stage_table("linked", linked(parts))
    spans = parts.filter(F.col("rank") < len(PLAIN)).unionByName(weak)
    per_row = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    empty = F.array().cast("array<struct<start: int, rank: int, kind: string, end: int>>")
    return rows.select("doc_id", "key").join(per_row.hint("merge"), "key", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
