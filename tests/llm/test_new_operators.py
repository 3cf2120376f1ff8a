"""Phrase stripes, conversation repair and digest runs against brute force, with odd rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastemill.llm import conversation_repair, digest_runs, phrase_stripes, queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ["run", "sha", "row", "n", "x", "y", "z", "kind", "audit", "cost", "keep_id", "phrase", "segment"]


def clash(frame):
    """The same rows with columns named like those of the operators."""
    return frame.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


# Phrases


def brute_phrases(rows, limit=2000, least=10):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang if lang is not None else "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    found = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        out = []
        for g, a in candidates.items():
            longer = [c for h, c in candidates.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if any(100 * c >= 50 * a for c in longer):
                continue
            score, _, l, r = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            out.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(out)[:limit], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(found)


def made_phrases(seed):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "x\x1cy", "ab", "Ünder", "new", "york", "city", "z" * 90]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "\r\n", "? "]
    rows = []
    for k in range(120):
        text = "".join(draw.choice(vocabulary) + draw.choice(gaps) for _ in range(draw.randint(0, 60)))
        rows.append((k, draw.choice(["en", "de", None]), text))
    rows += [(200 + k, "en", "one large passage of words, that many rows share. new york city") for k in range(150)]
    rows += [(900, "en", None), (901, None, ""), (902, "fr", " \t\n"), (None, "en", "new york " * 3000), (903, "en", "q" * 100_000), (903, "en", "q" * 100_000)]
    return rows


@pytest.mark.parametrize("block,split", [(8_000_000, 4_096), (300, 20)])
def test_phrases_against_brute_force(spark, monkeypatch, block, split):
    """Also with blocks of a few words, and with stripes of frequent words in many segments."""
    monkeypatch.setattr(phrase_stripes, "BLOCK", block)
    monkeypatch.setattr(phrase_stripes, "SPLIT", split)
    rows = made_phrases(block)
    docs = clash(spark.createDataFrame(rows, "doc_id BIGINT, lang STRING, text STRING"))
    want = brute_phrases([r[1:] for r in rows])
    assert len(want) > 20
    assert sorted(map(tuple, phrase_stripes.top_collocations(docs).collect())) == want
    assert sorted(map(tuple, phrase_stripes.top_collocations(docs, limit=3, min_count=2).collect())) == brute_phrases([r[1:] for r in rows], 3, 2)
    assert phrase_stripes.top_collocations(docs.limit(0)).count() == 0


def test_op11_against_brute_force(spark):
    rows = [(r.lang, r.text) for r in queries.documents(spark, SF).collect()]
    assert sorted(map(tuple, queries.op11_phrase_stripes(spark, SF).collect())) == brute_phrases(rows)


def test_blocks_end_with_pieces():
    text = "".join(f"w{k} " + ("." if k % 7 == 0 else "") for k in range(2000))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], ["lang", "text"])
    whole = b"".join(b for _, b in phrase_stripes._blocks(iter([batch])))
    saved, phrase_stripes.BLOCK = phrase_stripes.BLOCK, 50
    try:
        blocks = [b for _, b in phrase_stripes._blocks(iter([batch]))]
    finally:
        phrase_stripes.BLOCK = saved
    assert len(blocks) > 50 and b"".join(blocks) == whole and all(b.endswith(b"\n") for b in blocks[:-1])


def test_scores_are_exact(spark):
    numbers = [(10**15 - 1, 10**15, 10**15), (999_999, 1_000_000, 1_000_000), (10, 10, 10), (3, 7, 11), (10**15, 10**15, 10**15)]
    frame = spark.createDataFrame(numbers, "a BIGINT, l BIGINT, r BIGINT")
    got = [r[0] for r in frame.select(phrase_stripes._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in numbers]


# Conversations

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute_repair(rows, most_inserts=4):
    """All edits of few turns; ``rows`` are (role, text, fault)."""
    best = None

    def grow(i, made, cost, audit, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and LEGAL.match("".join(r[:1] or "-" for r, _ in made)):
            best = min(best or (cost + 1, ""), (cost, audit, made), key=lambda b: (b[0], b[1].encode()))
        if inserts < most_inserts:
            for role in ("user", "assistant"):
                grow(i, [*made, (role, "")], cost + 3, audit + "I", inserts + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            grow(i + 1, made, cost + 4, audit + "D", inserts)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                grow(i + 1, [*made, (role, text)], cost + more, audit + "K", inserts)
                for other in ("user", "assistant"):
                    grow(i + 1, [*made, (other, text)], cost + 3 + more, audit + "R", inserts)

    grow(0, [], 0, "", 0)
    return best


def faulty(rows):
    """(role, text, fault) of ordered (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        real = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not real else "duplicate" if (role, text) in seen else "truncated" if real[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def report(rows):
    """What the query has to say of one conversation's rows in order."""
    judged = faulty(rows)
    cost, audit, made = brute_repair(judged)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] or "-" for r, _, _ in judged]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    kinds = collections.Counter(f for _, _, f in judged)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, digest


def test_search_against_all_edits():
    draw, names = random.Random(7), {"s": "system", "u": "user", "a": "assistant", "t": "tool", "-": ""}
    for _ in range(1500):
        rows = [(names[draw.choice("suauat-")], f"{k}", draw.choice(["", "", "", "blank", "duplicate", "truncated"])) for k in range(draw.randint(0, 4))]
        faults = bytes({"": 0, "blank": 1, "duplicate": 2, "truncated": 3}[f] for _, _, f in rows)
        cost, audit, _ = brute_repair(rows)
        assert conversation_repair.cheapest_edits(faults, "".join(r[:1] or "-" for r, _, _ in rows)) == (cost, audit)


def test_bounds_are_lower_bounds():
    draw = random.Random(8)
    for _ in range(300):
        n = draw.randint(1, 6)
        faults, initials = bytes(draw.randrange(4) for _ in range(n)), "".join(draw.choice("suat") for _ in range(n))
        bounds = conversation_repair.suffix_bounds(faults, initials)
        cost, _ = conversation_repair.cheapest_edits(faults, initials)
        forced = [4 * (f in (1, 2)) + 3 * (f == 3) for f in faults]
        assert bounds[0][conversation_repair.START] <= cost
        assert all(min(bounds[i]) >= 0 and bounds[i][0] >= sum(forced[i:]) for i in range(n))


def test_a_long_conversation_is_searched_in_line():
    n = 200_000
    draw = random.Random(9)
    cost, audit = conversation_repair.cheapest_edits(bytes(draw.choices(range(4), [8, 1, 1, 1], k=n)), "".join(draw.choices("suat", [1, 8, 8, 1], k=n)))
    assert len(audit) >= n and cost > 0


def test_conversations_against_brute_force(spark):
    draw, rows = random.Random(10), []
    texts = ["Fine.", "Good!", "cut", " \t", "", "Well?\n ", "É."]
    for conv in range(150):
        for _ in range(draw.randint(1, 5)):
            rows.append((conv, draw.choice([None, *range(6)]), draw.choice(["user", "assistant", "system", "tool", "", None]), draw.choice([*texts, None]) if conv % 3 else f"{draw.random()}."))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (999, 0, "user", "z" * 300_000 + "."), (999, 1, "assistant", "y" * 300_000)]
    frame = clash(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING"))
    names = spark.createDataFrame([(5000,), (0,)], "conv_id BIGINT")
    plans, repaired = conversation_repair.repair(frame, names)
    digests = {r.conv_id: r.repaired_sha256 for r in conversation_repair.repaired_digests(frame, plans).collect()}
    got = {r.conv_id: (*tuple(r)[1:], digests[r.conv_id]) for r in plans.collect()}
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2]))
    want = {conv: report(sorted(own, key=order)) for conv, own in by_conv.items()} | {5000: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert got == want
    texts_of = collections.defaultdict(list)
    for r in repaired.orderBy("position").collect():
        texts_of[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(texts_of[c]).encode()).hexdigest() == w[-1] for c, w in want.items())
    assert conversation_repair.plan_repairs(frame.limit(0)).count() == 0


def test_op12_damage_and_columns(spark):
    original = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = collections.defaultdict(list)
    for conv, turn, role, text in original:
        rest = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        hurt.setdefault(conv, [])
        text = "" if rest == 1 else re.sub("[.!?]", "", text) if rest == 2 else text
        hurt[conv] += [] if rest == 0 else [(turn, "user" if rest == 4 else role, text)] * (2 if rest == 3 else 1)
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = queries.op12_conversation_repair(spark, SF).collect()
    assert len(rows) == len(hurt)
    for r in rows:
        own = sorted(hurt[r.conv_id], key=lambda t: t[0])
        if len(own) <= 6:
            assert tuple(r[c] for c in columns) == report(own)


def test_damage_of_nulls(spark):
    keys = [(c, t) for c, t in itertools.product([None, 1, 2, 3], [None, 0, 1, 2, 3, 4, 5, 6, 7])]
    frame = spark.createDataFrame([(c, t, None, "A.b") for c, t in keys], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = collections.Counter(map(tuple, queries.damaged(frame).collect()))
    want = collections.Counter()
    for c, t in keys:
        rest = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "Ab"}.get(rest, "A.b")
        want[c, t, "user" if rest == 4 else " ", text] += 0 if rest == 0 else 2 if rest == 3 else 1
    assert got == +want


# Exact duplicates


def brute_groups(rows, largest=True):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    found = []
    for text, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = (max(real) if largest else min(real)) if real else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for i in ids:
            found.append((i, keep, len(ids), i == keep and not kept, digest))
            kept |= i == keep
    return collections.Counter(found)


@pytest.mark.parametrize("partitions,largest", [(1, True), (7, True), (40, False)])
def test_exact_duplicates_against_brute_force(spark, partitions, largest):
    """One, two and three levels of runs; a third of the rows are copies of one text."""
    draw = random.Random(partitions)
    rows = [(k, "Hot Text") for k in range(400)] + [(k, draw.choice(["a", "A", "É", "é", "b b", f"own {k}"])) for k in range(400, 1000)]
    rows += [(None, "a"), (None, "null only"), (None, "null only"), (7, "same"), (7, "same"), (2**60, None), (-5, ""), (-5, " "), (3, "x" * 200_000), (4, "X" * 200_000)]
    draw.shuffle(rows)
    docs = clash(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(partitions))
    got = digest_runs.exact_duplicates(docs, largest)
    assert collections.Counter(map(tuple, got.collect())) == brute_groups(rows, largest)
    assert digest_runs.exact_duplicates(docs.limit(0)).count() == 0
    left = digest_runs.without_duplicates(docs, largest)
    assert left.columns == docs.columns and left.count() == len({(t or "").translate(LOWER) for _, t in rows})


def test_runs_are_merged_across_batches():
    shas = sorted(hashlib.sha256(bytes([k % 5])).digest() for k in range(60))
    table = pa.table(
        {"run": pa.array([0] * 60, pa.int32()), "sha": shas, "size": pa.array([1] * 60, pa.int32()), "check": [3] * 30 + [4] * 30, "id": list(range(60)), "row": list(range(60)), "n": [2] * 60}
    )
    whole = [r for b in digest_runs._merge(iter(table.to_batches())) for r in b.to_pylist()]
    parts = [r for b in digest_runs._merge(iter(table.to_batches(max_chunksize=7))) for r in b.to_pylist()]
    assert whole == parts and sum(r["n"] for r in whole) == 120
    # One digest stands across the change of the second hash and stays two entries.
    assert len(whole) == 6 and np.all(np.diff([r["id"] for r in whole]) > 0)
