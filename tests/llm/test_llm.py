"""Edge cases of the training-data operators, and comparisons with brute force on small tables."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tastemill.llm import attention_lm, bpe_tree, embedding_polytope, graph, latent_leaks, line_align, minhash_oph, pii_crf, queries, rans_blocks, secret_parts, toxic_segments
from tastemill.session import shared_dir

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "ab" * 40_000
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "same text of a few words here"), (5, "same text of a few words here"),
    (None, "no id but some words in it"), (6, "É\x1c x\x85y  z ​<|endoftext|> 🙂 it's"), (7, "the of and " * 300), (2**60, "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls, blanks, a very long text, repeats, and columns whose names clash with those of operators."""
    frame = spark.createDataFrame(ODD, "doc_id BIGINT, text STRING")
    clashing = ["key", "h", "node", "score", "text2", "ids", "gone", "label", "row", "found", "spans", "kept"]
    return frame.select("*", *[F.lit(1).alias(c) for c in clashing], F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(3).cast("bigint").alias("n_chars"))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in queries.documents(spark, SF).collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("leaf", [2, 3, 16, 256])
def test_encoder_equals_the_library(leaf):
    tokenizer, ours, decode = Tokenizer.from_file(PATH), bpe_tree.TreeEncoder(PATH, leaf), bpe_tree.Decoder(PATH).decode
    parts = ["a", "the", "ing", " ", "  ", "\n", "'s", "'", "<|endoftext|>", "<|endof", "é", "日本", "\x1c", "\x85", "12", "!!", "...", "🙂", "\x00", "_", "abcdefghij"]
    draw = random.Random(leaf)
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(400)] + [t or "" for _, t in ODD]
    ids, lengths = ours.encode(made)
    ends = np.cumsum(lengths)
    for text, end, n in zip(made, ends, lengths):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[end - n : end].tolist() == want
        assert decode(want) == tokenizer.decode(want, skip_special_tokens=False)


def test_op3_and_op5_against_the_library(spark, texts):
    tokenizer, start = Tokenizer.from_file(PATH), 0
    ids_of, file_of = {}, {}
    for doc_id in sorted(texts):
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        ids_of[doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        ids.append(2)
        file_of[doc_id] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert {r[0]: tuple(r[1:]) for r in queries.op3_bpe_tree(spark, SF).collect()} == ids_of
    assert {r[0]: tuple(r[1:]) for r in queries.op5_rans_blocks(spark, SF).collect()} == file_of


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 70_000])
def test_blocks_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.4, n) - 1, 50256)
    table = rans_blocks.Table.of(np.bincount(ids, minlength=50257))
    assert int(table.freq.sum()) == 1 << rans_blocks.BITS and int(table.freq.min()) >= 1
    symbols = np.repeat(np.arange(50257), table.freq.astype(int))
    assert (rans_blocks.decode_block(n, *rans_blocks.encode_block(ids, table), table, symbols) == ids).all()


def test_damaged_blocks_are_noticed(spark, odd):
    path, broken = shared_dir(spark, "rans"), shared_dir(spark, "rans")
    rans_blocks.write_file(odd, PATH, path)
    assert rans_blocks.read_file(spark, path).count() == len(ODD)
    spark.read.parquet(f"{path}/frequencies").write.parquet(f"{broken}/frequencies")
    spark.read.parquet(f"{path}/blocks").withColumn("checksum", F.col("checksum") + 1).write.parquet(f"{broken}/blocks")
    with pytest.raises(Exception, match="damaged"):
        rans_blocks.read_file(spark, broken).collect()


def brute_components(sets, num=80, den=100):
    top = {k: k for k in sets}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and both * den >= len(sets[a] | sets[b]) * num:
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return {k: find(k) for k in keys}


def shingles(text, n):
    own = words(text)
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if len(own) >= n else ({tuple(own)} if own else set())


def test_op10_against_brute_force(spark, texts):
    sets = {k: shingles(t, 4) for k, t in texts.items()}
    roots = brute_components(sets)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op10_minhash_oph(spark, SF).collect()}
    assert got == {k: (len(s), roots[k], roots[k] == k) for k, s in sets.items()}


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Many edited copies whose likeness spreads around the threshold, with all open buckets compared in small tiles."""
    monkeypatch.setattr(graph, "FEW", 2)
    monkeypatch.setattr(graph, "TILE_ROWS", 7)
    draw, base = random.Random(1), [f"w{i}" for i in range(60)]
    made = {}
    for k in range(60):
        own = list(base)
        for _ in range(draw.randint(0, 5)):
            own[draw.randrange(60)] = f"x{k}-{draw.randrange(99)}"
        made[k] = " ".join(own)
    roots = brute_components({k: shingles(t, 5) for k, t in made.items()})
    docs = spark.createDataFrame(list(made.items()), "doc_id BIGINT, text STRING")
    assert {r.doc_id: r.component_id for r in minhash_oph.near_duplicates(docs).collect()} == roots


def test_op7_against_brute_force(spark):
    rows = queries.op7_embedding_polytope(spark, SF).collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    keys = sorted(vectors)
    unit = np.array([vectors[k] / np.linalg.norm(vectors[k]) for k in keys])
    near = unit @ unit.T >= 0.95
    assert {r.vec_id: r.n_links for r in rows} == {k: int(n) - 1 for k, n in zip(keys, near.sum(axis=1))}
    assert all(r.kept == (r.component_id == r.vec_id) for r in rows)


def test_odd_vectors(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0, 2.0]), (6, [2.0, 4.0]), (5, [1.0, 2.0]), (7, [1.0]), (8, [])]
    frame = spark.createDataFrame(bad, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("node", F.lit(1))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_polytope.near_vectors(frame).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 2, 5), (5, 2, 5), (6, 2, 5), (7, 0, 7), (8, 0, 8)]


def test_pii_patterns_equal_the_expressions():
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    ip, card, phone = (re.compile(p) for p in (r"[0-9]+(?:\.[0-9]+){3}", r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))
    parts = [*"0123456789.@+- ()", "a", "b_", "é", "4242424242424242", "1.2.3.4", "x@y.z", "+1 (342) 555-8390", "\n"]
    draw = random.Random(3)
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))
        want = [(m.start(), 0, m.end()) for m in mail.finditer(text)]
        want += [(m.start(), 1, m.end()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        digits = [(m, re.sub("[^0-9]", "", m[0])) for m in card.finditer(text)]
        want += [(m.start(), 2, m.end()) for m, d in digits if 12 <= len(d) <= 19 and pii_crf.luhn(d)]
        want += [(m.start(), 3, m.end()) for m in phone.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert pii_crf.base_spans(text) == sorted(want)


def test_repeated_numbers_share_their_label(spark):
    text = "Call +1 (342) 555-8390 now. Later 342-555-8390 or 3425558390, room 1234567."
    docs = spark.createDataFrame([(k, text.replace("8390", str(8000 + k))) for k in range(40)], "doc_id BIGINT, text STRING")
    row = pii_crf.find_personal_data(docs).filter("doc_id = 7").first()
    assert len(row.base) == 1 and {s.kind for s in row.spans} == {3}
    assert len(row.spans) == 3


ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def test_secret_patterns_equal_the_expressions(spark):
    parts = ["password", "ToKen", "api_key", "secret", "=", ":", " ", '"', "abc", "abcdef0123", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "\x01", "\x02", "\n", "🙂"]
    draw = random.Random(5)
    made = {k: "".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for k in range(800)}
    docs = spark.createDataFrame(list(made.items()), "doc_id BIGINT, text STRING")
    got = {r.doc_id: [(s.start, s.rank, s.end) for s in r.spans if s.rank < 3] for r in secret_parts.find_secrets(docs).collect()}
    for k, text in made.items():
        want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert got[k] == sorted(want)


def test_weak_parts_count_only_together(spark):
    value = "Zx81mmQ27pLw90aT"
    docs = [(1, f"user = alice and {value} at db.example.org:5432"), (2, f"only {value} alone"), (3, "user = alice alone"), (4, f"user = alice {'x ' * 300}{value}")]
    rows = secret_parts.find_secrets(spark.createDataFrame(docs, "doc_id BIGINT, text STRING")).collect()
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in rows}
    assert kinds == {1: ["ident", "value", "endpoint"], 2: [], 3: [], 4: []}


def test_long_values_count(spark):
    """A secret-like value has no longest length."""
    sizes = (16, 64, 65, 88, 500, 70_000)
    docs = [(n, f"user = alice {('Zx81+mQ27/pLw90aT' * n)[:n]} at db.example.org:5432") for n in sizes]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_parts.find_secrets(spark.createDataFrame(docs, "doc_id BIGINT, text STRING")).collect()}
    for n in sizes:
        assert found[n] == [("ident", 0, 12), ("value", 13, 13 + n), ("endpoint", 17 + n, 36 + n)]


def test_links_against_brute_force(spark):
    """All pairs with a gap of at most a scope are linked, at all offsets and for long parts."""
    kinds = {"ident": "who", "endpoint": "where", "value": "what"}
    draw, parts = random.Random(3), []
    for offset in range(0, 400, 3):
        for gap in (0, 161, 199, 200, 201):
            first, second = draw.choice([("ident", "value"), ("value", "ident"), ("endpoint", "value"), ("value", "endpoint"), ("ident", "endpoint")])
            end = offset + draw.choice([1, 40, 250, 1_000])
            own = [(first, offset, end), (second, end + gap, end + gap + draw.choice([16, 300, 5_000]))]
            parts += [(f"{offset}-{gap}", k, 3, kinds[k], a, b) for k, a, b in own]
    parts += [("trace", "ident", 3, "who", 199, 239), ("trace", "value", 5, "what", 400, 420)]
    frame = spark.createDataFrame(parts, "key STRING, kind STRING, rank INT, role STRING, start INT, end INT")
    want = set()
    for x, y in [*zip(parts[::2], parts[1::2])]:
        if (x[3] == "what") != (y[3] == "what") and y[4] - x[5] <= secret_parts.SCOPE:
            want |= {x, y}
    assert ("trace", "ident", 3, "who", 199, 239) in want
    got = [(r.key, r.kind, r.rank, r.role, r.start, r.end) for r in secret_parts.linked(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_line_alignment_against_brute_force(spark, texts):
    """Every run of whole lines with enough words that an earlier document holds is deleted, and nothing but common blocks."""
    seen, holders = {}, {}
    for doc_id in sorted(texts):
        lines = [x.rstrip() for x in (texts[doc_id] or "").split("\n")]
        count, gone, own = [len(x.split()) for x in lines], set(), []
        for a in range(len(lines)):
            total, b = 0, a
            while b < len(lines) and total < line_align.MIN_WORDS:
                total, b = total + count[b], b + 1
            if count[a] and total >= line_align.MIN_WORDS:
                own.append(tuple(lines[a:b]))
                if own[-1] in seen:
                    gone.update(range(a, b))
        for run in own:
            seen.setdefault(run, doc_id)
        holders[doc_id] = gone
    for row in queries.op6_line_align(spark, SF).collect():
        assert holders[row.doc_id] <= set(row.deleted_lines)
        assert bool(holders[row.doc_id]) == bool(row.deleted_lines)
        lines = (texts[row.doc_id] or "").split("\n")
        assert row.text == "\n".join(x for k, x in enumerate(lines) if k not in set(row.deleted_lines))
        held = {x.rstrip() for h in row.holder_ids for x in texts[h].split("\n")}
        assert {lines[k].rstrip() for k in row.deleted_lines} <= held


def test_moved_and_repeated_lines():
    a, b = np.array([1, 2, 3, 4, 5, 6]), np.array([9, 4, 5, 6, 8, 1, 2, 3])
    assert line_align.deleted_lines(a, np.full(6, 10), b, np.full(8, 10), 20) == [1, 2, 3, 5, 6, 7]
    same = np.array([7] * 50)
    assert line_align.deleted_lines(same, np.full(50, 5), same[:30], np.full(30, 5), 20) == list(range(30))


def test_lines_that_cross_the_alignment(spark):
    """Every line with words in a common block of enough words goes, whatever the order of the blocks."""
    h, p = 1, 2
    assert line_align.deleted_lines(np.array([h, p]), np.array([3, 50]), np.array([p, h]), np.array([50, 3]), 20) == [0]
    draw = random.Random(4)
    for _ in range(400):
        size = {k: draw.choice([0, 2, 5, 9, 25]) for k in range(12)}
        a, b = ([draw.randrange(12) for _ in range(draw.randrange(1, 30))] for _ in range(2))
        count = lambda x: np.array([size[k] for k in x])
        want = set()
        for i in range(len(b)):
            for j in range(i + 1, len(b) + 1):
                if sum(size[k] for k in b[i:j]) >= 20 and any(a[k : k + j - i] == b[i:j] for k in range(len(a))):
                    want.update(range(i, j))
        got = set(line_align.deleted_lines(np.array(a), count(a), np.array(b), count(b), 20))
        assert got <= want and all(size[b[k]] == 0 for k in want - got)
    # The first holder of the passage does not hold the line after it; another document does.
    passage, tail = " ".join(f"w{k}" for k in range(30)), "and a tail"
    docs = [(1, passage), (2, f"{passage}\n{tail}"), (3, f"own words\n{passage}\n{tail}")]
    left = line_align.remove_repeated(spark.createDataFrame(docs, "doc_id BIGINT, text STRING")).collect()
    assert {r.doc_id: r.text for r in left} == {1: passage, 2: tail, 3: "own words"}


def test_leaks_against_brute_force(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    plain = lambda t: latent_leaks.words_of(pa.array([t]))[0].to_pylist()
    joined = {k: f" {' '.join(plain(t or ''))} " for k, t in texts.items()}
    want = {(k, i) for i, t in items.items() for k, own in joined.items() if f" {' '.join(plain(t))} " in own}
    got = {(r.doc_id, r.item_id): r for r in queries.op1_latent_leaks(spark, SF).collect()}
    assert want <= set(got)
    for (doc_id, item_id), row in got.items():
        assert latent_leaks.densest(plain(items[item_id]), plain(texts[doc_id]), 0)[0] >= latent_leaks.PARAPHRASE


def test_a_paraphrase_needs_the_answer(spark):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    question, answer = [word() for _ in range(20)], [word() for _ in range(10)]
    item = " ".join(question) + ". " + " ".join(answer)
    changed = " ".join(w if k % 2 else word() for k, w in enumerate(question))
    docs = [(k, " ".join(word() for _ in range(120))) for k in range(60)]
    docs += [(100, f"{changed}. {' '.join(answer)}"), (101, f"{changed}. {' '.join(word() for _ in answer)}"), (102, item.upper())]
    frame, bench = spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame([(1, item), (2, None), (3, " ")], "item_id BIGINT, text STRING")
    assert sorted(r.doc_id for r in latent_leaks.leaks(frame, bench).collect()) == [100, 102]
    assert latent_leaks.leaks(frame, bench.limit(0)).count() == 0


def test_frequent_and_long_items_are_found(spark):
    """An item in a third of all rows, one of common words, and one of 1,000 words, verbatim and with every fourth word replaced."""
    draw = random.Random(6)
    filler = lambda n, stem: " ".join(f"{stem}{draw.randrange(3_000)}" for _ in range(n))
    often, common, long = filler(16, "often"), "to be or not to be that is the thing", filler(1_000, "long")
    changed = " ".join(w if k % 4 else f"other{k}" for k, w in enumerate(long.split()))
    docs = [(k, f"{filler(40, 'x')} to be that {often if k % 3 == 0 else 'or not is the thing'} {filler(60, 'y')}") for k in range(300)]
    docs += [(1_000, f"{filler(50, 'x')} {common} {filler(50, 'x')}"), (1_001, f"{filler(70, 'x')} {long} {filler(70, 'x')}"), (1_002, f"{filler(70, 'x')} {changed}")]
    bench = spark.createDataFrame([(1, often), (2, common), (3, long)], "item_id BIGINT, text STRING")
    got = {(r.doc_id, r.item_id) for r in latent_leaks.leaks(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), bench).collect()}
    assert got == {(k, 1) for k in range(0, 300, 3)} | {(1_000, 2), (1_001, 3), (1_002, 3)}


def test_all_maximal_segments():
    scores = np.zeros(300)
    scores[[10, 12, 200]] = 2.0, 3.0, 4.0
    found = toxic_segments.segments(np.flatnonzero(scores).tolist(), scores)
    assert [(a, b) for a, b, _ in found] == [(10, 12), (200, 200)]
    assert found[0][2] == pytest.approx(5 - 3 * toxic_segments.DRIFT)


def test_toxicity_on_held_out_rows(spark):
    docs, toxic = [], []
    draw = random.Random(4)
    for k in range(600):
        own = [draw.choice("abcdefgh") + draw.choice("aeiou") * draw.randint(1, 4) for _ in range(40)]
        if k % 4 == 0:
            own[draw.randrange(40)] = draw.choice(["grumpf", "blarg"]) + draw.choice("xyz")
        docs.append((k, " ".join(own)))
        toxic.append((k, int(k % 4 == 0)))
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([*toxic, (None, 1), (3, None)], "doc_id BIGINT, toxic INT")
    model = toxic_segments.fit(frame, labels.filter("doc_id % 3 <> 1"))
    scored = toxic_segments.score(frame, model, "p").filter("doc_id % 3 = 1").collect()
    assert all((r.p >= 0.7) == (r.doc_id % 4 == 0) for r in scored)
    assert toxic_segments.fit(frame, labels.limit(0)).probability(0.0) < 0.01


def test_op4_base_score_against_brute_force(spark, texts):
    rows = {r.doc_id: r for r in queries.op4_attention_lm(spark, SF).collect()}
    own = {k: [*words(t), None] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    counts = collections.Counter(w for k, ws in own.items() if not held[k] for w in ws)
    total, floor = counts.total(), counts.total() + 0.1 * (len(counts) + 1)
    for k, ws in own.items():
        row = rows[k]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[k], len(ws), sum(counts[w] > 0 for w in ws), total)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / floor) for w in ws))
    unseen = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


@pytest.fixture(scope="module")
def attention():
    draw = np.random.default_rng(0)
    size = 50257
    known = attention_lm.Vocabulary(np.bincount(draw.integers(0, 50, 999), minlength=size), attention_lm.beginnings(PATH, size))
    return attention_lm.train(draw.integers(0, 50, (640, attention_lm.WIDTH + 1)), known, epochs=2)


def test_attention_windows(attention):
    """Overlapping windows give what one long pass gives at the start."""
    draw = np.random.default_rng(1)
    lengths = np.array([0, 5, 31, 32, 33, 200])
    ids = draw.integers(0, 50, lengths.sum())
    for all_ in attention.score(ids, lengths):
        assert len(all_) == lengths.sum() + len(lengths) and np.isfinite(all_).all() and (all_ < 0).all()
    for alone, all_ in zip(attention.score(ids[:5], np.array([5])), attention.score(ids, lengths)):
        assert np.allclose(alone, all_[1:7], atol=1e-4)


def test_shares_of_words_sum_to_one(attention):
    """After any context the ids sum to one, and so do words: beginnings, and of other ids those that go on or end."""
    known = attention.known
    assert np.allclose(np.bincount(known.group, np.exp(known.inside)), 1)
    draw = np.random.default_rng(2)
    x = draw.integers(0, 60, (1, attention_lm.WIDTH))
    every = np.arange(50257)
    for place in (0, 7, 31):
        targets = np.zeros((len(every), attention_lm.WIDTH), dtype=np.int64)
        targets[:, place] = every
        p = np.concatenate([np.exp(attention.log_probability(np.repeat(x, 1000, axis=0)[: len(t)], t, 0)[0][:, place]) for t in np.array_split(targets, 60)])
        begins = np.exp(attention.log_probability(x, targets[:1], 0)[1][0, place])
        assert p.sum() == pytest.approx(1, abs=1e-3)
        assert p[known.begins].sum() == pytest.approx(begins, abs=1e-3)
    # A word's share by its definition: first id among beginnings, the others, and a beginning after the last.
    text = pa.array(["some odd words: antidisestablishment", "", "x"])
    which, own, per_text = attention_lm.words_of(text)
    ids, per_word = attention_lm.ids_of_words(PATH, which, own)
    of_word, of_end = attention.word_scores(ids, per_word, per_text)
    before = np.concatenate([[0], np.cumsum(per_word)])
    ends = np.cumsum(per_text)
    each, begins = attention.score(ids, before[ends] - before[ends - per_text])
    at, place, k = 0, 0, 0
    for n in per_text.tolist():
        for _ in range(n):
            m = int(per_word[k])
            assert of_word[k] == pytest.approx(each[place : place + m].sum() - begins[place] + begins[place + m], abs=1e-4)
            place, k = place + m, k + 1
        assert of_end[at] == pytest.approx(each[place] - begins[place], abs=1e-4)
        place, at = place + 1, at + 1
    assert of_end[1] == pytest.approx(of_end[1]) and (of_word < 0).all() and (of_end < 0).all()


def test_words_are_encoded_alike_from_batch_to_batch():
    kept = attention_lm.WordEncoder(PATH, most=6)
    for words_ in (["a", "bb", "ccc"], ["bb", "dddd", "a"], ["é", "a", "bb", "x" * 300], ["zz"], ["a", "zz"]):
        which, own = np.array([0, *range(len(words_))]), pa.array(words_, pa.large_string())
        for got, want in zip(kept.ids_of(which, own), attention_lm.ids_of_words(PATH, which, own)):
            assert got.tolist() == want.tolist()


def test_ids_are_counted_over_all_words(spark):
    docs = spark.createDataFrame([(k, f"the other unusualword{k % 3} word") for k in range(30)] + [(99, "")], "doc_id BIGINT, text STRING")
    got = attention_lm.count_ids(attention_lm.count_words(docs), PATH, 50257)
    which, own, per_text = attention_lm.words_of(pa.array([r.text for r in docs.collect()]))
    want = np.bincount(attention_lm.ids_of_words(PATH, which, own)[0], minlength=50257)
    want[attention_lm.END] += 31
    assert (got == want).all()


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_everywhere(spark, odd, empty):
    docs = odd.limit(0) if empty else odd
    n = 0 if empty else len(ODD)
    bench = spark.createDataFrame([(1, "the of and the of and a question. yes")], "item_id BIGINT, text STRING")
    labels = spark.createDataFrame([(5, 1), (7, 0), (None, 0)], "doc_id BIGINT, toxic INT")
    assert bpe_tree.encode_decode(docs, PATH).count() == n
    assert line_align.remove_repeated(docs).count() == n
    found = minhash_oph.near_duplicates(docs).collect()
    assert len(found) == n and all(r.component_id == r.doc_id for r in found)
    assert pii_crf.find_personal_data(docs).count() == n
    assert secret_parts.find_secrets(docs).count() == n
    assert toxic_segments.score(docs, toxic_segments.fit(docs, labels), "p").filter("p BETWEEN 0 AND 1").count() == n
    assert latent_leaks.without_leaks(docs, bench).count() <= n
    scored = attention_lm.score_texts(docs.withColumn("flag", F.lit(False)), "flag", PATH).collect()
    assert len(scored) == n and all(math.isfinite(r.score) for r in scored)
    path = shared_dir(spark, "odd")
    rans_blocks.write_file(docs, PATH, path)
    read = rans_blocks.read_file(spark, path).orderBy("start").collect()
    assert len(read) == n and all(a.start + a.n_tokens == b.start for a, b in zip(read, read[1:]))


def test_pipeline_keeps_columns_and_decides(spark):
    docs = queries.documents(spark, SF)
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        path = shared_dir(spark, "step")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.join(docs.select("doc_id", "text"), "doc_id").filter("decoded <> text").count() == 0
    assert last.count() == before


def test_secrets_run_without_python(spark):
    """Neither the search for the parts, which is staged, nor what follows has a Python step."""
    texts = queries.documents(spark, SF).select(F.struct("doc_id").alias("key"), "text")
    for frame in (queries.op9_secret_parts(spark, SF), secret_parts.candidates(texts), secret_parts.linked(secret_parts.candidates(texts))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)
