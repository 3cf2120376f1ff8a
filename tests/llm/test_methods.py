"""The methods themselves: segments by definition, marginals by enumeration, one-pass alignment, hard texts, every stage's rule."""

import hashlib
import itertools
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tastemill.llm import attention_lm, common, embedding_polytope, latent_leaks, line_align, minhash_oph, phrase_stripes, pii_crf, queries, secret_parts, toxic_segments
from tastemill.session import shared_dir, shared_root
from tastemill.staging import scratch

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Toxicity


def by_definition(scores):
    """The best segment, and by the same rule the best ones on either side of it."""
    if not len(scores):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(((total[j] - total[i], i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    right = [(a + j, b + j, s) for a, b, s in by_definition(scores[j:])]
    return by_definition(scores[:i]) + [(i, j - 1, best[0])] + right


def test_segments_by_definition():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = rng.integers(1, 40)
        own = np.where(rng.random(n) < 0.3, rng.random(n) * 0.3, 0.0)
        got = toxic_segments.segments(np.flatnonzero(own > 0).tolist(), own)
        want = by_definition(own - toxic_segments.DRIFT)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_tied_segments_are_defined():
    """Of segments with equal sums the scan keeps what joins without loss: all of them add up to the same evidence."""
    drift = toxic_segments.DRIFT
    own = np.array([1.0, 0.0, 1.0]) + 0.0
    assert [(a, b) for a, b, _ in toxic_segments.segments([0, 2], own)] == [(0, 2)]
    flat = np.full(4, drift)
    assert toxic_segments.segments([0, 1, 2, 3], flat) == []


def test_op2_columns(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op2_toxic_segments(spark, SF).collect()
    assert len(rows) == queries.documents(spark, SF).count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    # Some forty labelled rows teach little here; the figures of larger tables are in the README.
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= 0.8 * len(known)


def test_a_harmless_form_of_a_toxic_stem_is_cleared(spark):
    """However many features there are, a form that only clean texts hold does not inherit its stem's score."""
    draw, rows = random.Random(1), []
    for k in range(900):
        own = [f"w{draw.randrange(400)}" for _ in range(20)]
        if k % 3 == 0:
            own[3] = "grumpf" + draw.choice("xyz")
        elif k % 3 == 1:
            own[3] = "grumpfen"
        rows.append((k, " ".join(own), int(k % 3 == 0)))
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")
    model = toxic_segments.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert model.token_score("grumpfx") > 1 and model.token_score("grumpfnew") > 1
    assert model.token_score("grumpfen") == 0.0


# Personal data


def exact(field, features, seen, edges, barred):
    """Marginals by enumeration of all labellings."""
    local = features @ field.shapes
    local[barred] = -30.0
    local[seen >= 0] = -30.0
    local[seen >= 0, seen[seen >= 0]] = 0.0
    n, labels = len(features), len(pii_crf.LABELS)
    total = np.zeros((n, labels))
    for chosen in itertools.product(range(labels), repeat=n):
        weight = sum(local[i, y] for i, y in enumerate(chosen)) + sum(pair[chosen[i], chosen[j]] for i, j, pair in edges)
        total[range(n), chosen] += np.exp(weight)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(6))
def test_messages_against_enumeration(seed, monkeypatch):
    """Exact on trees; on graphs with a cycle the likeliest labels are the same."""
    monkeypatch.setattr(pii_crf, "ROUNDS", 60)
    rng = np.random.default_rng(seed)
    n, labels = 5, len(pii_crf.LABELS)
    field = pii_crf.Field(rng.standard_normal((pii_crf.N_FEATURES, labels)) * 0.3, rng.standard_normal((labels, labels)), rng.standard_normal((labels, labels)) * 0.5)
    features = rng.random((n, pii_crf.N_FEATURES))
    seen = np.array([-1, 2, -1, -1, -1])
    barred = np.zeros((n, labels), dtype=bool)
    barred[3, 1] = True
    for cycle in (False, True):
        chain = np.array([(0, 1), (1, 2), (3, 4)])
        skip = np.array([(0, 3), (2, 4)] if cycle else [(0, 3)])
        edges = [(i, j, field.chain) for i, j in chain] + [(i, j, field.skip) for i, j in skip]
        want = exact(field, features, seen, edges, barred)
        got = field.beliefs(features, seen, chain, skip, barred)
        if cycle:
            assert np.abs(got - want).max() < 0.1
        else:
            assert np.allclose(got, want, atol=1e-4)


def test_refused_numbers_are_not_added(spark):
    """What a pattern looked at and refused is not of that kind: a number that fails Luhn is no card."""
    cards = ["4242424242424242", "5555555555554444", "378282246310005"]
    rows = [(k, f"card {cards[k % 3]} and more") for k in range(60)] + [(100, "card 5693240340017844 in plain prose"), (101, "host 300.1.1.1 or 1.2.3.999")]
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii_crf.find_personal_data(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert 2 not in found[100] and 1 not in found[101]
    assert all(2 in found[k] for k in range(60))


def test_added_spans_on_clean_and_planted_texts(spark):
    """Repeats without a pattern are found, and clean texts with numbers get nothing."""
    draw, rows = random.Random(2), []
    for k in range(200):
        number = f"+1 (3{k % 90 + 10}) 555-{1000 + k}"
        local = f"3{k % 90 + 10}-555-{1000 + k}"
        rows.append((k, f"Call {number} today. The same line, {local}, is open. {draw.randrange(10**6)} visitors came."))
    rows += [(1000 + k, f"In {1900 + k % 100} some {draw.randrange(10**5)} people and {draw.randrange(100)} dogs, chapter {k}.") for k in range(200)]
    found = {r.doc_id: (len(r.base), len(r.spans)) for r in pii_crf.find_personal_data(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert sum(found[k][1] > found[k][0] for k in range(200)) >= 180
    assert sum(found[1000 + k][1] for k in range(200)) == 0


@pytest.mark.parametrize("name", ["op8_pii_crf", "op9_secret_parts"])
def test_columns_of_span_queries(spark, name):
    """Counts, hash and span text as the contract words them, from the expressions."""
    texts = {r.doc_id: r.text or "" for r in queries.documents(spark, SF).collect()}
    for r in getattr(queries, name)(spark, SF).collect():
        text, spans = texts[r.doc_id], []
        if name == "op8_pii_crf":
            spans = [(a, k, b, pii_crf.KINDS[k]) for a, k, b in pii_crf.base_spans(text)]
            counts = [r.n_email, r.n_ip, r.n_card, r.n_phone]
            want = [sum(s[1] == k for s in spans) for k in range(4)]
        else:
            assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
            spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[1]) >= 6]
            spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
            spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
            spans.sort()
            counts = [r.n_assign, r.n_access, r.n_hex]
            want = [sum(s[1] == k for s in spans) for k in range(3)]
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert counts == want
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",") if joined else []) <= set(r.spans.split(",") if r.spans else [])


# Hard texts

MB = 1_000_000
HARD = {
    "dots": "x " + "a." * (MB // 2) + "b:443 end",
    "digits": "7" * MB,
    "letters": "q" * MB,
    "at": "@" * MB,
    "colons": "a:" * (MB // 2),
    "quotes": "password" + '"' * MB,
    "spaces": "token" + " " * MB + "= abcdef",
    "matches": "api_key=abcdef12 " * 20_000,
    "numbers": "+1 555 123 4567 " * 20_000,
}


@pytest.mark.parametrize("kind", sorted(HARD))
def test_hard_texts(spark, kind):
    """A text of a megabyte that meets a pattern's worst case takes seconds and ends no worker."""
    docs = spark.createDataFrame([(1, HARD[kind])], "doc_id BIGINT, text STRING").withColumn("lang", F.lit(None).cast("string"))
    start = time.monotonic()
    found = secret_parts.find_secrets(docs).first()
    assert len(found.spans) == (20_000 if kind == "matches" else len(found.spans))
    middle = time.monotonic()
    assert middle - start < 30
    pii_crf.base_spans(HARD[kind])
    pii_crf.candidates(HARD[kind])
    assert time.monotonic() - middle < 30
    middle = time.monotonic()
    phrase_stripes.top_collocations(docs).count()
    assert time.monotonic() - middle < 30


def test_long_documents_are_aligned_in_one_pass():
    n = 100_000
    lines, words = np.arange(n), np.full(n, 25)
    start = time.monotonic()
    assert line_align.deleted_lines(lines, words, lines[::-1].copy(), words, 20) == list(range(n))
    same = np.zeros(n, dtype=np.int64)
    assert len(line_align.deleted_lines(same, np.full(n, 5), same, np.full(n, 5), 20)) == n
    assert time.monotonic() - start < 30


def test_lines_are_taken_out_whole(spark):
    n = 30_000
    draw = random.Random(5)
    lines = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(22)) for _ in range(n)]
    docs = [(1, "\n".join(lines)), (2, "\n".join([x for pair in zip(reversed(lines), (f"own {k}" for k in range(n))) for x in pair]))]
    start = time.monotonic()
    left = {r.doc_id: r.text for r in line_align.remove_repeated(spark.createDataFrame(docs, "doc_id BIGINT, text STRING")).collect()}
    assert left[1] == docs[0][1] and left[2] == "\n".join(f"own {k}" for k in range(n))
    assert time.monotonic() - start < 60


def test_piles_rise_and_hold_all():
    draw = random.Random(6)
    for _ in range(200):
        places = [draw.randrange(30) for _ in range(draw.randrange(1, 60))]
        found = line_align.piles(places)
        assert sorted(k for pile in found for k in pile) == list(range(len(places)))
        assert all(places[a] <= places[b] and a < b for pile in found for a, b in zip(pile, pile[1:]))


# Embeddings


def test_op7_components_against_brute_force(spark):
    rows = queries.op7_embedding_polytope(spark, SF).collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    keys = sorted(vectors)
    unit = np.array([vectors[k] / np.linalg.norm(vectors[k]) for k in keys])
    near = unit @ unit.T >= 0.95
    top = list(range(len(keys)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in np.argwhere(near):
        a, b = find(i), find(j)
        top[max(a, b)] = min(a, b)
    assert {r.vec_id: r.component_id for r in rows} == {k: keys[find(i)] for i, k in enumerate(keys)}


def test_pairs_at_the_bound_are_judged_alike():
    """The product of two rows and of two tiles agree, also where the cosine is the bound but for rounding."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.standard_normal((60, 48))
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * other
    lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.reshape(-1)))
    tiles = embedding_polytope.near(lists(x), lists(y), 0.95)
    turned = embedding_polytope.near(lists(y), lists(x), 0.95)
    alone = [embedding_polytope.exact_product(a, b) >= 0.95 for a, b in zip(x, y)]
    assert np.diag(tiles).tolist() == alone == np.diag(turned).tolist()


def test_small_tiles_give_the_same_counts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((3, 16))
    vectors = [(k, [float(x) for x in base[k % 3] + rng.standard_normal(16) * 0.05]) for k in range(90)]
    frame = spark.createDataFrame(vectors, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    whole = sorted(map(tuple, embedding_polytope.near_vectors(frame).collect()))
    monkeypatch.setattr(embedding_polytope, "TILE", 4)
    assert sorted(map(tuple, embedding_polytope.near_vectors(frame).collect())) == whole
    unit = np.array([np.array(v) / np.linalg.norm(v) for _, v in vectors])
    assert [r[1] for r in whole] == ((unit @ unit.T >= 0.95).sum(axis=1) - 1).tolist()


# The pipeline


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def texts_with_everything():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghijklm") for _ in range(6))
    own = [" ".join(word() for _ in range(60)) for _ in range(30)]
    passage = " ".join(word() for _ in range(55))
    rows = [(k, t) for k, t in enumerate(own)]
    rows += [(100, f"{own[0]}\n{passage}"), (101, f"{passage}\n{own[1][:20]} tail")]
    rows += [(200, own[2]), (201, own[2].replace(own[2].split()[30], "changed"))]
    rows += [(None, "a row without an id but words"), (None, None), (300, None), (301, ""), (301, ""), (302, " \n "), (303, own[4]), (303, own[4])]
    return rows


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    return frame.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"), F.lit(1).alias("key"), F.lit("x").alias("gone"))


def test_stages_with_nulls_repeats_and_nothing(spark):
    docs = frame_of(spark, texts_with_everything())
    for rows in (docs, docs.limit(0)):
        for name, run in corpus_pipeline.STAGES[:-1]:
            out = run(spark, rows, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= rows.count()
        assert dict(corpus_pipeline.STAGES)["bpe"](spark, rows, SF).count() == rows.count()


def test_line_stage_by_its_rule(spark):
    rows = texts_with_everything()
    passage = rows[30][1].split("\n")[1]
    out = {r.doc_id: r for r in stage("line_dedup")(spark, frame_of(spark, rows), SF).collect() if r.doc_id in (100, 101)}
    assert passage in out[100].text and passage not in out[101].text and "tail" in out[101].text
    assert out[101].n_chars == len(out[101].text)


def test_near_duplicate_stage_by_its_rule(spark):
    """One row of each group of near duplicates stays, the first; of others all do."""
    rows = texts_with_everything()
    out = [r.doc_id for r in stage("minhash")(spark, frame_of(spark, rows), SF).collect()]

    def shingles(text):
        ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())

    sets = [(k if k is not None else 10**9, t, shingles(t)) for k, t in rows]
    gone = set()
    for k, t, s in sets:
        if any(o < k and s and len(s & x) * 100 >= 80 * len(s | x) for o, _, x in sets):
            gone.add(k)
    kept = {k for k, *_ in sets} - gone - {10**9}
    assert sorted(k for k in out if k is not None) == sorted(kept)
    assert out.count(303) == (0 if 303 in gone else 1) and out.count(301) == 1


def test_toxicity_and_leak_stages_by_their_rules(spark):
    docs = queries.documents(spark, SF)
    scored = {r.doc_id: r.score for r in queries.op2_toxic_segments(spark, SF).collect()}
    kept = {r.doc_id for r in stage("toxicity")(spark, docs, SF).collect()}
    assert kept == {k for k, s in scored.items() if s < 0.7}
    leaks = {r.doc_id for r in queries.op1_latent_leaks(spark, SF).collect()}
    left = {r.doc_id for r in stage("decontamination")(spark, docs, SF).collect()}
    assert left == set(scored) - leaks


def test_pipeline_leaves_only_its_result(spark, tmp_path):
    import os

    from tastemill.session import shared_root
    from tastemill.staging import scratch

    before = set(os.listdir(shared_root(spark)))
    with scratch(spark):
        assert corpus_pipeline.run(spark, SF).count() > 0
        left = set(os.listdir(shared_root(spark))) - before
        assert len(left) == 1 and next(iter(left)).startswith("pipeline-bpe")
    assert not set(os.listdir(shared_root(spark))) - before


def test_the_weight_is_fitted(spark):
    """Texts whose words are all new favour the attention model, repeated ones the counts."""
    rows = [(k, "one two three four five six") for k in range(200)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("flag", F.lit(False))
    scored = attention_lm.score_texts(frame, "flag", queries.public_tokenizers.path(queries.TOKENIZER)).collect()
    assert all(r.score > r.base_score - 0.5 for r in scored)


@pytest.mark.xfail(reason="a known gap: 90 of these 120 are found; the cosine gate loses items without a run of 6 words, and there is no second way to them", strict=True)
def test_paraphrases_are_found(spark):
    """Items with evenly spaced words replaced, planted in long texts, wherever the confirming check holds on the whole text."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    draw = random.Random(9)
    plain = lambda t: latent_leaks.words_of(pa.array([t]))[0].to_pylist()
    hosts = [r.text for r in queries.documents(spark, SF).filter("length(text) > 400").orderBy("doc_id").limit(40).collect()]
    docs, want = [], set()
    for n, (step, (item_id, text)) in enumerate(itertools.product((2.5, 3, 4), items.items())):
        own = text.split()
        swapped = {int(k * step) for k in range(len(own))}
        changed = " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) if k in swapped else w for k, w in enumerate(own))
        host = hosts[n % len(hosts)].split(" ")
        at = len(host) // 2
        docs.append((n, " ".join([*host[:at], changed, *host[at:]])))
        if latent_leaks.densest(plain(text), plain(docs[-1][1]), 0)[0] >= latent_leaks.PARAPHRASE:
            want.add((n, item_id))
    bench = spark.createDataFrame(list(items.items()), "item_id BIGINT, text STRING")
    got = {(r.doc_id, r.item_id) for r in latent_leaks.leaks(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), bench).collect()}
    assert len(want & got) >= 0.9 * len(want)


def test_shared_paths_are_not_local_folders(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert minhash_oph.Settings().num == 80


@pytest.mark.parametrize("scale", [1, 40])
def test_scoring_states_are_those_of_training(scale):
    """With and without the care that large products need."""
    draw = np.random.default_rng(9)
    path = queries.public_tokenizers.path(queries.TOKENIZER)
    size = max(len(attention_lm.encoder(path).n_bytes), attention_lm.END + 1)
    known = attention_lm.Vocabulary(np.bincount(draw.integers(0, 5000, 20_000), minlength=size), attention_lm.beginnings(path, size))
    weights = attention_lm.initial(known)
    weights |= {n: weights[n] * np.float32(scale) for n in ("embed", "q", "k")}
    model = attention_lm.Attention(known, **weights)
    x = draw.integers(0, 3000, (300, attention_lm.WIDTH))
    targets = draw.integers(0, 5000, (300, attention_lm.WIDTH))
    for first in (0, attention_lm.WIDTH // 2):
        want = model.hidden(x, first)[-1].reshape(-1, attention_lm.SIZE)
        got = model.states(x, first)
        assert (got[:, -1] == 1).all() and np.allclose(got[:, :-1], want, rtol=2e-4, atol=2e-4 * scale)
        mass = np.exp(np.minimum(want.astype(float) @ model.out + model.bias, attention_lm.MOST))
        share = mass[np.arange(len(mass)), known.group[targets[:, first:].reshape(-1)]] / mass.sum(axis=1)
        found, _ = model.log_probability(x, targets[:, first:], first)
        assert np.allclose(found.reshape(-1), np.log(share) + known.inside[targets[:, first:].reshape(-1)], rtol=2e-3, atol=2e-2 * scale)


def test_word_hashes_are_those_of_the_library():
    words = pa.array(["a", "", "zażółć", "x" * 500, "a"], pa.large_string())
    want = np.array([xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()], dtype=np.uint64).astype(np.int64)
    assert attention_lm.hashes_of(words).tolist() == want.tolist()
    assert attention_lm.hashes_of(words.slice(0, 0)).tolist() == []


def test_slices_are_given_back_before_the_next_batch(monkeypatch):
    """A worker that Spark uses again does not keep the memory of the batches before."""
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(len(seen)))
    seen = []
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 900_000] * 5})
    for part in common.in_slices(iter([batch, batch]), line_align.SLICE):
        seen.append(part.num_rows)
    assert seen == [2, 2, 1] * 2 and given == [3, 6]


def test_the_attention_model_learns_from_all_training_texts(spark, monkeypatch):
    """Every window of every training text is in exactly one round, copies of a text included; few are in all."""
    seen = {}

    def train(windows, known, n_windows):
        seen["rounds"] = [attention_lm.of_round(windows, 10**6, k).count() for k in range(attention_lm.ROUNDS)]
        seen["few"], seen["hashes"] = attention_lm.of_round(windows, 1, 3).count(), windows.select("h").distinct().count()
        return attention_lm.Attention(known, **attention_lm.initial(known))

    monkeypatch.setattr(attention_lm, "train_in_tasks", train)
    texts = [(k, " ".join(f"w{(k * j) % 97}" for j in range(40)) if k % 2 else "one and the same") for k in range(300)]
    frame = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").withColumn("flag", F.col("doc_id") % 3 == 0)
    path = queries.public_tokenizers.path(queries.TOKENIZER)
    assert attention_lm.score_texts(frame, "flag", path).count() == 300
    learnt = pa.array([t for k, t in texts if k % 3])
    which, words, per_text = attention_lm.words_of(learnt)
    _, per_word = attention_lm.ids_of_words(path, which, words)
    ends = np.concatenate([[0], np.cumsum(per_word)])[np.cumsum(per_text)]
    n = sum(-(-(m + 1) // attention_lm.WIDTH) for m in np.diff(ends, prepend=0).tolist())
    assert sum(seen["rounds"]) == seen["few"] == seen["hashes"] == n and min(seen["rounds"]) > 0


def test_windows_are_gone_when_texts_are_scored(spark, monkeypatch):
    """What training staged is removed before scoring stages its own, and windows are not shuffled."""
    there, frames = {}, {}
    stage = attention_lm.stage_table

    def staged(name, df):
        there[name], frames[name] = {n.rsplit("-", 1)[0] for n in os.listdir(shared_root(spark))}, df
        return stage(name, df)

    monkeypatch.setattr(attention_lm, "stage_table", staged)
    with scratch(spark):
        texts = [(k, " ".join(f"w{(k * j) % 97}" for j in range(40))) for k in range(50)]
        frame = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").withColumn("flag", F.col("doc_id") % 3 == 0)
        scored = attention_lm.score_texts(frame, "flag", queries.public_tokenizers.path(queries.TOKENIZER))
        assert scored.count() == 50
    assert there.keys() == {"words", "windows", "texts", "rare"}
    assert "stage-words" in there["texts"] and not {"stage-windows"} & (there["texts"] | there["rare"])
    assert "Exchange" not in frames["windows"]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n_ids", [50_257, 100_000])
def test_windows_are_packed_and_unpacked(n_ids):
    ids = np.random.default_rng(4).integers(0, n_ids, (7, attention_lm.WIDTH + 1))
    ids[3, 5] = n_ids - 1
    rows = attention_lm.packed(ids, n_ids)
    assert len(rows[0].as_py()) == (attention_lm.WIDTH + 1) * (2 if n_ids <= 1 << 16 else 4)
    assert (attention_lm.unpacked(rows) == ids).all() and (attention_lm.unpacked(rows.slice(2, 3)) == ids[2:5]).all()


def test_mixtures_are_those_in_double_precision():
    draw = np.random.default_rng(5)
    log_p, log_q = draw.uniform(-25, 0, 500), draw.uniform(-60, 0, 500)
    log_q[:3] = -200, -900, 0
    for w, more in zip(attention_lm.WEIGHTS, attention_lm.mixtures(log_p, log_q)):
        want = np.log(np.maximum(w * np.exp(log_p) + (1 - w) * np.exp(log_q), attention_lm.LEAST))
        assert np.allclose(log_p + more, want, rtol=1e-5, atol=1e-5)


@pytest.mark.parametrize("scale", [1, 40])
def test_gradients_are_slopes(scale):
    """With and without the care that large products need."""
    draw = np.random.default_rng(6)
    path = queries.public_tokenizers.path(queries.TOKENIZER)
    size = max(len(attention_lm.encoder(path).n_bytes), attention_lm.END + 1)
    known = attention_lm.Vocabulary(np.bincount(draw.integers(0, 5000, 20_000), minlength=size), attention_lm.beginnings(path, size))
    weights = attention_lm.initial(known)
    weights |= {n: weights[n] * np.float32(scale) for n in ("embed", "q", "k")}
    trainer = attention_lm.Trainer(known, weights, 0.01)
    some = draw.integers(0, 3000, (8, attention_lm.WIDTH + 1))
    x, y = known.slot[some[:, :-1]], known.group[some[:, 1:]].reshape(-1)
    trainer._gradient(x, y)

    def surprise(changed):
        state = attention_lm.Attention(known, **changed).hidden(x)[-1].reshape(-1, attention_lm.SIZE)
        logits = state @ changed["out"] + changed["bias"]
        top = logits.max(axis=1)
        return float(np.mean(top + np.log(np.exp(logits - top[:, None]).sum(axis=1)) - logits[np.arange(len(y)), y]))

    double = {n: v.astype(float) for n, v in weights.items()}
    for name, grad in trainer.g.items():
        way = grad.astype(float) / np.linalg.norm(grad)
        step = 1e-5
        ends = [surprise(double | {name: double[name] + sign * step * way}) for sign in (1, -1)]
        assert (ends[0] - ends[1]) / (2 * step) == pytest.approx(np.linalg.norm(grad), rel=2e-2)


@pytest.mark.parametrize("most", [5_000, 10])
def test_an_index_is_fitted_on_all_passages(spark, monkeypatch, most):
    """A'A has every window of every document, copies of a text included, and the items; by brute force."""
    monkeypatch.setattr(latent_leaks, "PASSAGES", 20)
    monkeypatch.setattr(latent_leaks, "GRAM_TERMS", most)
    monkeypatch.setattr(latent_leaks, "GRAM_CELLS", 100)
    seen = {}

    def svd(product, size, rank):
        seen["found"] = product(np.eye(size))
        return np.eye(size)[:, :rank]

    monkeypatch.setattr(latent_leaks, "randomized_svd", svd)
    draw = random.Random(2)
    word = lambda: f"w{draw.randrange(30)}"
    docs = [(k, " ".join(word() for _ in range(draw.choice([0, 1, 15, 16, 17, 48, 49, 130])))) for k in range(60)]
    docs += [(k, docs[5][1]) for k in range(60, 65)]
    items = [" ".join(word() for _ in range(n)) for n in (7, 60)]
    terms = sorted(set(" ".join(items).split()))
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(3)
    index = latent_leaks.build_index(frame, [1, 2], items, {})

    def summed(texts):
        total, n = np.zeros((len(terms), len(terms))), 0
        for words in (t.split() for t in texts):
            for start in range(0, len(words), latent_leaks.STRIDE):
                own = [terms.index(w) for w in words[start : start + latent_leaks.WINDOW] if w in terms]
                row = np.bincount(own, index.weights[own], minlength=len(terms)) if own else np.zeros(len(terms))
                total += np.outer(row, row) / max(1e-9, (index.weights[own] ** 2).sum())
                n += 1
        return total, n

    of_docs, n = summed(t for _, t in docs)
    assert n > 100
    want = of_docs * 20 / n + summed(items)[0] * latent_leaks.ITEM_WEIGHT**2
    assert index.terms == terms and np.allclose(seen["found"], want, rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("few", [10**6, 10])
def test_every_round_learns_from_all_windows(spark, monkeypatch, few):
    """However many windows there are, each is gone through in each round."""
    monkeypatch.setattr(attention_lm, "REPEATED", few)
    seen, deal = [], attention_lm.of_round

    def dealt(windows, n_windows, number):
        part = deal(windows, n_windows, number)
        seen.append(sorted(r.h for r in part.collect()))
        return part

    monkeypatch.setattr(attention_lm, "of_round", dealt)
    draw = np.random.default_rng(3)
    ids = attention_lm.packed(draw.integers(0, 50, (120, attention_lm.WIDTH + 1)), attention_lm.END + 1).to_pylist()
    windows = spark.createDataFrame([(k << 20, bytearray(w)) for k, w in enumerate(ids)], "h BIGINT, ids BINARY").cache()
    known = attention_lm.Vocabulary(np.ones(attention_lm.END + 1), np.ones(attention_lm.END + 1, dtype=bool))
    model = attention_lm.train_in_tasks(windows, known, 120)
    each = len(seen) // attention_lm.ROUNDS
    assert each == (1 if few > 120 else attention_lm.ROUNDS)
    for k in range(attention_lm.ROUNDS):
        assert sorted(h for part in seen[k * each : (k + 1) * each] for h in part) == [h << 20 for h in range(120)]
    assert np.abs(model.embed - attention_lm.initial(known)["embed"]).max() > 0
