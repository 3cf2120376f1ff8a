"""The dealt operators as queries over the given tables, one for each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm import (
    attention_lm,
    bpe_tree,
    conversation_repair,
    digest_runs,
    embedding_polytope,
    latent_leaks,
    line_align,
    minhash_oph,
    phrase_stripes,
    pii_crf,
    rans_blocks,
    secret_parts,
    stages,
    toxic_segments,
)
from tastemill.session import shared_dir
from tastemill.staging import stage_table

Builder = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_leaks.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def held_out(every: int, rest: int) -> Column:
    """Whether a doc_id belongs to the rows that are kept for a test."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(every)) == rest, F.lit(False))


def op2_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(3, 1))
    scored = toxic_segments.score(docs, toxic_segments.fit(docs, labels), "score", "segments")
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "segments")


def op3_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_tree.encode_decode(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", held_out(10, 0).alias("held_out"))
    return attention_lm.score_texts(docs, "held_out", public_tokenizers.path(TOKENIZER))


def op5_rans_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "rans")
    rans_blocks.write_file(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), path)
    return rans_blocks.read_file(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_line_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_align.remove_repeated(documents(spark, sf_dir).select("doc_id", "text"), gone_column="lines", holders_column="holder_ids")
    deleted = F.coalesce(F.size("lines"), F.lit(0))
    return cleaned.select("doc_id", F.greatest(deleted, F.lit(0)).cast("bigint").alias("n_deleted"), F.coalesce("lines", F.array().cast("array<int>")).alias("deleted_lines"), F.coalesce("holder_ids", F.array().cast("array<bigint>")).alias("holder_ids"), "text")


def op7_embedding_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_polytope.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find_personal_data(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii_crf.KINDS)]
    base = F.sha2(pii_crf.joined_spans(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii_crf.joined_spans(F.col("spans")).alias("spans"))


def op9_secret_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_parts.find_secrets(documents(spark, sf_dir))
    kinds = list(secret_parts.PLAIN)
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint")
    counts = [count(k).alias(f"n_{k}") for k in kinds]
    base = F.filter("spans", lambda s: s.kind.isin(kinds))
    return found.select("doc_id", *counts, F.sha2(secret_parts.joined_spans(base), 256).alias("base_sha256"), secret_parts.joined_spans(F.col("spans")).alias("spans"))


def op10_minhash_oph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_oph.near_duplicates(documents(spark, sf_dir), minhash_oph.Settings(words=4))


def op11_phrase_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_stripes.top_collocations(documents(spark, sf_dir))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with the query's faults: some dropped, emptied, cut at their end, repeated, or given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rest = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.when(rest == 1, "").when(rest == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(rest == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversation_repair.turns(conversations).filter(rest != 0)
    hurt = rows.select("conv_id", "turn", F.when(rest == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies))
    return hurt.drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    hurt = damaged(conversations)
    plans = stage_table("plans", conversation_repair.plan_repairs(hurt, conversations))
    digests = conversation_repair.repaired_digests(hurt, plans).withColumnRenamed("conv_id", "of")
    return plans.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def op13_digest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_runs.exact_duplicates(documents(spark, sf_dir))


BUILDERS: dict[str, Builder] = {
    "pipeline": stages.run,
    "op1_latent_leaks": op1_latent_leaks,
    "op2_toxic_segments": op2_toxic_segments,
    "op3_bpe_tree": op3_bpe_tree,
    "op4_attention_lm": op4_attention_lm,
    "op5_rans_blocks": op5_rans_blocks,
    "op6_line_align": op6_line_align,
    "op7_embedding_polytope": op7_embedding_polytope,
    "op8_pii_crf": op8_pii_crf,
    "op9_secret_parts": op9_secret_parts,
    "op10_minhash_oph": op10_minhash_oph,
    "op11_phrase_stripes": op11_phrase_stripes,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_digest_runs": op13_digest_runs,
}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op11_phrase_stripes": f"""
        WITH texts AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLDED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
        ), pieces AS (
            SELECT row_number() OVER () AS p, lang, regexp_split_to_array(piece, '[ \\t]+') AS ws FROM texts
        ), words AS (
            SELECT p, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM pieces
        ), runs AS (
            SELECT lang, w AS w1, lead(w, 1) OVER piece AS w2, lead(w, 2) OVER piece AS w3 FROM words WHERE w <> ''
            WINDOW piece AS (PARTITION BY p ORDER BY i)
        ), grams AS (
            SELECT lang, w1 AS g, 1 AS k, NULL AS w1, NULL AS w2, NULL AS w3 FROM runs
            UNION ALL SELECT lang, w1 || ' ' || w2, 2, w1, w2, NULL FROM runs WHERE w2 IS NOT NULL
            UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, w1, w2, w3 FROM runs WHERE w3 IS NOT NULL
        ), f AS MATERIALIZED (
            SELECT lang, g, k, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, count(*) AS c FROM grams GROUP BY lang, g, k
        ), totals AS (
            SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
        ), counts AS MATERIALIZED (
            SELECT lang || ':' || g AS id, c FROM f WHERE k < 3
        ), cuts AS (
            SELECT lang, g, c AS a, 1 AS cut, w1 AS lg, w2 AS rg FROM f WHERE k = 2 AND c >= 10
            UNION ALL SELECT lang, g, c, 1, w1, w2 || ' ' || w3 FROM f WHERE k = 3 AND c >= 10
            UNION ALL SELECT lang, g, c, 2, w1 || ' ' || w2, w3 FROM f WHERE k = 3 AND c >= 10
        ), lefts AS MATERIALIZED (
            SELECT cuts.*, counts.c AS l FROM cuts JOIN counts ON id = lang || ':' || lg
        ), scored AS (
            SELECT lang, g, a, cut, l, c AS r, ((1000000::HUGEINT * a * a) // (l::HUGEINT * c))::BIGINT AS score
            FROM lefts JOIN counts ON id = lang || ':' || rg
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
        ), longer AS (
            SELECT lang, w1 || ' ' || w2 AS g, c FROM f WHERE k = 3 AND c >= 10
            UNION ALL SELECT lang, w2 || ' ' || w3, c FROM f WHERE k = 3 AND c >= 10
        ), most AS (
            SELECT lang, g, max(c) AS m FROM longer GROUP BY lang, g
        ), kept AS (
            SELECT best.*, best.g AS phrase FROM best LEFT JOIN most ON most.lang || ':' || most.g = best.lang || ':' || best.g
            WHERE m IS NULL OR 100 * m < 50 * a
        ), ranked AS (
            SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
            FROM kept JOIN totals ON totals.lang = kept.lang
        )
        SELECT * FROM ranked WHERE rank <= 2000""",
    "op13_digest_runs": f"""
        WITH folded AS (SELECT doc_id, {_FOLDED} AS t FROM documents)
        SELECT doc_id,
            max(doc_id) OVER (PARTITION BY t) AS keep_id,
            count(*) OVER (PARTITION BY t) AS group_size,
            row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
            sha256(t) AS text_sha256
        FROM folded""",
}
