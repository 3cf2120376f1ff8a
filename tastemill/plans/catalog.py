"""Every query by name: a builder ``(spark, sf_dir) -> DataFrame`` and, where the
result can be said in SQL, the statement that computes the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.operators import audit, blend, cleaning, labels, metrics, quality, sampling, setops, splitting, topk
from tastemill.operators.als import ALSConfig, fit_als, recommend_long
from tastemill.operators.als_check import fit_check
from tastemill.operators.factors import factor_topk
from tastemill.plans import experiments, prep
from tastemill.plans.experiments import Run
from tastemill.plans.prep import PrepConfig
from tastemill.schema import ITEM, RATING, REVIEWED, SPLIT, TEST, TRAIN, TRIPLE, USER, VAL
from tastemill.session import shared_dir
from tastemill.sources import scans, star, storage
from tastemill.sources.storage import ArtifactStore, materialize
from tastemill.staging import stage_table

Builder = Callable[[SparkSession, str], DataFrame]

_BUILDERS: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def add(build: Builder) -> Builder:
        _BUILDERS[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return add


def builders() -> dict[str, Builder]:
    return dict(_BUILDERS)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


# --- SQL building blocks -------------------------------------------------------------------------

FULL_PREP = PrepConfig(fraction=1.0)
#: The same with the review flag on every row.
FLAGGED = replace(FULL_PREP, carry=(REVIEWED,))


def _u(tag: str, key: str) -> str:
    """The draw of a key as a number in [0, 1)."""
    return f"CAST(('0x' || substr(md5('42:{tag}:' || {key}), 1, 8)) AS BIGINT) / 4294967296.0"


_U_DOWN, _U_USER = _u("d", "user_id"), _u("u", "user_id")
_U_ITEM = _u("i", "user_id || ':' || book_id")
_GROUP = f"CASE WHEN {_U_USER} < 0.6 THEN 'train' WHEN {_U_USER} < 0.8 THEN 'val' ELSE 'test' END"

_FLAGS = """CAST(l_quantity AS INT) % 6 AS rating,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_read,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_reviewed"""
_ONE_PER_KEY = "MAX(is_read) AS is_read, MAX(rating) AS rating, MAX(is_reviewed) AS is_reviewed"
_ACTIVE = "SELECT user_id FROM rated GROUP BY user_id HAVING COUNT(*) > 10"


def _split_ctes(source: str) -> str:
    """``tagged`` (before the observed-key rules), ``put`` (users moved) and ``final``."""
    return f"""tagged AS (
  SELECT user_id, book_id, rating,
    CASE WHEN user_group = 'train' OR NOT held THEN 'train' ELSE user_group END AS split
  FROM (SELECT *, {_GROUP} AS user_group, {_U_ITEM} < 0.5 AS held FROM {source})),
put AS (
  SELECT user_id, book_id, rating,
    CASE WHEN SUM(CASE WHEN split = 'train' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) = 0
      THEN 'train' ELSE split END AS split
  FROM tagged),
final AS (
  SELECT * FROM put
  WHERE split = 'train' OR book_id IN (SELECT book_id FROM put WHERE split = 'train'))"""


_RAW = f"""raw AS (
  SELECT o_custkey AS user_id, l_partkey AS book_id, {_FLAGS}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_INTER = f"{_RAW}, inter AS (SELECT user_id, book_id, {_ONE_PER_KEY} FROM raw GROUP BY 1, 2)"
_BASE = f"""{_INTER}, rated AS (SELECT * FROM inter WHERE rating > 0),
base AS (SELECT user_id, book_id, rating FROM rated WHERE user_id IN ({_ACTIVE}))"""
_SPLIT = f"{_BASE}, {_split_ctes('base')}"
_BASKETS = f"""inter AS (
  SELECT user_id, book_id, {_ONE_PER_KEY}
  FROM (SELECT l_orderkey AS user_id, l_partkey * 1000000 + l_suppkey AS book_id, {_FLAGS} FROM lineitem)
  GROUP BY 1, 2),
base AS (SELECT user_id, book_id, rating FROM inter WHERE rating > 0), {_split_ctes('base')}"""
_LABELS = f"{_SPLIT}, labels AS (SELECT DISTINCT user_id, book_id FROM final WHERE split = 'val' AND rating > 3)"
_BEST = "PARTITION BY user_id ORDER BY rating DESC, book_id"


def _top(source: str, k: int, partition: str = "user_id") -> str:
    return f"""SELECT * FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY {partition} ORDER BY rating DESC, book_id) AS INT) AS rank
  FROM {source}) WHERE rank <= {k}"""


# Explicit and implicit scores taken from the table itself, so that everything after the model
# has a result that SQL can check. They overlap in part: some items are rated, some only read.
_SCORES = """explicit_scores AS (SELECT user_id, book_id, rating FROM inter WHERE rating > 0),
implicit_scores AS (SELECT user_id, book_id, is_reviewed + is_read AS rating FROM inter WHERE is_reviewed + is_read > 0)"""


def _blend_ctes(k: int) -> str:
    return f"""{_SCORES}, e AS ({_top('explicit_scores', k)}), i AS ({_top('implicit_scores', k)}),
lists AS (
  SELECT user_id, book_id, CAST(rating AS DOUBLE) AS r, CAST(0 AS DOUBLE) AS v FROM e
  UNION ALL SELECT user_id, book_id, CAST(0 AS DOUBLE), CAST(rating AS DOUBLE) FROM i),
blended AS (SELECT user_id, book_id, SUM(r) AS from_ratings, SUM(v) AS from_reviews FROM lists GROUP BY user_id, book_id)"""


def _metric_ctes(preds: str, labels_: str, k: int, by: str = "", min_len: int = 1) -> str:
    """``per_user`` (ap, ndcg, precision) from ranked predictions and labels."""
    comma = f"{by}, " if by else ""
    on_by = f"AND p.{by} = l.{by} " if by else ""
    return f"""sizes AS (SELECT {comma}user_id, COUNT(*) AS n_relevant FROM {labels_} GROUP BY ALL),
lens AS (SELECT {comma}user_id, COUNT(*) AS n_pred FROM {preds} GROUP BY ALL HAVING COUNT(*) >= {min_len}),
hits AS (
  SELECT {f'p.{by}, ' if by else ''}p.user_id, p.rank,
    ROW_NUMBER() OVER (PARTITION BY {f'p.{by}, ' if by else ''}p.user_id ORDER BY p.rank) AS hit_no
  FROM {preds} p JOIN {labels_} l ON p.user_id = l.user_id AND p.book_id = l.book_id {on_by}),
ideal AS (
  SELECT n, SUM(1 / ln(n + 1)) OVER (ORDER BY n) AS dcg FROM range(1, {k} + 1) t(n)),
per_user AS (
  SELECT {f'lens.{by}, ' if by else ''}lens.user_id, lens.n_pred, sizes.n_relevant,
    COUNT(rank) AS n_hits,
    COALESCE(SUM(hit_no / CAST(rank AS DOUBLE)), 0) / ANY_VALUE(n_relevant) AS ap,
    COALESCE(SUM(CASE WHEN rank <= {k} THEN 1 / ln(rank + 1) END), 0) / ANY_VALUE(ideal.dcg) AS ndcg,
    COUNT(CASE WHEN rank <= {k} THEN 1 END) / CAST({k} AS DOUBLE) AS precision
  FROM lens JOIN sizes USING ({comma}user_id)
  JOIN ideal ON ideal.n = LEAST(sizes.n_relevant, {k})
  LEFT JOIN hits USING ({comma}user_id)
  GROUP BY ALL)"""


def _joined(order: str) -> str:
    return f"string_agg(CAST(book_id AS VARCHAR), ',' ORDER BY {order})"


def _text(column: str):
    """An id array as text, so that engines need not agree on how arrays are compared."""
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A derived view as a stored table, for jobs that read it more than once."""
    return stage_table(name, df)


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(star.interactions(spark, sf), "interactions")


# --- A: sources and sinks -------------------------------------------------------------------------


def _written_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = f"{shared_dir(spark, name)}"
    df.write.csv(path, header=True)
    return path


@register(
    "scan_interactions_csv",
    f"""WITH {_INTER} SELECT CAST(user_id AS INT) AS user_id, CAST(book_id AS INT) AS book_id,
    is_read, rating, is_reviewed FROM inter""",
)
def _(spark, sf):
    path = _written_csv(spark, star.interactions(spark, sf), "interactions-csv")
    return scans.read_csv(spark, "interactions", path)


@register(
    "scan_user_map_csv", "SELECT CAST(c_custkey AS INT) AS user_id_csv, c_name AS user_id FROM customer"
)
def _(spark, sf):
    return scans.read_csv(spark, "users", _written_csv(spark, star.user_map(spark, sf), "users-csv"))


@register("scan_book_map_csv", "SELECT CAST(p_partkey AS INT) AS book_id_csv, p_name AS book_id FROM part")
def _(spark, sf):
    return scans.read_csv(spark, "books", _written_csv(spark, star.book_map(spark, sf), "books-csv"))


@register("scan_parquet", "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    fact = scans.read_parquet(spark, f"{sf}/lineitem.parquet")
    return fact.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")


@register("materialize_sorted", f"WITH {_INTER} SELECT * FROM inter")
def _(spark, sf):
    path = shared_dir(spark, "interactions")
    materialize(star.interactions(spark, sf), spark, path)
    # The second call finds the finished table and only reads.
    return materialize(star.interactions(spark, sf), spark, path)


@register(
    "sql_over_view",
    f"WITH {_INTER} SELECT rating, COUNT(*) AS n_rows, CAST(SUM(is_reviewed) AS BIGINT) AS n_reviewed FROM inter GROUP BY rating",
)
def _(spark, sf):
    return scans.view_sql(
        star.interactions(spark, sf),
        "tastemill_interactions",
        "SELECT rating, COUNT(*) AS n_rows, SUM(is_reviewed) AS n_reviewed FROM tastemill_interactions GROUP BY rating",
    )


def _fraction_counts_sql(fraction: float) -> str:
    return f"""SELECT * FROM (WITH {_BASE.replace('WHERE rating > 0)', f'WHERE rating > 0 AND {_U_DOWN} < {fraction})')},
{_split_ctes('base')}
SELECT CAST({fraction} AS DOUBLE) AS fraction, split, COUNT(*) AS n_rows,
  COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT book_id) AS n_items FROM final GROUP BY split)"""


@register("save_splits_summary", " UNION ALL ".join(map(_fraction_counts_sql, prep.SAVED_FRACTIONS)))
def _(spark, sf):
    root = shared_dir(spark, "splits")
    facts = materialize(star.interactions(spark, sf), spark, f"{root}/interactions")
    return prep.save_splits(facts, ArtifactStore(spark, root, sf))


# --- B: projections and filters -------------------------------------------------------------------


@register("project_triples", f"WITH {_INTER} SELECT user_id, book_id, rating FROM inter")
def _(spark, sf):
    return cleaning.project_triples(star.interactions(spark, sf))


@register("drop_flags", f"WITH {_RAW} SELECT user_id, book_id, rating FROM raw")
def _(spark, sf):
    return cleaning.drop_flags(star.raw_interactions(spark, sf))


@register("remove_zeros", f"WITH {_INTER} SELECT * FROM inter WHERE rating > 0")
def _(spark, sf):
    return cleaning.remove_zeros(star.interactions(spark, sf))


@register("relevant_items", f"WITH {_INTER} SELECT * FROM inter WHERE rating > 3")
def _(spark, sf):
    return cleaning.relevant_items(star.interactions(spark, sf))


# --- C, D: joins on key lists, aggregations --------------------------------------------------------


@register("distinct_users", f"WITH {_RAW} SELECT DISTINCT user_id FROM raw")
def _(spark, sf):
    return cleaning.distinct_users(star.raw_interactions(spark, sf))


@register("distinct_items", f"WITH {_RAW} SELECT DISTINCT book_id FROM raw")
def _(spark, sf):
    return cleaning.distinct_items(star.raw_interactions(spark, sf))


@register(
    "active_users",
    f"WITH {_BASE} SELECT user_id, COUNT(*) AS n_rows FROM rated GROUP BY user_id HAVING COUNT(*) > 10",
)
def _(spark, sf):
    return cleaning.active_users(cleaning.remove_zeros(star.interactions(spark, sf)))


@register("remove_low_users", f"WITH {_BASE} SELECT * FROM rated WHERE user_id IN ({_ACTIVE})")
def _(spark, sf):
    return cleaning.remove_low_users(cleaning.remove_zeros(star.interactions(spark, sf)))


@register(
    "duplicate_pairs",
    f'WITH {_RAW} SELECT user_id, book_id, COUNT(*) AS "count" FROM raw GROUP BY 1, 2 HAVING COUNT(*) > 1',
)
def _(spark, sf):
    return audit.duplicate_pairs(star.raw_interactions(spark, sf))


@register("downsample_users", f"WITH {_INTER} SELECT * FROM inter WHERE {_U_DOWN} < 0.25")
def _(spark, sf):
    return sampling.downsample(star.interactions(spark, sf), 0.25)


@register("split_user_groups", f"WITH {_INTER} SELECT user_id, book_id, {_GROUP} AS user_group FROM inter")
def _(spark, sf):
    return sampling.split_user_groups(star.interactions(spark, sf)).select(USER, ITEM, sampling.GROUP)


@register(
    "observed_users",
    f"WITH {_BASKETS} SELECT * FROM tagged WHERE user_id IN (SELECT user_id FROM tagged WHERE split = 'train')",
)
def _(spark, sf):
    return splitting.drop_unobserved_users(_tagged_baskets(spark, sf))


@register(
    "observed_items",
    f"WITH {_BASKETS} SELECT * FROM tagged WHERE book_id IN (SELECT book_id FROM tagged WHERE split = 'train')",
)
def _(spark, sf):
    return splitting.drop_unobserved_items(_tagged_baskets(spark, sf))


@register(
    "attach_review_flag",
    f"""WITH {_SPLIT} SELECT final.user_id, final.book_id, final.rating, split, inter.is_reviewed
    FROM final JOIN inter ON final.user_id = inter.user_id AND final.book_id = inter.book_id""",
)
def _(spark, sf):
    # The flag goes with the rows from the start, so that nothing is joined with the full table.
    return prep.prep_splits(_facts(spark, sf), FLAGGED)


@register(
    "join_review_flag",
    f"""WITH {_SPLIT} SELECT final.user_id, final.book_id, final.rating, split, inter.is_reviewed
    FROM final JOIN inter ON final.user_id = inter.user_id AND final.book_id = inter.book_id""",
)
def _(spark, sf):
    """The same for splits that were made without the flag."""
    return blend.attach_review_flag(_split(spark, sf), star.raw_interactions(spark, sf))


# --- E, F: top-k and set operations ---------------------------------------------------------------


def _explicit_scores(facts: DataFrame) -> DataFrame:
    return cleaning.remove_zeros(facts).select(*TRIPLE)


def _implicit_scores(facts: DataFrame) -> DataFrame:
    signal = F.col("is_reviewed") + F.col("is_read")
    return facts.select(USER, ITEM, signal.alias(RATING)).filter(F.col(RATING) > 0)


@register(
    "topk_list",
    f"WITH {_INTER}, {_SCORES}, t AS ({_top('explicit_scores', 20)}) SELECT user_id, {_joined('rank')} AS book_id FROM t GROUP BY user_id",
)
def _(spark, sf):
    return topk.topk_list(_explicit_scores(star.interactions(spark, sf)), 20).select(USER, _text(ITEM))


@register(
    "full_length_lists",
    f"""WITH {_INTER}, {_SCORES}, t AS ({_top('explicit_scores', 35)})
    SELECT user_id, {_joined('rank')} AS book_id FROM t GROUP BY user_id HAVING COUNT(*) = 35""",
)
def _(spark, sf):
    lists = topk.topk_list(_explicit_scores(star.interactions(spark, sf)), 35)
    return topk.full_length(lists, 35).select(USER, _text(ITEM))


@register(
    "running_list",
    f"""WITH {_INTER}, s AS (SELECT user_id, book_id, rating * 100000 + book_id AS score FROM inter),
    l AS (SELECT user_id, list(book_id) OVER (PARTITION BY user_id ORDER BY score DESC) AS items FROM s)
    SELECT user_id, array_to_string(items, ',') AS book_id FROM l WHERE len(items) = 5""",
)
def _(spark, sf):
    score = F.col(RATING) * 100000 + F.col(ITEM)
    scores = star.interactions(spark, sf).select(USER, ITEM, score.alias(RATING))
    return topk.running_list(scores, 5).select(USER, _text(ITEM))


@register(
    "running_list_ties",
    f"""WITH {_INTER}, {_SCORES},
    l AS (SELECT user_id, list(book_id) OVER (PARTITION BY user_id ORDER BY rating DESC) AS items FROM implicit_scores)
    SELECT user_id, array_to_string(list_sort(items), ',') AS book_id FROM l WHERE len(items) = 20""",
)
def _(spark, sf):
    lists = topk.running_list(_implicit_scores(star.interactions(spark, sf)), 20)
    return lists.withColumn(ITEM, F.array_sort(ITEM)).select(USER, _text(ITEM))


_VECTORS = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
_FACTOR_TOP = f"""WITH v AS ({_VECTORS}), s AS (
  SELECT u.vec_id AS user_id, i.vec_id AS book_id, round(list_dot_product(u.v, i.v), 9) AS rating
  FROM v u CROSS JOIN v i), t AS ({_top('s', 20)})"""


def _vectors(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )


def _factor_top(spark, sf):
    vectors = _vectors(spark, sf)
    return factor_topk(vectors, vectors, 20)


@register("factor_topk", f"{_FACTOR_TOP} SELECT user_id, book_id, rank, rating FROM t")
def _(spark, sf):
    return _factor_top(spark, sf).select(USER, ITEM, "rank", RATING)


WIDE_K = 500


@register(
    "factor_topk_wide",
    f"""WITH v AS (
      SELECT vec_id, list_concat(embedding, embedding[1:36])::DOUBLE[] AS u, CAST(1 AS DOUBLE) / (1 + vec_id % 50) AS scale FROM embeddings),
    s AS (
      SELECT a.vec_id AS user_id, b.vec_id AS book_id, round(list_dot_product(a.u, list_transform(b.u, lambda x: x * b.scale)), 9) AS rating
      FROM v a CROSS JOIN v b), t AS ({_top('s', WIDE_K)}) SELECT user_id, book_id, rank, rating FROM t""",
)
def _(spark, sf):
    """Rank 100, 500 items a user, item norms that fall as those of fitted items do."""
    whole = F.concat(F.col("embedding"), F.slice("embedding", 1, 36)).cast("array<double>")
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), whole.alias("features"))
    scale = F.lit(1.0) / (1 + F.col("id") % 50)
    items = vectors.select("id", F.transform("features", lambda x: x * scale).alias("features"))
    return factor_topk(vectors, items, WIDE_K).select(USER, ITEM, "rank", RATING)


@register("pred_labels", f"{_FACTOR_TOP} SELECT user_id, {_joined('rank')} AS book_id FROM t GROUP BY user_id")
def _(spark, sf):
    return topk.pred_labels(topk.as_recommendations(_factor_top(spark, sf))).select(USER, _text(ITEM))


@register("recs_long", f"{_FACTOR_TOP} SELECT user_id, book_id, rank FROM t")
def _(spark, sf):
    return topk.recs_long(topk.as_recommendations(_factor_top(spark, sf))).select(USER, ITEM, "rank")


_RAW_TRIPLES = f"{_RAW}, triples AS (SELECT user_id, book_id, rating FROM raw), liked AS (SELECT * FROM triples WHERE rating > 3)"


def _raw_and_liked(spark, sf):
    triples = cleaning.project_triples(star.raw_interactions(spark, sf))
    return triples, cleaning.relevant_items(triples)


@register("except_distinct", f"WITH {_RAW_TRIPLES} SELECT * FROM triples EXCEPT SELECT * FROM liked")
def _(spark, sf):
    return setops.except_distinct(*_raw_and_liked(spark, sf))


@register("except_all", f"WITH {_RAW_TRIPLES} SELECT * FROM triples EXCEPT ALL SELECT * FROM liked")
def _(spark, sf):
    return setops.except_all(*_raw_and_liked(spark, sf))


@register(
    "union_all",
    f"WITH {_INTER} SELECT user_id, book_id, rating FROM raw UNION ALL SELECT user_id, book_id, rating FROM inter",
)
def _(spark, sf):
    raw = star.raw_interactions(spark, sf)
    return setops.union_all(*map(cleaning.project_triples, (raw, star.one_per_key(raw))))


# --- G: sampling and splitting --------------------------------------------------------------------


def _basket_rows(spark, sf):
    return cleaning.remove_zeros(cleaning.project_triples(_stored(star.baskets(spark, sf), "baskets")))


def _tagged_baskets(spark, sf):
    return sampling.tag_splits(_basket_rows(spark, sf))


def _clean(spark, sf):
    facts = _facts(spark, sf)
    return cleaning.project_triples(cleaning.remove_low_users(cleaning.remove_zeros(facts)))


def _split(spark, sf):
    return prep.prep_splits(_facts(spark, sf), FULL_PREP)


@register("holdout_half", f"WITH {_SPLIT} SELECT * FROM tagged WHERE split <> 'train'")
def _(spark, sf):
    return sampling.tag_splits(_clean(spark, sf)).filter(F.col(SPLIT) != TRAIN)


@register(
    "holdout_complement",
    f"WITH {_SPLIT} SELECT * FROM tagged WHERE split = 'train' AND {_U_USER} >= 0.6",
)
def _(spark, sf):
    grouped = sampling.split_user_groups(sampling.tag_splits(_clean(spark, sf)))
    given_back = (F.col(SPLIT) == TRAIN) & (F.col(sampling.GROUP) != TRAIN)
    return grouped.filter(given_back).drop(sampling.GROUP)


@register("putback_users", f"WITH {_BASKETS} SELECT * FROM put")
def _(spark, sf):
    return splitting.put_back_users(_tagged_baskets(spark, sf))


@register("drop_unobserved_items", f"WITH {_BASKETS} SELECT * FROM final")
def _(spark, sf):
    return splitting.drop_unobserved_items(splitting.put_back_users(_tagged_baskets(spark, sf)))


@register("train_val_test_split", f"WITH {_SPLIT} SELECT * FROM final")
def _(spark, sf):
    return splitting.train_val_test_split(_clean(spark, sf))


@register("prep_splits", f"WITH {_SPLIT} SELECT * FROM final")
def _(spark, sf):
    facts = _facts(spark, sf)
    return prep.load_splits(facts, FULL_PREP, ArtifactStore(spark, shared_dir(spark, "prep"), sf))


@register("final_fit_frame", f"WITH {_SPLIT} SELECT user_id, book_id, rating FROM final WHERE split IN ('train', 'val')")
def _(spark, sf):
    return splitting.final_fit_frame(_split(spark, sf))


# --- K, D5, D6: audits ----------------------------------------------------------------------------


@register(
    "split_counts",
    f"""WITH {_SPLIT} SELECT split, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_users,
    COUNT(DISTINCT book_id) AS n_items FROM final GROUP BY split""",
)
def _(spark, sf):
    return audit.split_counts(_split(spark, sf), dense_ids=True)


@register(
    "split_ratios",
    f"""WITH {_SPLIT}, total AS (SELECT COUNT(*) AS n, COUNT(DISTINCT user_id) AS users FROM final)
    SELECT split, round(COUNT(*) / CAST(ANY_VALUE(total.n) AS DOUBLE), 9) AS row_share,
      round(COUNT(DISTINCT user_id) / CAST(ANY_VALUE(total.users) AS DOUBLE), 9) AS user_share
    FROM final CROSS JOIN total GROUP BY split""",
)
def _(spark, sf):
    ratios = audit.split_ratios(_split(spark, sf))
    return ratios.select(SPLIT, *[F.round(c, 9).alias(c) for c in ("row_share", "user_share")])


_AUDIT_SQL = f"""WITH {_BASKETS},
k AS (
  SELECT user_id, book_id, SUM(d) AS d, SUM(t) AS t, SUM(h) AS h, COUNT(DISTINCT split) AS s FROM (
    SELECT user_id, book_id, 1 AS d, 0 AS t, 0 AS h, NULL AS split FROM base UNION ALL
    SELECT user_id, book_id, 0, CASE WHEN split = 'train' THEN 1 ELSE 0 END,
      CASE WHEN split = 'train' THEN 0 ELSE 1 END, split FROM final) GROUP BY 1, 2),
u AS (
  SELECT user_id, COUNT(*) AS n, COUNT(DISTINCT split) AS s, SUM(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS t
  FROM final GROUP BY user_id),
i AS (SELECT book_id, SUM(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS t FROM final GROUP BY book_id)
SELECT "check", CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual FROM (
  SELECT 'rows lost outside held-out sets' AS "check", 0 AS expected,
    (SELECT SUM(CASE WHEN t > 0 THEN d - t - h ELSE 0 END) FROM k) AS actual
  UNION ALL SELECT 'rows in no input', 0, (SELECT SUM(GREATEST(t + h - d, 0)) FROM k)
  UNION ALL SELECT 'keys in two splits', 0, (SELECT COUNT(*) FROM k WHERE s > 1)
  UNION ALL SELECT 'users in train', (SELECT COUNT(DISTINCT user_id) FROM base), (SELECT COUNT(*) FROM u WHERE t > 0)
  UNION ALL SELECT 'held-out users not in train', 0, (SELECT COUNT(*) FROM u WHERE t = 0)
  UNION ALL SELECT 'users in both held-out sets', 0, (SELECT COUNT(*) FROM u WHERE s > 2)
  UNION ALL SELECT 'held-out items not in train', 0, (SELECT COUNT(*) FROM i WHERE t = 0)
  UNION ALL SELECT 'rows of unobserved items',
    (SELECT COUNT(*) FROM base WHERE book_id NOT IN (SELECT book_id FROM final WHERE split = 'train')),
    (SELECT COUNT(*) FROM base) - (SELECT COUNT(*) FROM final))"""


@register("split_audit", _AUDIT_SQL)
def _(spark, sf):
    down = _basket_rows(spark, sf)
    return audit.split_audit(down, splitting.train_val_test_split(down))


@register(
    "conservation",
    f"""WITH {_BASKETS}
    SELECT 'down - recombined' AS difference, COUNT(*) AS n_rows
    FROM (SELECT * FROM base EXCEPT SELECT user_id, book_id, rating FROM final)
    UNION ALL SELECT 'recombined - down', COUNT(*)
    FROM (SELECT user_id, book_id, rating FROM final EXCEPT SELECT * FROM base)""",
)
def _(spark, sf):
    down = _basket_rows(spark, sf)
    return quality.conservation(down, splitting.pick(splitting.train_val_test_split(down), TRAIN, VAL, TEST))


def _n_duplicates(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS frame, COUNT(*) AS n_keys
    FROM (SELECT user_id, book_id FROM {source} GROUP BY 1, 2 HAVING COUNT(*) > 1)"""


@register(
    "duplicate_audit",
    f"""WITH {_RAW}, base AS (SELECT * FROM raw WHERE {_U_DOWN} < 0.25), {_split_ctes('base')}
    {_n_duplicates('full', 'raw')} UNION ALL {_n_duplicates('down', 'base')} UNION ALL {_n_duplicates('recombined', 'final')}""",
)
def _(spark, sf):
    full = _stored(star.raw_interactions(spark, sf), "raw")
    down = sampling.downsample(full, 0.25)
    return quality.duplicate_audit(full=full, down=down, recombined=splitting.train_val_test_split(down))


_SAMPLE = 0.25
_FRAMES = {"full": "inter", "down": "base", **{s: f"(SELECT * FROM final WHERE split = '{s}')" for s in (TRAIN, VAL, TEST)}, "recombined": "final"}


def _line(check: str, actual: str, expected: str) -> str:
    return f"SELECT '{check}' AS \"check\", CAST({actual} AS DOUBLE) AS actual, CAST({expected} AS DOUBLE) AS expected"


def _users(frame: str) -> str:
    return f"(SELECT COUNT(DISTINCT user_id) FROM {_FRAMES[frame]})"


def _duplicated(frame: str) -> str:
    return f"(SELECT COUNT(*) FROM (SELECT user_id, book_id FROM {_FRAMES[frame]} GROUP BY 1, 2 HAVING COUNT(*) > 1))"


def _quality_sql() -> str:
    lines = []
    for name, source in _FRAMES.items():
        lines.append(_line(f"{name}: users", _users(name), "NULL"))
        lines.append(_line(f"{name}: items", f"(SELECT COUNT(DISTINCT book_id) FROM {source})", "NULL"))
        lines.append(_line(f"{name}: rows", f"(SELECT COUNT(*) FROM {source})", "NULL"))
    share = lambda a, b: f"round(CAST({_users(a)} AS DOUBLE) / {_users(b)}, 9)"
    lines += [
        _line("sampled users of all users", share("down", "full"), str(_SAMPLE)),
        _line("train users of sampled users", share("train", "down"), "1"),
        _line("val users of sampled users", share("val", "down"), "0.2"),
        _line("test users of sampled users", share("test", "down"), "0.2"),
        _line("split rows of sampled rows", "round((SELECT COUNT(*) FROM final) / CAST((SELECT COUNT(*) FROM base) AS DOUBLE), 9)", "1"),
        _line(
            "sampled triples not in the splits",
            "(SELECT COUNT(*) FROM (SELECT * FROM base EXCEPT SELECT user_id, book_id, rating FROM final))",
            "(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM base WHERE book_id NOT IN (SELECT book_id FROM final WHERE split = 'train')))",
        ),
        _line("split triples not in the sample", "(SELECT COUNT(*) FROM (SELECT user_id, book_id, rating FROM final EXCEPT SELECT * FROM base))", "0"),
        _line("full: duplicated keys", _duplicated("full"), "0"),
        _line("down: duplicated keys", _duplicated("down"), "0"),
        _line("recombined: duplicated keys", _duplicated("recombined"), _duplicated("down")),
    ]
    baskets = _BASKETS.replace("WHERE rating > 0)", f"WHERE rating > 0 AND {_U_DOWN} < {_SAMPLE})")
    return f"WITH {baskets} " + " UNION ALL ".join(lines)


@register("quality_report", _quality_sql())
def _(spark, sf):
    full = _stored(star.baskets(spark, sf), "baskets")
    down = cleaning.remove_zeros(cleaning.project_triples(sampling.downsample(full, _SAMPLE)))
    report = quality.quality_report(full, splitting.train_val_test_split(down), _SAMPLE, sampled=F.col(RATING) > 0)
    return report.select("check", F.round("actual", 9).alias("actual"), F.round("expected", 9).alias("expected"))


# --- H6, I: labels and metrics --------------------------------------------------------------------

K = 20
_PREDS = f"{_LABELS}, explicit_scores AS (SELECT user_id, book_id, rating FROM inter), preds AS ({_top('explicit_scores', K)})"


def _labels_of(facts: DataFrame) -> DataFrame:
    return labels.true_labels(splitting.pick(prep.prep_splits(facts, FULL_PREP), VAL))


def _val_labels(spark, sf):
    return _labels_of(_facts(spark, sf))


def _preds_and_labels(spark, sf):
    facts = _facts(spark, sf)
    return topk.top_k(cleaning.project_triples(facts), K), _labels_of(facts)


@register(
    "true_labels",
    f"WITH {_LABELS} SELECT user_id, CAST(0 AS INT) AS part, {_joined('book_id')} AS true_item FROM labels GROUP BY user_id",
)
def _(spark, sf):
    return labels.true_label_lists(_val_labels(spark, sf)).select(USER, "part", _text("true_item"))


@register("true_label_pairs", f"WITH {_LABELS} SELECT user_id, book_id FROM labels")
def _(spark, sf):
    return _val_labels(spark, sf)


@register(
    "pred_true_pairs",
    f"""WITH {_PREDS}, {_metric_ctes('preds', 'labels', K)}
    SELECT user_id, n_pred, n_relevant, n_hits FROM per_user""",
)
def _(spark, sf):
    pairs = metrics.pred_true_pairs(*_preds_and_labels(spark, sf))
    return pairs.select(USER, "n_pred", "n_relevant", F.size("hits").cast("bigint").alias("n_hits"))


def _metric_query(name: str, column: str) -> None:
    @register(
        name,
        f"""WITH {_PREDS}, {_metric_ctes('preds', 'labels', K)}
        SELECT user_id, round({column}, 9) AS {column} FROM per_user""",
    )
    def _(spark, sf):
        pairs = metrics.pred_true_pairs(*_preds_and_labels(spark, sf))
        return metrics.user_metrics(pairs, K).select(USER, F.round(column, 9).alias(column))


_metric_query("map_metric", "ap")
_metric_query("ndcg_at_k", "ndcg")
_metric_query("precision_at_k", "precision")

_MEANS = ", ".join(
    f"round(AVG({source}), 9) AS {name}" for source, name in (("ap", "map"), ("ndcg", "ndcg"), ("precision", "precision"))
)


def _rounded(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "users", *[F.round(c, 9).alias(c) for c in ("map", "ndcg", "precision")])


@register(
    "ranking_metrics",
    f"WITH {_PREDS}, {_metric_ctes('preds', 'labels', K)} SELECT COUNT(*) AS users, {_MEANS} FROM per_user",
)
def _(spark, sf):
    return _rounded(metrics.evaluate(*_preds_and_labels(spark, sf), K))


# --- J: blending ----------------------------------------------------------------------------------

_WEIGHTED = "CAST({w} AS DOUBLE) * from_reviews + from_ratings AS rating"


def _score_lists(facts: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    return topk.top_k(_explicit_scores(facts), k), topk.top_k(_implicit_scores(facts), k)


@register("blend_scores", f"WITH {_INTER}, {_blend_ctes(10)} SELECT * FROM blended")
def _(spark, sf):
    return blend.blend_scores(*_score_lists(_facts(spark, sf), 10))


@register(
    "hybrid_topk",
    f"""WITH {_INTER}, {_blend_ctes(10)},
    scored AS (SELECT user_id, book_id, {_WEIGHTED.format(w=0.5)} FROM blended) {_top('scored', 10)}""",
)
def _(spark, sf):
    return blend.hybrid_top_k(*_score_lists(_facts(spark, sf), 10), 10, 0.5)


@register(
    "hybrid_lists",
    f"""WITH {_INTER}, {_blend_ctes(30)},
    scored AS (SELECT user_id, book_id, {_WEIGHTED.format(w=-1)} FROM blended), t AS ({_top('scored', 30)})
    SELECT user_id, {_joined('rank')} AS book_id FROM t GROUP BY user_id HAVING COUNT(*) = 30""",
)
def _(spark, sf):
    return blend.hybrid_lists(*_score_lists(_facts(spark, sf), 30), 30, -1).select(USER, _text(ITEM))


_SWEEP_WEIGHTS = ", ".join(f"({w})" for w in blend.DEFAULT_WEIGHTS)


@register(
    "weight_sweep",
    f"""WITH {_LABELS}, {_blend_ctes(K)},
    weights AS (SELECT CAST(w AS DOUBLE) AS weight FROM (VALUES {_SWEEP_WEIGHTS}) t(w)),
    scored AS (SELECT weight, user_id, book_id, weight * from_reviews + from_ratings AS rating FROM blended CROSS JOIN weights),
    preds AS ({_top('scored', K, 'weight, user_id')}),
    weighted_labels AS (SELECT weight, user_id, book_id FROM labels CROSS JOIN weights),
    {_metric_ctes('preds', 'weighted_labels', K, by='weight', min_len=K)}
    SELECT weight, COUNT(*) AS users, {_MEANS} FROM per_user GROUP BY weight""",
)
def _(spark, sf):
    facts = _facts(spark, sf)
    swept = blend.weight_sweep(*_score_lists(facts, K), _labels_of(facts), K)
    return _rounded(swept, blend.WEIGHT)


# --- H, J: models ---------------------------------------------------------------------------------
# A fitted model has no SQL equivalent. The audits next to the raw results say what must hold for
# any fit, which SQL can compute from the tables.

QUICK = ALSConfig(rank=10, reg=0.01)


def _ratings(spark, sf):
    """The split as a stored table, so that a fit does not recompute the derived view, which is read once for it."""
    facts = star.interactions(spark, sf)
    return facts, _stored(prep.prep_splits(facts, FLAGGED), "splits")


def _als(spark, sf, implicit: bool):
    _, tagged = _ratings(spark, sf)
    train = splitting.pick(tagged, TRAIN)
    config = ALSConfig(QUICK.rank, QUICK.reg, implicit)
    return fit_als(train, config), train, splitting.pick(tagged, VAL)


def _lists_audit(ranked: DataFrame, train: DataFrame) -> DataFrame:
    """Of each user's list: items, those not in train, and whether ranks and scores run as they should."""
    known = train.select(ITEM).distinct().withColumn("known", F.lit(1))
    places = F.array_sort(F.collect_list(F.struct("rank", (-F.col(RATING)).alias("r"), F.col("known"))))
    lists = ranked.join(known, ITEM, "left").groupBy(USER).agg(places.alias("l"), F.countDistinct(ITEM).alias("n_items"))
    in_order = F.transform("l", lambda p: p["r"]) == F.array_sort(F.transform("l", lambda p: p["r"]))
    ranks = F.transform("l", lambda p: p["rank"]) == F.sequence(F.lit(1), F.size("l"))
    unknown = F.size(F.filter("l", lambda p: p["known"].isNull())).cast("bigint")
    return lists.select(USER, "n_items", unknown.alias("n_unknown"), (in_order & ranks).alias("sound"))


_LISTS = f"""WITH {_SPLIT} SELECT DISTINCT CAST(user_id AS INT) AS user_id,
  LEAST({K}, (SELECT COUNT(DISTINCT book_id) FROM final WHERE split = 'train')) AS n_items, CAST(0 AS BIGINT) AS n_unknown, TRUE AS sound
FROM final WHERE split = 'val'"""


def _recs_audit(ranked: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """Sizes and broken rules of a set of ranked recommendations, which are searched for once."""
    ranked = _stored(ranked, "ranked")
    per_user = ranked.groupBy(USER).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(ITEM).alias("items"),
        F.array_sort(F.collect_list(F.struct("rank", F.col(RATING).alias("r")))).alias("l"),
    )
    falling = F.forall(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.col("l")[i - 1]["r"] >= F.col("l")[i]["r"])
    sound = (F.col("n") == F.col("items")) & (F.col("l")[F.size("l") - 1]["rank"] == F.col("n"))
    unknown = ranked.join(train.select(ITEM).distinct(), ITEM, "left_anti")
    rows = per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("n").alias("n_rows"),
        F.count_if(~sound).alias("bad_lists"),
        F.count_if((F.size("l") > 1) & ~falling).alias("rising_scores"),
    )
    return rows.withColumn("unknown_items", F.lit(unknown.count()).cast("bigint"))


_AUDITED = f"""WITH {_SPLIT} SELECT COUNT(DISTINCT user_id) AS users,
  COUNT(DISTINCT user_id) * LEAST({K}, (SELECT COUNT(DISTINCT book_id) FROM final WHERE split = 'train')) AS n_rows,
  CAST(0 AS BIGINT) AS bad_lists, CAST(0 AS BIGINT) AS rising_scores, CAST(0 AS BIGINT) AS unknown_items
FROM final WHERE split = 'val'"""


def _als_queries(kind: str, implicit: bool) -> None:
    @register(f"als_{kind}_recs", _LISTS)
    def _(spark, sf):
        model, train, val = _als(spark, sf, implicit)
        return _lists_audit(recommend_long(model, val, K), train)

    @register(
        f"als_{kind}_residual",
        f"WITH {_SPLIT} SELECT COUNT(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS above FROM final WHERE split = 'train'",
    )
    def _(spark, sf):
        model, train, _ = _als(spark, sf, implicit)
        return fit_check(model, train, ALSConfig(QUICK.rank, QUICK.reg, implicit))

    @register(f"als_{kind}_audit", _AUDITED)
    def _(spark, sf):
        model, train, val = _als(spark, sf, implicit)
        return _recs_audit(recommend_long(model, val, K), train, K)


_als_queries("explicit", False)
_als_queries("implicit", True)


def _changed(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many (user, rank) places differ between two sets of recommendations."""
    places = left.select(USER, "rank", F.col(ITEM).alias("a")).join(
        right.select(USER, "rank", F.col(ITEM).alias("b")), [USER, "rank"], "full_outer"
    )
    return places.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("changed"))


@register(
    "model_roundtrip",
    f"""WITH {_SPLIT} SELECT COUNT(DISTINCT user_id) * LEAST({K}, (SELECT COUNT(DISTINCT book_id) FROM final WHERE split = 'train'))
    AS n_rows, CAST(0 AS BIGINT) AS changed FROM final WHERE split = 'val'""",
)
def _(spark, sf):
    model, _, val = _als(spark, sf, False)
    store = ArtifactStore(spark, shared_dir(spark, "models"), sf)
    loaded = store.model(lambda: model, kind="explicit")
    return _changed(recommend_long(model, val, K), recommend_long(loaded, val, K))


@register(
    "recs_roundtrip",
    f"""WITH {_SPLIT} SELECT COUNT(DISTINCT user_id) * LEAST({K}, (SELECT COUNT(DISTINCT book_id) FROM final WHERE split = 'train'))
    AS n_rows, CAST(0 AS BIGINT) AS changed FROM final WHERE split = 'val'""",
)
def _(spark, sf):
    _, tagged = _ratings(spark, sf)
    train, users = splitting.pick(tagged, TRAIN), splitting.pick(tagged, VAL).select(USER).distinct()
    run = Run(k=K, store=ArtifactStore(spark, shared_dir(spark, "recs"), sf))
    first = experiments.get_recs(train, users, QUICK, run)
    return _changed(first, experiments.get_recs(train, users, QUICK, run))


_SETTINGS = ("fraction", "split", "k", "rank", "lambda", "weight", "users", "off_by")


def _checked(results: DataFrame) -> DataFrame:
    """What is certain of results: settings, users, and that MLlib finds the same metrics."""
    return results.select(*_SETTINGS[:-1], F.round("off_by", 6).alias("off_by"))


def _results_sql(rows: list[tuple[str, int, float, float]]) -> str:
    """Rows of (split, rank, reg, weight); users are those of the split with relevant items."""
    users = "(SELECT COUNT(DISTINCT user_id) FROM final WHERE final.split = r.split AND rating > 3)"
    values = ", ".join(f"('{split}', {rank}, {reg}, {weight})" for split, rank, reg, weight in rows)
    return f"""WITH {_SPLIT} SELECT CAST(1 AS DOUBLE) AS fraction, r.split, CAST({K} AS INT) AS k, CAST(rank AS INT) AS rank,
    CAST("lambda" AS DOUBLE) AS "lambda", CAST(weight AS DOUBLE) AS weight, {users} AS users, CAST(0 AS DOUBLE) AS off_by
    FROM (VALUES {values}) r(split, rank, "lambda", weight)"""


CHECKED = Run(k=K, cross_check=True)
_QUICK_ROW = _results_sql([(VAL, QUICK.rank, QUICK.reg, 0)])


@register("train_eval", _QUICK_ROW)
def _(spark, sf):
    _, tagged = _ratings(spark, sf)
    return _checked(experiments.train_eval(splitting.pick(tagged, TRAIN), splitting.pick(tagged, VAL), QUICK, CHECKED))


@register("experiment_results", _QUICK_ROW)
def _(spark, sf):
    _, tagged = _ratings(spark, sf)
    path = shared_dir(spark, "results")
    run = replace(CHECKED, results_path=path, store=ArtifactStore(spark, shared_dir(spark, "results-store"), sf))
    # The same run twice is one row; the second takes the stored recommendations and is evaluated again.
    for _ in range(2):
        experiments.train_eval(splitting.pick(tagged, TRAIN), splitting.pick(tagged, VAL), QUICK, run)
    return _checked(storage.read_results(spark, path))


#: What fits that run together may hold: large ones run alone, and so do their shuffles.
GRID_BYTES = 4e9


@register("grid_search", _results_sql([(VAL, rank, reg, 0) for rank in experiments.GRID_RANKS for reg in experiments.GRID_REGS]))
def _(spark, sf):
    _, tagged = _ratings(spark, sf)
    return _checked(experiments.tune(splitting.pick(tagged, TRAIN), splitting.pick(tagged, VAL), CHECKED, parallel=4, memory=GRID_BYTES))


@register("hybrid_als", _LISTS)
def _(spark, sf):
    facts, tagged = _ratings(spark, sf)
    train, users = splitting.pick(tagged, TRAIN), splitting.pick(tagged, VAL).select(USER).distinct()
    return _lists_audit(experiments.hybrid_pred(train, facts, users, QUICK, Run(k=K), weight=0.5), train)


@register("hybrid_tune", _results_sql([(VAL, QUICK.rank, QUICK.reg, w) for w in blend.DEFAULT_WEIGHTS]))
def _(spark, sf):
    facts, tagged = _ratings(spark, sf)
    return _checked(experiments.tune_weight(splitting.pick(tagged, TRAIN), splitting.pick(tagged, VAL), facts, QUICK, CHECKED))


@register("final_test", _results_sql([(TEST, 10, experiments.FINAL_REG, w) for w in (0, experiments.FINAL_WEIGHT)]))
def _(spark, sf):
    facts, tagged = _ratings(spark, sf)
    return _checked(experiments.final_test(tagged, facts, CHECKED))
