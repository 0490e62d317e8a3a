"""Retrieval and recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import ann as A
from ..operators import retrieval as R
from ..operators import sequences as Q
from ..sources.adapters import L_SQL, VEC_SQL, interactions_L, interactions_once, item_vectors, split_sql, table
from .registry import query, with_ctes

K_NB, K_POP, K_REC = 10, 20, 10

_COS = ("list_dot_product(a.vector, b.vector) / greatest(sqrt(list_dot_product(a.vector, a.vector)) * "
        "sqrt(list_dot_product(b.vector, b.vector)), 1e-12)")

_NB_SQL = f"""NB AS (
  SELECT target_item, rank, rec_item, score FROM (
    SELECT a.item_id AS target_item, b.item_id AS rec_item, {_COS} AS score,
           row_number() OVER (PARTITION BY a.item_id ORDER BY {_COS} DESC, b.item_id) AS rank
    FROM VEC a JOIN VEC b ON a.item_id <> b.item_id) WHERE rank <= {K_NB})"""

_POP_SQL = f"""POP AS (SELECT movieId, count(*) AS score FROM L GROUP BY movieId),
TOPP AS (SELECT movieId, score, row_number() OVER (ORDER BY score DESC, movieId::VARCHAR DESC) AS rank
         FROM POP ORDER BY score DESC, movieId::VARCHAR DESC LIMIT {K_POP})"""

_UV_SQL = """UV0 AS (SELECT L.userId, arg_max(VEC.vector, (L.event_timestamp, L.movieId)) AS vector
  FROM L JOIN VEC ON L.movieId = VEC.item_id GROUP BY L.userId),
UV AS (SELECT U.userId, coalesce(UV0.vector, (SELECT list_transform(any_value(vector), lambda x: 0 * x) FROM VEC)) AS vector
  FROM (SELECT DISTINCT userId FROM L) U LEFT JOIN UV0 ON U.userId = UV0.userId)"""


def _vec(spark, sf_dir):
    return item_vectors(spark, sf_dir)


@query("popularity", with_ctes(L_SQL) + "SELECT movieId, count(*) AS score FROM L GROUP BY movieId", "retrieval")
def popularity(spark, sf_dir):
    """A1: interaction count per item."""
    return R.popularity(interactions_L(spark, sf_dir))


@query("top_popular", with_ctes(L_SQL, _POP_SQL) + "SELECT * FROM TOPP", "retrieval")
def top_popular(spark, sf_dir):
    """Top-20 popular with the sorted-set tie rule (id text descending)."""
    return R.top_popular(R.popularity(interactions_L(spark, sf_dir)), K_POP)


_SEQ_PAIRS_SQL = """SQ AS (
  SELECT userId, (row_number() OVER (PARTITION BY userId ORDER BY event_timestamp, movieId) - 1)::BIGINT AS pos,
         movieId FROM L),
PAIRS AS (SELECT DISTINCT a.movieId AS target_item, b.movieId AS context_item
  FROM SQ a JOIN SQ b ON a.userId = b.userId AND b.pos BETWEEN a.pos - 3 AND a.pos + 3 AND a.pos <> b.pos)"""


@query("pair_score", with_ctes(L_SQL, VEC_SQL, _SEQ_PAIRS_SQL) + f"""
SELECT p.target_item, p.context_item, round(list_dot_product(a.vector, b.vector), 6) AS dot,
       round({_COS}, 6) AS cosine, round(1.0 / (1.0 + exp(-list_dot_product(a.vector, b.vector))), 6) AS prob
FROM PAIRS p JOIN VEC a ON p.target_item = a.item_id JOIN VEC b ON p.context_item = b.item_id""", "retrieval")
def pair_score(spark, sf_dir):
    """Dot, cosine and sigmoid(dot) of distinct skip-gram pairs."""
    seqs = Q.item_sequences(interactions_once(spark, sf_dir), min_len=1)
    pairs = Q.skipgram_pairs(seqs, 3).select("target_item", "context_item").distinct()
    out = R.pair_scores(pairs, _vec(spark, sf_dir), "target_item", "context_item")
    return out.select("target_item", "context_item", *[r6(c).alias(c) for c in ("dot", "cosine", "prob")])


@query("cosine_topk", with_ctes(VEC_SQL, _NB_SQL) + "SELECT target_item, rank, rec_item, round(score, 6) AS score FROM NB",
       "retrieval")
def cosine_topk(spark, sf_dir):
    """Exact cosine top-10 neighbours per item (self excluded), blocked."""
    return R.neighbours(_vec(spark, sf_dir), K_NB).withColumn("score", r6("score"))


@query("neighbour_records", with_ctes(VEC_SQL, _NB_SQL) + """
SELECT target_item, list(rec_item ORDER BY rank) AS rec_item_ids, list(round(score, 6) ORDER BY rank) AS rec_scores
FROM NB GROUP BY target_item""", "retrieval")
def neighbour_records(spark, sf_dir):
    """M12 record form: ranked neighbour id and score arrays per item (k bounded)."""
    nb = R.neighbours(_vec(spark, sf_dir), K_NB).withColumn("score", r6("score"))
    return R.neighbour_records(nb)


@query("similarity_matrix_top", with_ctes(L_SQL, VEC_SQL, """FQ AS (
  SELECT movieId, count(DISTINCT userId) AS freq FROM L GROUP BY movieId)""", """T25 AS (
  SELECT VEC.* FROM VEC JOIN FQ ON VEC.item_id = FQ.movieId ORDER BY FQ.freq DESC, VEC.item_id LIMIT 25)""") + f"""
SELECT a.item_id AS item_a, b.item_id AS item_b, round({_COS}, 6) AS cosine FROM T25 a, T25 b""", "retrieval")
def similarity_matrix_top(spark, sf_dir):
    """Cosine matrix among the 25 most frequent items that have vectors."""
    L = interactions_L(spark, sf_dir)
    fq = L.groupBy("movieId").agg(F.countDistinct("userId").alias("freq"))
    v = _vec(spark, sf_dir)
    top = v.join(fq, v.item_id == fq.movieId).orderBy(F.col("freq").desc(), F.col("item_id")).limit(25) \
        .select(F.col("item_id").alias("qid"), "vector")
    m = R.blocked_topk(top, top.withColumnRenamed("qid", "cid"), 25, "cosine")
    return m.select(F.col("qid").alias("item_a"), F.col("cid").alias("item_b"), r6("score").alias("cosine"))


def _candidates(spark, sf_dir, seen=None, L=None):
    L = interactions_once(spark, sf_dir) if L is None else L
    top_ids = [r["movieId"] for r in R.top_popular(R.popularity(L), K_POP).orderBy("rank").collect()]  # 20 ids
    last = R.last_item(L)
    nb = R.neighbours(_vec(spark, sf_dir), K_NB, targets=last.select(F.col("last_item").alias("item_id")))
    return L, R.candidate_set(last, top_ids, nb, L if seen is None else seen(L))


_CAND_SQL = f"""LAST AS (SELECT userId, arg_max(movieId, (event_timestamp, movieId)) AS last_item FROM L GROUP BY userId),
CU AS (
  SELECT LAST.userId, TOPP.movieId, 0 AS src, TOPP.rank FROM LAST, TOPP
  UNION ALL
  SELECT LAST.userId, NB.rec_item AS movieId, 1 AS src, NB.rank FROM LAST JOIN NB ON LAST.last_item = NB.target_item),
CD AS (SELECT userId, movieId, min((src, rank)) AS o FROM CU GROUP BY userId, movieId),
CS AS (SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY o, movieId) AS cand_rank
  FROM CD WHERE NOT EXISTS (SELECT 1 FROM L WHERE L.userId = CD.userId AND L.movieId = CD.movieId))"""


@query("candidate_set", with_ctes(L_SQL, VEC_SQL, _POP_SQL, _NB_SQL, _CAND_SQL) + """
SELECT userId, movieId, cand_rank FROM CS WHERE cand_rank <= 100""", "retrieval")
def candidate_set(spark, sf_dir):
    """Top-20 popular plus neighbours of the last item, minus seen, cap 100."""
    return _candidates(spark, sf_dir)[1]


@query("recommend_all_items", with_ctes(L_SQL, VEC_SQL, _UV_SQL) + f"""
SELECT userId, movieId, round(score, 6) AS score, rec_ranking FROM (
  SELECT UV.userId, VEC.item_id AS movieId, list_dot_product(UV.vector, VEC.vector) AS score,
         row_number() OVER (PARTITION BY UV.userId ORDER BY list_dot_product(UV.vector, VEC.vector) DESC, VEC.item_id)
           AS rec_ranking
  FROM UV, VEC) WHERE rec_ranking <= {K_REC}""", "retrieval")
def recommend_all_items(spark, sf_dir):
    """Score every (user, item) by dot product, top-10 per user (blocked)."""
    L = interactions_once(spark, sf_dir)
    v = _vec(spark, sf_dir)
    top = R.user_topk(L, v, K_REC)
    return top.select("userId", "movieId", r6("score").alias("score"), "rec_ranking")


@query("two_stage_recommend", with_ctes(L_SQL, VEC_SQL, _POP_SQL, _NB_SQL, _CAND_SQL, _UV_SQL) + f"""
SELECT userId, movieId, round(score, 6) AS score, rec_ranking FROM (
  SELECT CS.userId, CS.movieId, coalesce(list_dot_product(UV.vector, VEC.vector), 0.0) AS score,
         row_number() OVER (PARTITION BY CS.userId
                            ORDER BY coalesce(list_dot_product(UV.vector, VEC.vector), 0.0) DESC, CS.movieId) AS rec_ranking
  FROM CS LEFT JOIN UV ON CS.userId = UV.userId LEFT JOIN VEC ON CS.movieId = VEC.item_id
  WHERE CS.cand_rank <= 100) WHERE rec_ranking <= {K_REC}""", "retrieval")
def two_stage_recommend(spark, sf_dir):
    """Candidates -> user/item vectors -> dot score (missing -> 0) -> top-10, all users at once."""
    from ..functions.columns import dot
    L, cs = _candidates(spark, sf_dir)
    v = _vec(spark, sf_dir)
    uv = R.user_vectors(L, v).withColumnRenamed("vector", "_u")
    iv = v.select(F.col("item_id").alias("movieId"), F.col("vector").alias("_i"))
    sc = cs.join(uv, "userId", "left").join(iv, "movieId", "left") \
        .withColumn("score", F.coalesce(dot("_u", "_i"), F.lit(0.0)))
    top = R.top_k_by_score(sc, K_REC)
    return top.select("userId", "movieId", r6("score").alias("score"), "rec_ranking")


@query("best_run", """
SELECT event_type, arg_max(event_id, (value, event_id)) AS event_id, max(value) AS value
FROM events GROUP BY event_type""", "retrieval")
def best_run(spark, sf_dir):
    """Champion per experiment (event type): max metric, newer run wins ties."""
    runs = table(spark, sf_dir, "events", ["event_type", "event_id", "value"])
    return R.best_run(runs, "event_type", "value", "event_id").select("event_type", "event_id", "value")


_ANN_EVERY = 50  # queries: every 50th item, against all items


def _ann(spark, sf_dir):
    v = _vec(spark, sf_dir)
    return A.neighbours(v, v.where(F.col("item_id") % _ANN_EVERY == 0), K_NB)


@query("ann_topk", None, "retrieval")
def ann_topk(spark, sf_dir):
    """Approximate cosine top-10 of every 50th item by inverted lists."""
    return _ann(spark, sf_dir).withColumn("score", r6("score"))


@query("ann_recall", None, "retrieval")
def ann_recall(spark, sf_dir):
    """The share of the exact neighbours that ``ann_topk`` finds."""
    v = _vec(spark, sf_dir)
    q = v.where(F.col("item_id") % _ANN_EVERY == 0).select(F.col("item_id").alias("qid"), "vector")
    exact = R.blocked_topk(q, v.select(F.col("item_id").alias("cid"), "vector"), K_NB, "cosine", exclude_self=True)
    return A.recall(_ann(spark, sf_dir), exact.select(F.col("qid").alias("target_item"), F.col("cid").alias("rec_item")))
