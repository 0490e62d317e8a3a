"""Evaluation and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import metrics as M
from ..operators import prep as P
from ..operators import retrieval as R
from ..sources.adapters import (E_SQL, EL_SQL, L_SQL, VEC_SQL, events_labeled, interactions_E, interactions_L, interactions_once,
                                item_vectors, split_sql, table)
from .q_prep import _md5_key
from .registry import QUERIES, query, with_ctes

POS_W = 3.0
CUT = "2024-01-21 00:00:00"   # drift: reference = first 20 days, current = the rest

_ST_SQL = """ST AS (SELECT score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM EL GROUP BY score),
STB AS (SELECT *, coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
               coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM ST),
TOT AS (SELECT sum(pos) AS P, sum(neg) AS N FROM ST)"""


@query("classification_metrics", with_ctes(EL_SQL, _ST_SQL) + f"""
SELECT (SELECT count(*) FROM EL) AS num_pairs, (SELECT P FROM TOT)::BIGINT AS num_pos, (SELECT N FROM TOT)::BIGINT AS num_neg,
  round((SELECT avg(score) FROM EL), 6) AS mean_pred,
  round((SELECT sum(pos * (neg_below + neg * 0.5)) FROM STB) / ((SELECT P FROM TOT) * (SELECT N FROM TOT)), 6) AS roc_auc,
  round((SELECT sum(CASE WHEN pos > 0 THEN pos / TOT.P * ((TOT.P - pos_below) / ((TOT.P - pos_below) + (TOT.N - neg_below)))
                    ELSE 0 END) FROM STB, TOT), 6) AS avg_precision,
  round((SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) / greatest(count(*) FILTER (WHERE score >= 0.5), 1) FROM EL), 6)
    AS precision_at_05,
  round((SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) / (SELECT P FROM TOT) FROM EL), 6) AS recall_at_05,
  round((SELECT 2 * p * r / greatest(p + r, 1e-12) FROM (
     SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) / greatest(count(*) FILTER (WHERE score >= 0.5), 1) AS p,
            count(*) FILTER (WHERE score >= 0.5 AND label = 1) / sum(label) AS r FROM EL)), 6) AS f1_at_05,
  round((SELECT avg(-(label * greatest(ln(score), -100) + (1 - label) * greatest(ln(1 - score), -100))) FROM EL), 6) AS bce,
  round((SELECT avg(-(label * greatest(ln(score), -100) + (1 - label) * greatest(ln(1 - score), -100))
                    * CASE WHEN label = 1 THEN {POS_W} ELSE 1.0 END) FROM EL), 6) AS weighted_bce""", "metrics")
def classification_metrics(spark, sf_dir):
    """AUC, AP, P/R/F1@0.5, BCE and weighted BCE of (purchase, score)."""
    m = M.classification_metrics(events_labeled(spark, sf_dir), pos_weight=POS_W)
    return m.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


@query("roc_curve", with_ctes(EL_SQL, _ST_SQL) + """
SELECT score AS threshold, round((TOT.N - neg_below) / TOT.N, 6) AS fpr, round((TOT.P - pos_below) / TOT.P, 6) AS tpr
FROM STB, TOT""", "metrics")
def roc_curve(spark, sf_dir):
    """(fpr, tpr) at every distinct threshold."""
    p = M.roc_pr_points(events_labeled(spark, sf_dir))
    return p.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("pr_curve", with_ctes(EL_SQL, _ST_SQL) + """
SELECT score AS threshold,
       round((TOT.P - pos_below) / ((TOT.P - pos_below) + (TOT.N - neg_below)), 6) AS precision,
       round((TOT.P - pos_below) / TOT.P, 6) AS recall
FROM STB, TOT""", "metrics")
def pr_curve(spark, sf_dir):
    """(precision, recall) at every distinct threshold."""
    p = M.roc_pr_points(events_labeled(spark, sf_dir))
    return p.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query("pr_table", with_ctes(EL_SQL, """RK AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, event_id) AS rk, count(*) OVER () AS n FROM EL)""", """PB AS (
  SELECT ceil(rk * 10 / n)::INTEGER AS bin, count(*) AS c, min(score) AS lo, sum(label) AS tp_b FROM RK GROUP BY 1)""") + """
SELECT bin, count, prob, tp, count - tp AS fp, round(tp / count, 6) AS precision,
       round(tp / (SELECT sum(label) FROM EL), 6) AS recall
FROM (SELECT bin, sum(c) OVER w AS count, min(lo) OVER w AS prob, sum(tp_b) OVER w AS tp FROM PB
      WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""", "metrics")
def pr_table(spark, sf_dir):
    """Cumulative precision/recall table by top-10% score bins."""
    t = M.pr_table(events_labeled(spark, sf_dir), "event_id")
    return t.select("bin", "count", "prob", "tp", "fp", r6("precision").alias("precision"),
                    r6("recall").alias("recall"))


@query("score_histogram", with_ctes(EL_SQL) + """
SELECT label, least(floor(score * 50), 49)::INTEGER AS bin, count(*) AS count FROM EL GROUP BY ALL""", "metrics")
def score_histogram(spark, sf_dir):
    """50-bin score histogram per label."""
    return M.score_histogram(events_labeled(spark, sf_dir))


_REC_SQL = """UV0 AS (SELECT L.userId, arg_max(VEC.vector, (L.event_timestamp, L.movieId)) AS vector
  FROM TRAIN L JOIN VEC ON L.movieId = VEC.item_id GROUP BY L.userId),
UV AS (SELECT U.userId, coalesce(UV0.vector, (SELECT list_transform(any_value(vector), lambda x: 0 * x) FROM VEC)) AS vector
  FROM (SELECT DISTINCT userId FROM TRAIN L) U LEFT JOIN UV0 ON U.userId = UV0.userId),
REC AS (SELECT userId, movieId, rec_ranking FROM (
  SELECT UV.userId, VEC.item_id AS movieId,
         row_number() OVER (PARTITION BY UV.userId ORDER BY list_dot_product(UV.vector, VEC.vector) DESC, VEC.item_id)
           AS rec_ranking
  FROM UV, VEC) WHERE rec_ranking <= 10),
EV AS (SELECT REC.*, coalesce(LB.rating, 0.0) AS rating FROM REC LEFT JOIN (
  SELECT userId, movieId, arg_min(rating, event_timestamp) AS rating FROM VAL GROUP BY ALL) LB
  ON REC.userId = LB.userId AND REC.movieId = LB.movieId)"""


def _rec_eval(spark, sf_dir):
    tr, va = P.temporal_split(interactions_once(spark, sf_dir), "timestamp", 90)
    recs = R.user_topk(tr, item_vectors(spark, sf_dir), 10).drop("score")
    return M.rec_eval_join(recs, va), va


@query("rec_eval_join", with_ctes(L_SQL, VEC_SQL, split_sql(), _REC_SQL) + "SELECT * FROM EV", "metrics")
def rec_eval_join(spark, sf_dir):
    """Train-based top-10 recommendations joined to validation labels (missing -> 0)."""
    return _rec_eval(spark, sf_dir)[0]


@query("ranking_metrics", with_ctes(L_SQL, VEC_SQL, split_sql(), _REC_SQL, """NR AS (
  SELECT userId, count(DISTINCT movieId) AS n_rel FROM VAL WHERE rating > 0 GROUP BY userId)""", """G AS (
  SELECT EV.userId, sum((rating > 0)::INTEGER / log2(rec_ranking + 1.0)) AS dcg, sum((rating > 0)::INTEGER) AS hits,
         coalesce(any_value(NR.n_rel), 0) AS n_rel
  FROM EV LEFT JOIN NR ON EV.userId = NR.userId GROUP BY EV.userId)""") + """
SELECT userId,
  round(CASE WHEN least(n_rel, 10) > 0 THEN dcg / list_sum(list_transform(range(1, least(n_rel, 10) + 1),
        lambda i: 1.0 / log2(i + 1.0))) ELSE 0.0 END, 6) AS ndcg,
  round(hits / 10.0, 6) AS precision,
  round(CASE WHEN n_rel > 0 THEN hits / n_rel ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN hits / 10.0 + CASE WHEN n_rel > 0 THEN hits / n_rel ELSE 0.0 END > 0
        THEN 2 * (hits / 10.0) * (hits / n_rel) / (hits / 10.0 + hits / n_rel) ELSE 0.0 END, 6) AS fbeta
FROM G""", "metrics")
def ranking_metrics(spark, sf_dir):
    """Per-user NDCG@10, precision@10, recall@10, F1@10 against validation items."""
    ev, va = _rec_eval(spark, sf_dir)
    m = M.ranking_metrics(ev, va, 10)
    return m.select("userId", *[r6(c).alias(c) for c in ("ndcg", "precision", "recall", "fbeta")])


def _drift_frames(spark, sf_dir):
    E = interactions_E(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return E.where(F.col("event_timestamp") < cut), E.where(F.col("event_timestamp") >= cut)


_DRIFT_SQL = f"""REF AS (SELECT * FROM E WHERE event_timestamp < TIMESTAMP '{CUT}'),
CUR AS (SELECT * FROM E WHERE event_timestamp >= TIMESTAMP '{CUT}')"""


def _psi_sql(col: str) -> str:
    qs = ", ".join(str(i / 10) for i in range(1, 10))
    return f"""SELECT '{col}' AS "column", round(psi, 6) AS psi, psi >= 0.1 AS drifted FROM (
  SELECT sum((pc - pr) * ln(pc / pr)) AS psi FROM (
    SELECT greatest(coalesce(r.p, 0.0), 1e-4) AS pr, greatest(coalesce(c.p, 0.0), 1e-4) AS pc FROM
      (SELECT b, count(*) / (SELECT count(*) FROM REF) AS p FROM (
         SELECT list_sum(list_transform(q, lambda e: ({col}::DOUBLE > e)::INTEGER)) AS b
         FROM REF, (SELECT quantile_cont({col}::DOUBLE, [{qs}]) AS q FROM REF)) GROUP BY b) r
    FULL JOIN
      (SELECT b, count(*) / (SELECT count(*) FROM CUR) AS p FROM (
         SELECT list_sum(list_transform(q, lambda e: ({col}::DOUBLE > e)::INTEGER)) AS b
         FROM CUR, (SELECT quantile_cont({col}::DOUBLE, [{qs}]) AS q FROM REF)) GROUP BY b) c
    ON r.b = c.b))"""


@query("drift_psi", with_ctes(E_SQL, _DRIFT_SQL) + _psi_sql("rating") + "\nUNION ALL\n" + _psi_sql("movieId"), "metrics")
def drift_psi(spark, sf_dir):
    """PSI of rating and item id, first 20 days vs the rest."""
    ref, cur = _drift_frames(spark, sf_dir)
    out = M.psi(ref, cur, "rating").unionByName(M.psi(ref, cur, "movieId"))
    return out.select("column", r6("psi").alias("psi"), "drifted")


def _ks_sql(col: str) -> str:
    return f"""SELECT '{col}' AS "column", round(max(abs(ca / na - cb / nb)), 6) AS ks_d,
  round(1.358 * sqrt((na + nb) / (na * nb)), 6) AS critical,
  max(abs(ca / na - cb / nb)) > 1.358 * sqrt((na + nb) / (na * nb)) AS drifted
FROM (SELECT x, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM (
  SELECT x, sum(a) AS a, sum(b) AS b FROM (
    SELECT {col}::DOUBLE AS x, 1 AS a, 0 AS b FROM REF UNION ALL SELECT {col}::DOUBLE, 0, 1 FROM CUR) GROUP BY x)
  WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING))
GROUP BY na, nb"""


@query("drift_ks", with_ctes(E_SQL, _DRIFT_SQL) + _ks_sql("rating") + "\nUNION ALL\n" + _ks_sql("movieId"), "metrics")
def drift_ks(spark, sf_dir):
    """Two-sample KS statistic and alpha=0.05 decision per column."""
    ref, cur = _drift_frames(spark, sf_dir)
    out = M.ks(ref, cur, "rating").unionByName(M.ks(ref, cur, "movieId"))
    return out.select("column", r6("ks_d").alias("ks_d"), r6("critical").alias("critical"), "drifted")


@query("drift_js", f"""WITH REF AS (SELECT * FROM events WHERE ts < TIMESTAMP '{CUT}'),
CUR AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{CUT}'),
J AS (SELECT coalesce(r.p, 0.0) AS p, coalesce(c.q, 0.0) AS q FROM
  (SELECT event_type AS v, count(*) / (SELECT count(*) FROM REF) AS p FROM REF GROUP BY 1) r FULL JOIN
  (SELECT event_type AS v, count(*) / (SELECT count(*) FROM CUR) AS q FROM CUR GROUP BY 1) c ON r.v = c.v)
SELECT 'event_type' AS "column", round(js, 6) AS js, js >= 0.1 AS drifted FROM (
  SELECT sqrt(greatest(sum(CASE WHEN p > 0 THEN 0.5 * p * ln(p / ((p + q) / 2)) ELSE 0 END
                         + CASE WHEN q > 0 THEN 0.5 * q * ln(q / ((p + q) / 2)) ELSE 0 END), 0)) AS js FROM J)""",
       "metrics")
def drift_js(spark, sf_dir):
    """Jensen-Shannon distance of the event-type mix."""
    ev = table(spark, sf_dir, "events", ["event_type", "ts"])
    cut = F.lit(CUT).cast("timestamp_ntz")
    out = M.jensen_shannon(ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut), "event_type")
    return out.select("column", r6("js").alias("js"), "drifted")


@query("drift_dataset", f"""SELECT count(*) AS n_columns, count(*) FILTER (drifted) AS n_drifted,
  count(*) FILTER (drifted) / count(*) AS drift_share, count(*) FILTER (drifted) / count(*) >= 0.5 AS dataset_drift
FROM (SELECT drifted FROM ({QUERIES['drift_ks'].sql}) UNION ALL SELECT drifted FROM ({QUERIES['drift_js'].sql}))""", "metrics")
def drift_dataset(spark, sf_dir):
    """The flag of the whole table, from the decisions on rating, item id and event type."""
    each = drift_ks(spark, sf_dir).select("column", "drifted").unionByName(drift_js(spark, sf_dir).select("column", "drifted"))
    return M.dataset_drift(each)


@query("drift_reference_sample", f"""
SELECT event_id, user_id, value, {_md5_key("'0'", "event_id")} AS sample_key FROM events
WHERE ts < TIMESTAMP '{CUT}' ORDER BY sample_key, event_id LIMIT 10000""", "metrics")
def drift_reference_sample(spark, sf_dir):
    """E11 (Q18): deterministic 10 000-row reference sample (hash order; the limit is the feature)."""
    ev = table(spark, sf_dir, "events", ["event_id", "user_id", "value", "ts"])
    ref = ev.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).drop("ts")
    return M.reference_sample(ref, ["event_id"], 10000, seed=0)
