"""Id maps, id-list conversion and sequence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import csv_tokens, pad_left, r6
from ..operators import ids as I
from ..operators import prep as P
from ..operators import sequences as Q
from ..sources.adapters import E_SQL, L_SQL, interactions_E, interactions_L, interactions_once, split_sql, table
from .q_temporal import _user_stats, user_stats_sql
from .registry import query, with_ctes

WINDOW = 3  # skip-gram window (fixed value of the item2vec config)


def _train_val(spark, sf_dir):
    return P.temporal_split(interactions_L(spark, sf_dir), "timestamp", 90)


def _map_sql(name: str, src: str, col: str) -> str:
    return f"""{name} AS (SELECT {col} AS raw_id, (row_number() OVER (ORDER BY {col}) - 1)::BIGINT AS idx
  FROM (SELECT DISTINCT {col} FROM {src}))"""


@query("id_index", with_ctes(L_SQL, split_sql(), _map_sql("UM", "TRAIN", "userId"), _map_sql("IM", "TRAIN", "movieId")) + """
SELECT VAL.userId, VAL.movieId, VAL.event_timestamp,
       coalesce(UM.idx, (SELECT count(*) FROM UM)) AS user_indice,
       coalesce(IM.idx, (SELECT count(*) FROM IM)) AS item_indice
FROM VAL LEFT JOIN UM ON VAL.userId = UM.raw_id LEFT JOIN IM ON VAL.movieId = IM.raw_id""", "ids")
def id_index(spark, sf_dir):
    """Validation rows mapped with train-fitted user/item maps (unknown -> n)."""
    tr, va = _train_val(spark, sf_dir)
    um, im = I.fit_id_map(tr, "userId"), I.fit_id_map(tr, "movieId")
    out = I.map_index(va.select("userId", "movieId", "event_timestamp"), um, "userId", "user_indice")
    return I.map_index(out, im, "movieId", "item_indice")


@query("id_reverse", with_ctes(L_SQL, split_sql(), _map_sql("IM", "TRAIN", "movieId")) + """
SELECT c.c_custkey, c.c_custkey * 2 AS idx, coalesce(IM.raw_id::VARCHAR, 'unknown_item') AS item_id
FROM customer c LEFT JOIN IM ON c.c_custkey * 2 = IM.idx""", "ids")
def id_reverse(spark, sf_dir):
    """Index -> raw id text, out-of-range -> 'unknown_item' (probes: 2 x customer key)."""
    tr, _ = _train_val(spark, sf_dir)
    im = I.fit_id_map(tr, "movieId")
    probes = table(spark, sf_dir, "customer", ["c_custkey"]).withColumn("idx", F.col("c_custkey") * 2)
    return I.reverse_index(probes, im, "idx", "item_id")


@query("idmap_extend", with_ctes(L_SQL, split_sql(), _map_sql("VM", "VAL", "movieId")) + """
SELECT raw_id, idx FROM VM
UNION ALL
SELECT movieId AS raw_id, (SELECT count(*) FROM VM) + row_number() OVER (ORDER BY movieId) - 1 AS idx
FROM (SELECT DISTINCT movieId FROM TRAIN WHERE movieId NOT IN (SELECT raw_id FROM VM))""", "ids")
def idmap_extend(spark, sf_dir):
    """A map fitted on validation items, extended with unseen train items."""
    tr, va = _train_val(spark, sf_dir)
    return I.extend_id_map(I.fit_id_map(va, "movieId"), tr, "movieId")


@query("csv_ids_to_index", with_ctes(L_SQL, user_stats_sql()) + """
SELECT userId, movieId, event_timestamp,
       list_transform(list_filter(string_split(user_rating_list_10_recent_movie, ','), lambda x: trim(x) <> ''),
                      lambda x: x::BIGINT) AS recent_ids
FROM USB""", "ids")
def csv_ids_to_index(spark, sf_dir):
    """F8: comma list of recent ids -> id array (blank tokens dropped)."""
    us = _user_stats(spark, sf_dir)
    return us.select("userId", "movieId", "event_timestamp",
                     F.transform(csv_tokens("user_rating_list_10_recent_movie"),
                                 lambda x: x.cast("long")).alias("recent_ids"))


_MM = """MM AS (SELECT map_from_entries(list({'k': raw_id, 'v': idx})) AS m, count(*) AS n FROM IM)"""


@query("item_sequence", with_ctes(L_SQL, split_sql(), user_stats_sql(), _map_sql("IM", "TRAIN", "movieId"), _MM) + """
SELECT userId, movieId, event_timestamp,
       list_concat(list_transform(range(10 - len(ix)), lambda x: -1::BIGINT), ix) AS item_sequence
FROM (SELECT userId, movieId, event_timestamp,
             list_transform(list_filter(string_split(user_rating_list_10_recent_movie, ','), lambda x: trim(x) <> ''),
                            lambda x: coalesce(m[x::BIGINT], n)) AS ix
      FROM USB, MM)""", "ids")
def item_sequence(spark, sf_dir):
    """recent-id list -> train-map indices, left-padded to 10 (unknown -> n)."""
    tr, _ = _train_val(spark, sf_dir)
    im = I.fit_id_map(tr, "movieId")
    us = _user_stats(spark, sf_dir)
    return I.id_list_to_index(us, ["userId", "movieId", "event_timestamp"], "user_rating_list_10_recent_movie",
                              im, "item_sequence", 10, keep="first")


@query("item_sequence_serving", with_ctes(L_SQL, split_sql(), user_stats_sql(), _map_sql("IM", "TRAIN", "movieId"), _MM, """S AS (
  SELECT userId, movieId, event_timestamp,
         list_concat(list_transform(range(10 - len(ids)), lambda x: '-1'), ids, [movieId::VARCHAR]) AS toks
  FROM (SELECT userId, movieId, event_timestamp,
               list_filter(string_split(user_rating_list_10_recent_movie, ','), lambda x: x <> '') AS ids FROM USB))""") + """
SELECT userId, movieId, event_timestamp,
       list_transform(toks[-10:], lambda x: CASE WHEN x = '-1' OR x = '' THEN -1
            ELSE coalesce(m[TRY_CAST(x AS BIGINT)], n) END)
         AS item_sequence
FROM S, MM""", "ids")
def item_sequence_serving(spark, sf_dir):
    """serving-side conversion: '-1'-padded id strings + the current item,
    keep the last 10, '-1'/'' -> -1, unknown -> n."""
    tr, _ = _train_val(spark, sf_dir)
    im = I.fit_id_map(tr, "movieId")
    us = _user_stats(spark, sf_dir)
    ids = F.filter(F.split("user_rating_list_10_recent_movie", ","), lambda x: x != "")
    toks = F.concat(F.array_repeat(F.lit("-1"), F.greatest(F.lit(10) - F.size(ids), F.lit(0))), ids,
                    F.array(F.col("movieId").cast("string")))
    base = us.select("userId", "movieId", "event_timestamp", toks.alias("toks"))
    return I.id_list_to_index(base, ["userId", "movieId", "event_timestamp"], "toks", im, "item_sequence",
                              10, keep="last")


@query("array_pad_left", with_ctes(E_SQL, """R AS (
  SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY event_timestamp DESC, movieId DESC) AS rk,
         event_timestamp FROM E)""") + """
SELECT userId, list_concat(list_transform(range(10 - len(l)), lambda x: -1::BIGINT), l) AS last10
FROM (SELECT userId, list(movieId ORDER BY event_timestamp, movieId) AS l FROM R WHERE rk <= 10 GROUP BY userId)""",
       "ids")
def array_pad_left(spark, sf_dir):
    """each user's last 10 items, left-padded with -1 (bounded top-10 per user first)."""
    from pyspark.sql import Window
    E = interactions_E(spark, sf_dir)
    w = Window.partitionBy("userId").orderBy(F.col("event_timestamp").desc(), F.col("movieId").desc())
    top = E.withColumn("rk", F.row_number().over(w)).where("rk <= 10")
    g = top.groupBy("userId").agg(F.sort_array(F.collect_list(F.struct("event_timestamp", "movieId"))).alias("l"))
    return g.select("userId", pad_left(F.transform("l", lambda x: x["movieId"]), 10).alias("last10"))


_SEQ_SQL = """SQ AS (
  SELECT userId, (row_number() OVER (PARTITION BY userId ORDER BY event_timestamp, movieId) - 1)::BIGINT AS pos,
         movieId, count(*) OVER (PARTITION BY userId) AS seq_len FROM L)"""


def _seqs(spark, sf_dir):
    return Q.item_sequences(interactions_once(spark, sf_dir))


@query("item_sequences", with_ctes(L_SQL, _SEQ_SQL) + "SELECT * FROM SQ WHERE seq_len >= 2", "ids")
def item_sequences(spark, sf_dir):
    """Time-ordered per-user sequences in long form, length >= 2."""
    return _seqs(spark, sf_dir)


@query("item_sequences_sample", with_ctes(L_SQL, _SEQ_SQL) + """
SELECT * FROM SQ WHERE seq_len >= 2 AND userId IN
  (SELECT DISTINCT userId FROM SQ WHERE seq_len >= 2 ORDER BY userId LIMIT 2)""", "ids")
def item_sequences_sample(spark, sf_dir):
    """The first two sequences by user id (a preview; the limit is the feature)."""
    s = _seqs(spark, sf_dir)
    first2 = s.select("userId").distinct().orderBy("userId").limit(2)
    return s.join(first2, "userId", "left_semi")


@query("skipgram_pairs", with_ctes(L_SQL, _SEQ_SQL) + f"""
SELECT a.userId, a.pos AS t_pos, b.pos AS c_pos, a.movieId AS target_item, b.movieId AS context_item, 1.0 AS label
FROM SQ a JOIN SQ b ON a.userId = b.userId AND b.pos BETWEEN a.pos - {WINDOW} AND a.pos + {WINDOW} AND a.pos <> b.pos
WHERE a.seq_len >= 2""", "ids")
def skipgram_pairs(spark, sf_dir):
    """Skip-gram positives, window 3."""
    return Q.skipgram_pairs(_seqs(spark, sf_dir), WINDOW)


@query("item_doc_freq", with_ctes(L_SQL, _SEQ_SQL) + """
SELECT movieId, count(DISTINCT userId) AS freq FROM SQ WHERE seq_len >= 2 GROUP BY movieId""", "ids")
def item_doc_freq(spark, sf_dir):
    """Sequences containing each item."""
    return Q.item_doc_freq(_seqs(spark, sf_dir))


@query("sampling_probs", with_ctes(L_SQL, _SEQ_SQL, """FQ AS (
  SELECT movieId, count(DISTINCT userId) AS freq FROM SQ WHERE seq_len >= 2 GROUP BY movieId)""") + """
SELECT movieId, freq, round(pow(freq, 0.75), 6) AS w, round(pow(freq, 0.75) / sum(pow(freq, 0.75)) OVER (), 9) AS prob
FROM FQ""", "ids")
def sampling_probs(spark, sf_dir):
    """f^0.75 / sum over document frequencies."""
    p = Q.sampling_probs(Q.item_doc_freq(_seqs(spark, sf_dir)))
    return p.select("movieId", "freq", r6("w").alias("w"), F.round("prob", 9).alias("prob"))


@query("seen_set_size", with_ctes(L_SQL) + """
SELECT userId, count(DISTINCT movieId) AS n_seen FROM L GROUP BY userId""", "ids")
def seen_set_size(spark, sf_dir):
    """A2: size of each user's seen set (kept as distinct pairs, not a collected set)."""
    L = interactions_L(spark, sf_dir)
    return L.select("userId", "movieId").distinct().groupBy("userId").agg(F.count(F.lit(1)).alias("n_seen"))
