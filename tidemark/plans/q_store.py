"""Feature-store queries: materialize, incremental, latest timestamp, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import store as S
from ..operators import temporal as T
from ..sources.adapters import E_SQL, L_SQL, interactions_E, interactions_L
from .q_temporal import STAT_COLS, _movie_stats_cte, _movie_stats_r6, _user_stats, user_stats_sql
from .registry import query, with_ctes

START, END = "1995-01-01 00:00:00", "2001-06-30 00:00:00"
SPLIT = "1999-01-01 00:00:00"
_STAT_LIST = ", ".join(STAT_COLS)


@query("materialize_latest", with_ctes(L_SQL, _movie_stats_cte()) + f"""
SELECT movieId, max(event_timestamp) AS event_timestamp,
       {', '.join(f'arg_max({c}, event_timestamp) AS {c}' for c in STAT_COLS)}
FROM MS WHERE event_timestamp BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}' GROUP BY movieId""", "store")
def materialize_latest(spark, sf_dir):
    """Latest movie-stats row per movie inside an explicit [start, end] window (Q19)."""
    return S.materialize_latest(_movie_stats_r6(spark, sf_dir), ["movieId"], "event_timestamp", START, END)


@query("materialize_incremental", with_ctes(L_SQL, _movie_stats_cte()) + f"""
SELECT movieId, max(event_timestamp) AS event_timestamp,
       {', '.join(f'arg_max({c}, event_timestamp) AS {c}' for c in STAT_COLS)}
FROM MS GROUP BY movieId""", "store")
def materialize_incremental(spark, sf_dir):
    """Snapshot of rows before 1999 folded with the later slice == full rebuild."""
    ms = _movie_stats_r6(spark, sf_dir)
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    snap = S.materialize_latest(ms.filter(F.col("event_timestamp") < cut), ["movieId"], "event_timestamp")
    return S.materialize_incremental(snap, ms.filter(F.col("event_timestamp") >= cut), ["movieId"],
                                     "event_timestamp")


@query("latest_across_sources", with_ctes(L_SQL, E_SQL) + """
SELECT latest, strftime(latest, '%Y-%m-%dT%H:%M:%S') AS latest_text
FROM (SELECT greatest((SELECT max(event_timestamp) FROM L), (SELECT max(event_timestamp) FROM E)) AS latest)""",
       "store")
def latest_across_sources(spark, sf_dir):
    """Newest event time across the interaction sources."""
    return S.latest_across_sources([interactions_L(spark, sf_dir), interactions_E(spark, sf_dir)])


_SNAP_SQL = """SNAP AS (
  SELECT userId, max(event_timestamp) AS event_timestamp,
         arg_max(user_rating_cnt_90d, (event_timestamp, movieId)) AS user_rating_cnt_90d,
         arg_max(user_rating_avg_prev_rating_90d, (event_timestamp, movieId)) AS user_rating_avg_prev_rating_90d,
         arg_max(user_rating_list_10_recent_movie, (event_timestamp, movieId)) AS user_rating_list_10_recent_movie
  FROM USB GROUP BY userId)"""


@query("online_lookup", with_ctes(L_SQL, E_SQL, user_stats_sql(), _SNAP_SQL) + """
SELECT K.userId, SNAP.event_timestamp, SNAP.user_rating_cnt_90d, SNAP.user_rating_avg_prev_rating_90d,
       SNAP.user_rating_list_10_recent_movie
FROM (SELECT DISTINCT userId FROM E) K LEFT JOIN SNAP ON K.userId = SNAP.userId""", "store")
def online_lookup(spark, sf_dir):
    """Multi-get of the latest user features for every event-stream user."""
    us = _user_stats(spark, sf_dir).select("userId", "movieId", "event_timestamp", "user_rating_cnt_90d",
                                           "user_rating_avg_prev_rating_90d", "user_rating_list_10_recent_movie")
    snap = S.materialize_latest(us, ["userId"], "event_timestamp", tie=["movieId"]).drop("movieId")
    ents = interactions_E(spark, sf_dir).select("userId").distinct()
    return S.online_lookup(ents, snap, ["userId"])


@query("popularity_fallback", with_ctes(L_SQL, _movie_stats_cte()) + """
SELECT movieId, arg_max(movie_rating_cnt_90d, event_timestamp) AS score FROM MS GROUP BY movieId""", "store")
def popularity_fallback(spark, sf_dir):
    """Popularity from the latest 90-day count per movie."""
    return S.popularity_from_stats(T.movie_rating_stats(interactions_L(spark, sf_dir)))
