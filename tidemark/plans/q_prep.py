"""Queries for typing, cleaning, splitting, dedup, k-core and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hash64, mask_secret, r6, safe_double, safe_long
from ..operators import prep as P
from ..sources.adapters import (E_SQL, ITEMS_SQL, L_SQL, interactions_E, interactions_L, items_part,
                                split_sql, table)
from .registry import query, with_ctes

KCORE = (25, 18)
VAL_DAYS = 90
HOLDOUT_DAYS = 30


def _md5_key(*parts: str) -> str:
    """DuckDB form of :func:`tidemark.functions.columns.hash64`."""
    return "('0x' || substr(md5(concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")), 1, 15))::BIGINT"


def _splits(spark, sf_dir):
    L = interactions_L(spark, sf_dir)
    tr, va = P.temporal_split(L, "timestamp", VAL_DAYS, "event_timestamp")
    return L, tr, va


# -------------------------------------------------------------- typing / cleaning

@query("typed_interactions", with_ctes(L_SQL) + """
SELECT userId, movieId, rating, "timestamp", make_timestamp("timestamp" * 1000000) AS event_timestamp,
       "timestamp" * 1000 AS timestamp_unix FROM L""", "prep")
def typed_interactions(spark, sf_dir):
    L = interactions_L(spark, sf_dir).select("userId", "movieId", "rating", "timestamp")
    return P.typed_interactions(L)


@query("parse_dt_autodetect", with_ctes(L_SQL) + """
SELECT userId, movieId, make_timestamp("timestamp" * 1000000) AS ts_s,
       make_timestamp("timestamp" * 1000000) AS ts_ms, event_timestamp AS ts_txt FROM L""", "prep")
def parse_dt_autodetect(spark, sf_dir):
    """F3 on three encodings of the same instant: seconds, milliseconds, text."""
    L = interactions_L(spark, sf_dir)
    raw = L.select("userId", "movieId", F.col("timestamp").alias("ts_s"), (F.col("timestamp") * 1000).alias("ts_ms"),
                   F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts_txt"))
    return P.parse_dt(raw, ["ts_s", "ts_ms", "ts_txt"])


_RAW_EVENTS_SQL = """RAW AS (
  SELECT event_id, user_id::VARCHAR AS userId,
         CASE WHEN event_type = 'error' THEN props ELSE json_extract_string(props, '$.k') END AS movieId,
         CASE WHEN event_type = 'signup' THEN 'None' ELSE value::VARCHAR END AS rating,
         ((epoch_us(ts) // 1000) // 1000)::BIGINT AS "timestamp", event_type
  FROM events)"""


def _raw_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props", "value", "ts"])
    return ev.select(
        "event_id", F.col("user_id").cast("string").alias("userId"),
        F.when(F.col("event_type") == "error", F.col("props"))
         .otherwise(F.get_json_object("props", "$.k")).alias("movieId"),
        F.when(F.col("event_type") == "signup", F.lit("None")).otherwise(F.col("value").cast("string")).alias("rating"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"), "event_type")


@query("standardize_dtypes", with_ctes(_RAW_EVENTS_SQL) + """
SELECT userId::BIGINT AS userId, movieId::BIGINT AS movieId, rating::DOUBLE AS rating,
       make_timestamp("timestamp" * 1000000) AS "timestamp"
FROM RAW WHERE event_type NOT IN ('error', 'signup')""", "prep")
def standardize_dtypes(spark, sf_dir):
    """Text ids and ratings (some junk, some "None") -> typed; bad rows dropped."""
    return P.standardize_dtypes(_raw_events(spark, sf_dir).drop("event_id", "event_type"))


@query("safe_cast", with_ctes(_RAW_EVENTS_SQL) + """
SELECT event_id,
       coalesce(CASE WHEN regexp_full_match(trim(movieId), '[+-]?[0-9]+') THEN TRY_CAST(trim(movieId) AS BIGINT) END, 0) AS movie_int,
       coalesce(TRY_CAST(trim(rating) AS DOUBLE), 0.0) AS rating_float,
       coalesce(CASE WHEN regexp_full_match(trim(rating), '[+-]?[0-9]+') THEN TRY_CAST(trim(rating) AS BIGINT) END, -1) AS rating_int
FROM RAW""", "prep")
def safe_cast(spark, sf_dir):
    """safe int/float with defaults over text that includes "None" and JSON junk."""
    raw = _raw_events(spark, sf_dir)
    return raw.select("event_id", safe_long("movieId", 0).alias("movie_int"),
                      safe_double("rating", 0.0).alias("rating_float"),
                      safe_long("rating", -1).alias("rating_int"))


@query("mask_string", """
SELECT c_custkey, CASE WHEN c_name IS NULL OR length(c_name) = 0 THEN '(empty)'
                       WHEN length(c_name) > 2 THEN substr(c_name, 1, 2) || '***' ELSE '***' END AS name_masked,
       CASE WHEN c_mktsegment IS NULL OR length(c_mktsegment) = 0 THEN '(empty)'
            WHEN length(c_mktsegment) > 2 THEN substr(c_mktsegment, 1, 2) || '***' ELSE '***' END AS segment_masked
FROM customer""", "prep")
def mask_string(spark, sf_dir):
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return c.select("c_custkey", mask_secret("c_name").alias("name_masked"),
                    mask_secret("c_mktsegment").alias("segment_masked"))


_UNION_SQL = """U AS (
  SELECT userId, movieId, rating, event_timestamp, NULL::VARCHAR AS source FROM L
  UNION ALL
  SELECT userId, movieId, NULL::DOUBLE AS rating, event_timestamp, 'events' AS source FROM E)"""


def _union_missing(spark, sf_dir):
    L = interactions_L(spark, sf_dir).select("userId", "movieId", "rating", "event_timestamp")
    E = interactions_E(spark, sf_dir).select("userId", "movieId", "event_timestamp",
                                             F.lit("events").alias("source"))
    return P.union_missing(L, E)


@query("union_missing_columns", with_ctes(L_SQL, E_SQL, _UNION_SQL) + "SELECT * FROM U", "prep")
def union_missing_columns(spark, sf_dir):
    """Positives (with rating) + event rows (with source); absent -> NULL."""
    return _union_missing(spark, sf_dir)


@query("typed_fill", with_ctes(L_SQL, E_SQL, _UNION_SQL) + """
SELECT userId, movieId, coalesce(rating, 0.0) AS rating, event_timestamp, coalesce(source, '') AS source FROM U""",
       "prep")
def typed_fill(spark, sf_dir):
    """P10: type-aware fill of the U2 union (text -> '', numbers -> 0)."""
    return P.typed_fill(_union_missing(spark, sf_dir))


@query("label_weight", with_ctes(L_SQL, E_SQL, _UNION_SQL) + """
SELECT userId, movieId, coalesce(rating, 0.0) AS rating, event_timestamp, coalesce(source, '') AS source,
       (coalesce(rating, 0.0) > 0)::INTEGER AS label,
       CASE WHEN coalesce(rating, 0.0) > 0 THEN 3.0 ELSE 1.0 END AS weight FROM U""", "prep")
def label_weight(spark, sf_dir):
    """label = rating > 0, weight = 3 for positives (negatives filled with 0)."""
    return P.label_weight(P.typed_fill(_union_missing(spark, sf_dir)), "rating", 3.0)


@query("required_columns", with_ctes(E_SQL) + """
SELECT userId, movieId, event_timestamp, 0.0 AS rating, 0.0 AS movie_rating_cnt_90d FROM E""", "prep")
def required_columns(spark, sf_dir):
    """Add the required model inputs missing from the frame."""
    E = interactions_E(spark, sf_dir).select("userId", "movieId", "event_timestamp")
    return P.required_columns(E, ["userId", "rating", "movie_rating_cnt_90d"], 0.0)


# -------------------------------------------------------------- unions and splits

@query("temporal_split", with_ctes(L_SQL, split_sql(VAL_DAYS)) + "SELECT * FROM VAL", "prep")
def temporal_split(spark, sf_dir):
    """Validation rows, ts >= max(ts) - 90 days."""
    _, _, va = _splits(spark, sf_dir)
    return va.withColumn("source", F.lit("val"))


@query("union_tagged", with_ctes(L_SQL, ITEMS_SQL, split_sql(VAL_DAYS)) + """
SELECT U.userId, U.movieId, U.rating, U.event_timestamp, U."timestamp", U.source, ITEMS.title, ITEMS.genres,
       (epoch_us(U.event_timestamp) // 1000) AS timestamp_unix
FROM (SELECT * FROM TRAIN UNION ALL SELECT * FROM VAL) U LEFT JOIN ITEMS ON U.movieId = ITEMS.movieId""", "prep")
def union_tagged(spark, sf_dir):
    """Tagged train/val union joined to item metadata."""
    _, tr, va = _splits(spark, sf_dir)
    u = P.union_tagged({"train": tr, "val": va})
    return P.join_metadata(u, items_part(spark, sf_dir)).withColumn(
        "timestamp_unix", F.unix_millis(F.col("event_timestamp").cast("timestamp")))


_COLD_SQL = """VALC AS (
  SELECT * FROM VAL WHERE userId IN (SELECT userId FROM TRAIN) AND movieId IN (SELECT movieId FROM TRAIN))"""


@query("cold_start_filter", with_ctes(L_SQL, split_sql(VAL_DAYS), _COLD_SQL) + "SELECT * FROM VALC", "prep")
def cold_start_filter(spark, sf_dir):
    """Validation rows whose user and item both occur in train."""
    _, tr, va = _splits(spark, sf_dir)
    return P.cold_start_filter(va.withColumn("source", F.lit("val")), tr)


@query("cold_start_violations", with_ctes(L_SQL, split_sql(VAL_DAYS)) + """
SELECT 'user' AS kind, userId AS id FROM (SELECT DISTINCT userId FROM VAL) WHERE userId NOT IN (SELECT userId FROM TRAIN)
UNION ALL
SELECT 'item' AS kind, movieId AS id FROM (SELECT DISTINCT movieId FROM VAL) WHERE movieId NOT IN (SELECT movieId FROM TRAIN)""",
       "prep")
def cold_start_violations(spark, sf_dir):
    """Validation users/items never seen in train."""
    _, tr, va = _splits(spark, sf_dir)
    return P.cold_start_violations(va, tr)


@query("holdout_split", with_ctes(L_SQL, ITEMS_SQL, split_sql(VAL_DAYS), _COLD_SQL, """FULLF AS (
  SELECT U.*, ITEMS.title, ITEMS.genres FROM (SELECT * FROM TRAIN UNION ALL SELECT * FROM VALC) U
  LEFT JOIN ITEMS ON U.movieId = ITEMS.movieId)""", """HCUT AS (
  SELECT date_trunc('day', max(event_timestamp) - INTERVAL 30 DAY) AS cut FROM FULLF)""") + """
SELECT FULLF.* FROM FULLF, HCUT WHERE FULLF.event_timestamp >= HCUT.cut""", "prep")
def holdout_split(spark, sf_dir):
    """Rows at or after midnight of (max - 30 days) form the replay holdout."""
    _, tr, va = _splits(spark, sf_dir)
    full = P.union_tagged({"train": tr, "val": P.cold_start_filter(va, tr)})
    full = P.join_metadata(full, items_part(spark, sf_dir))
    _, hold = P.holdout_split(full, "event_timestamp", HOLDOUT_DAYS)
    return hold


@query("resplit_counts", with_ctes(L_SQL, split_sql(VAL_DAYS), _COLD_SQL, """ALLR AS (
  SELECT * FROM TRAIN UNION ALL SELECT * FROM VALC)""", """C AS (SELECT min(event_timestamp) AS cut FROM VALC)""") + """
SELECT 'train' AS part, count(*) FILTER (WHERE ALLR.event_timestamp < C.cut) AS n_rows,
       (SELECT count(*) FROM TRAIN) AS expected_rows FROM ALLR, C
UNION ALL
SELECT 'val' AS part, count(*) FILTER (WHERE ALLR.event_timestamp >= C.cut) AS n_rows,
       (SELECT count(*) FROM VALC) AS expected_rows FROM ALLR, C""", "prep")
def resplit_counts(spark, sf_dir):
    """Re-split train + filtered val at min(val ts); counts vs the originals."""
    _, tr, va = _splits(spark, sf_dir)
    vac = P.cold_start_filter(va, tr)
    full = P.union_tagged({"train": tr, "val": vac})
    a, b = P.resplit(full, vac)
    ca = a.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("part", F.lit("train"))
    cb = b.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("part", F.lit("val"))
    ea = tr.agg(F.count(F.lit(1)).alias("expected_rows")).withColumn("part", F.lit("train"))
    eb = vac.agg(F.count(F.lit(1)).alias("expected_rows")).withColumn("part", F.lit("val"))
    return ca.unionByName(cb).join(ea.unionByName(eb), "part").select("part", "n_rows", "expected_rows")


# -------------------------------------------------------------- dedup / k-core

@query("dedup_keep_first", with_ctes(L_SQL) + """
SELECT userId, event_timestamp, arg_min(movieId, movieId) AS movieId, arg_min(rating, movieId) AS rating,
       arg_min("timestamp", movieId) AS "timestamp" FROM L GROUP BY userId, event_timestamp""", "prep")
def dedup_keep_first(spark, sf_dir):
    """A10: one row per (user, instant), smallest item first (strict mode of Q5)."""
    return P.dedup(interactions_L(spark, sf_dir), ["userId", "event_timestamp"], ["movieId"], "first")


@query("dedup_keep_last", with_ctes(L_SQL) + """
SELECT userId, event_timestamp, arg_max(movieId, movieId) AS movieId, arg_max(rating, movieId) AS rating,
       arg_max("timestamp", movieId) AS "timestamp" FROM L GROUP BY userId, event_timestamp""", "prep")
def dedup_keep_last(spark, sf_dir):
    """A10: one row per (user, instant), greatest item last (compat mode of Q5)."""
    return P.dedup(interactions_L(spark, sf_dir), ["userId", "event_timestamp"], ["movieId"], "last")


def _kcore_sql(min_user: int, min_item: int, rounds: int = 20) -> str:
    ctes = [L_SQL, "K0 AS (SELECT * FROM L)"]
    for r in range(rounds):
        ctes.append(f"""K{r + 1} AS (SELECT * FROM K{r}
  WHERE userId IN (SELECT userId FROM K{r} GROUP BY userId HAVING count(*) >= {min_user})
    AND movieId IN (SELECT movieId FROM K{r} GROUP BY movieId HAVING count(*) >= {min_item}))""")
    return with_ctes(*ctes) + f"SELECT * FROM K{rounds}"


@query("kcore", _kcore_sql(*KCORE), "prep")
def kcore(spark, sf_dir):
    """K-core (users >= 25, items >= 18), Jacobi rounds, <= 20."""
    return P.kcore(interactions_L(spark, sf_dir), "userId", "movieId", *KCORE)


# -------------------------------------------------------------- profiling / checks

@query("dataset_stats", with_ctes(L_SQL) + """
SELECT count(*) AS n_rows, count(DISTINCT userId) AS n_users, count(DISTINCT movieId) AS n_items,
       1.0 - count(*) / (count(DISTINCT userId) * count(DISTINCT movieId)) AS sparsity FROM L""", "prep")
def dataset_stats(spark, sf_dir):
    """Rows, distinct users and items, sparsity."""
    return P.dataset_stats(interactions_L(spark, sf_dir)).withColumn("sparsity", r6("sparsity"))


def _profile_sql():
    cols = [("userId", "bigint"), ("movieId", "bigint"), ("event_timestamp", "timestamp_ntz"),
            ("rating", "double"), ("timestamp", "bigint")]
    parts = []
    for c, t in cols:
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) FILTER (WHERE "{c}" IS NULL) AS n_null,
  round(count(*) FILTER (WHERE "{c}" IS NULL) * 100.0 / count(*), 2) AS pct_null,
  count(DISTINCT "{c}") AS n_unique, coalesce(min(CAST("{c}" AS VARCHAR)), '') AS sample FROM L""")
    return with_ctes(L_SQL) + "\nUNION ALL\n".join(parts)


@query("column_profile", _profile_sql(), "prep")
def column_profile(spark, sf_dir):
    """Dtype, nulls, % null, distinct count and a sample per column."""
    return P.column_profile(interactions_L(spark, sf_dir))


def _describe_sql():
    parts = []
    for c, src in (("rating", "L"), ("timestamp", "L"), ("value", "events")):
        std = f'stddev_samp("{c}")'
        if c == "timestamp":  # integers: exact sums of the distances from the least value
            d = f'("{c}" - (SELECT min("{c}") FROM {src}))::HUGEINT'
            std = f'sqrt((count("{c}") * sum({d} * {d}) - sum({d}) * sum({d}))::DOUBLE / (count("{c}") * (count("{c}") - 1))::DOUBLE)'
        parts.append(f"""SELECT '{c}' AS "column", count("{c}") AS count, round(avg("{c}"), 6) AS mean,
  round({std}, 6) AS std, min("{c}")::DOUBLE AS min, round(quantile_cont("{c}", 0.25), 6) AS p25,
  round(quantile_cont("{c}", 0.5), 6) AS p50, round(quantile_cont("{c}", 0.75), 6) AS p75,
  max("{c}")::DOUBLE AS max FROM {src}""")
    return with_ctes(L_SQL) + "\nUNION ALL\n".join(parts)


@query("describe_numeric", _describe_sql(), "prep")
def describe_numeric(spark, sf_dir):
    """describe() of interaction rating/time and event value."""
    a = P.describe_numeric(interactions_L(spark, sf_dir), ["rating", "timestamp"])
    b = P.describe_numeric(table(spark, sf_dir, "events", ["value"]), ["value"])
    out = a.unionByName(b)
    return out.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "p25", "p50", "p75")],
                      "min", "max")


@query("contract_checks", with_ctes(L_SQL, ITEMS_SQL) + """
SELECT count(*) FILTER (WHERE coalesce(L.userId IS NULL OR L.movieId IS NULL, TRUE)) AS null_key,
       count(*) FILTER (WHERE coalesce(ITEMS.title IS NULL, TRUE)) AS missing_title,
       count(*) FILTER (WHERE coalesce(NOT (L.rating BETWEEN 0.5 AND 5.0), TRUE)) AS rating_out_of_range,
       count(*) FILTER (WHERE coalesce(L.event_timestamp < TIMESTAMP '1995-06-01', TRUE)) AS before_window
FROM L LEFT JOIN ITEMS ON L.movieId = ITEMS.movieId""", "prep")
def contract_checks(spark, sf_dir):
    """Violation counts per rule in one aggregate pass."""
    df = P.join_metadata(interactions_L(spark, sf_dir), items_part(spark, sf_dir))
    return P.contract_checks(df, {
        "null_key": F.col("userId").isNull() | F.col("movieId").isNull(),
        "missing_title": F.col("title").isNull(),
        "rating_out_of_range": ~F.col("rating").between(0.5, 5.0),
        "before_window": F.col("event_timestamp") < F.lit("1995-06-01 00:00:00").cast("timestamp_ntz"),
    })


@query("key_uniqueness", """
SELECT o.o_custkey::BIGINT AS userId, li.l_partkey::BIGINT AS movieId, li.l_shipdate AS event_timestamp, count(*) AS n
FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey
GROUP BY 1, 2, 3 HAVING count(*) > 1""", "prep")
def key_uniqueness(spark, sf_dir):
    """Duplicate (user, item, instant) keys in the raw joined rows."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_shipdate"])
    od = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    raw = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast("long").alias("userId"), F.col("l_partkey").cast("long").alias("movieId"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("event_timestamp"))
    return P.key_duplicates(raw, ["userId", "movieId", "event_timestamp"])


@query("hash_shuffle", with_ctes(L_SQL) + f"""
SELECT *, {_md5_key("'42'", "userId", "movieId", '"timestamp"')} AS shuffle_key FROM L""", "prep")
def hash_shuffle(spark, sf_dir):
    """Seeded permutation key (seed 42) over the full interaction table."""
    return P.hash_shuffle(interactions_L(spark, sf_dir), 42, ["userId", "movieId", "timestamp"])


@query("hash_sample_users", with_ctes(L_SQL) + f"""
SELECT userId, {_md5_key("'7'", "userId")} AS sample_key FROM (SELECT DISTINCT userId FROM L)
ORDER BY sample_key, userId LIMIT 100""", "prep")
def hash_sample_users(spark, sf_dir):
    """100 users drawn with seed 7 (a sampling operator; the limit is the feature)."""
    return P.hash_sample(interactions_L(spark, sf_dir), "userId", 100, 7)


@query("join_metadata", with_ctes(L_SQL, ITEMS_SQL) + """
SELECT L.*, ITEMS.title, ITEMS.genres FROM L LEFT JOIN ITEMS ON L.movieId = ITEMS.movieId""", "prep")
def join_metadata(spark, sf_dir):
    """Interactions left-joined to the item dimension."""
    return P.join_metadata(interactions_L(spark, sf_dir), items_part(spark, sf_dir))
