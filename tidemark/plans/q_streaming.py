"""Streaming queries: each writes slices of the given tables to a fresh
folder under the shared checkpoint dir, runs the stream with ``availableNow``
and returns the sink's final table.  Slices arrive newest first (and one is
delivered twice) to exercise event-time merging and dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import prep as P
from ..operators import temporal as T
from ..session import scratch_path
from ..sources.adapters import E_SQL, L_SQL, interactions_E, interactions_L, table
from ..streaming import cdc as C
from .q_temporal import user_stats_sql
from .registry import query, with_ctes

SLICES = 3
LATENESS = "45 days"  # the arrival files bring a month newest first
BUCKETS = 16


def _bodies(spark, sf_dir):
    """CDC message bodies built from the event table, one form per event type:
    view/purchase -> JSON envelope, click -> bare row, signup -> base64
    envelope, error -> a truncated (unparseable) message."""
    ev = table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props", "value", "ts"])
    data = F.struct(F.col("user_id").cast("string").alias("userId"),
                    F.get_json_object("props", "$.k").alias("movieId"),
                    F.col("value").cast("string").alias("rating"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    op = F.when(F.col("event_type") == "purchase", F.lit("update")).otherwise(F.lit("insert"))
    env = F.to_json(F.struct(data.alias("data"), F.struct(op.alias("operation")).alias("metadata")))
    body = (F.when(F.col("event_type").isin("view", "purchase"), env)
             .when(F.col("event_type") == "click", F.to_json(data))
             .when(F.col("event_type") == "signup", F.base64(env))
             .otherwise(F.substring(env, 1, 20)))
    return ev.select("event_id", "ts", body.alias("body"))


_CDC_OK_SQL = """
SELECT event_id, user_id::BIGINT AS userId, json_extract_string(props, '$.k')::BIGINT AS movieId, value::DOUBLE AS rating,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", (epoch_us(ts) // 1000000)::BIGINT AS ts_unix,
       CASE event_type WHEN 'purchase' THEN 'update' WHEN 'click' THEN NULL ELSE 'insert' END AS operation
FROM events WHERE event_type <> 'error'"""


@query("cdc_parse", _CDC_OK_SQL, "streaming")
def cdc_parse(spark, sf_dir):
    """Decode envelope, bare-row and base64 bodies."""
    out = C.parse_cdc(_bodies(spark, sf_dir))
    return out.where("ok").select("event_id", "userId", "movieId", "rating", "timestamp", "ts_unix", "operation")


@query("cdc_dead_letter", "SELECT event_id, 'unparseable' AS reason FROM events WHERE event_type = 'error'", "streaming")
def cdc_dead_letter(spark, sf_dir):
    """Malformed messages split off with a reason."""
    out = C.parse_cdc(_bodies(spark, sf_dir))
    return out.where(~F.col("ok")).select("event_id", F.lit("unparseable").alias("reason"))


def _slice(df, ts_col: str, n: int = SLICES):
    """Slice ids 0..n-1 by event time (day of month buckets), for arrival files."""
    day = F.dayofmonth(ts_col)
    return df.withColumn("_slice", F.least(F.floor((day - 1) * n / 31), F.lit(n - 1)).cast("int"))


def _write_event_files(spark, sf_dir, fmt: str = "csv"):
    """E rows as arrival files: newest slice first, the oldest slice twice."""
    src = interactions_E(spark, sf_dir).select(
        "userId", "movieId", "rating", F.unix_micros(F.col("event_timestamp").cast("timestamp")).alias("ts_us"),
        "event_timestamp")
    src = _slice(src, "event_timestamp").drop("event_timestamp")
    path = scratch_path(spark, "arrivals")
    for i in list(range(SLICES - 1, -1, -1)) + [0]:
        part = src.where(F.col("_slice") == i).drop("_slice")
        if fmt == "csv":
            part.write.mode("append").option("header", True).csv(path)
        else:
            part.write.mode("append").parquet(path)
    return path


def _read_events_stream(spark, path):
    """The arrivals as a stream, about one arrival a batch, in however many files it
    came: what a batch costs apart from its rows (state, touched buckets) is then
    not paid once for each file."""
    files = max(1, -(-len(C.list_files(spark, path, ".csv")) // (SLICES + 1)))
    s = (spark.readStream.schema("userId long, movieId long, rating double, ts_us long")
         .option("header", True).option("maxFilesPerTrigger", files).csv(path))
    return s.withColumn("event_timestamp", F.timestamp_micros("ts_us").cast("timestamp_ntz")).drop("ts_us")


@query("stream_cdc_csv", with_ctes(E_SQL) + "SELECT userId, movieId, rating, event_timestamp FROM E", "streaming")
def stream_cdc_csv(spark, sf_dir):
    """CSV change files read as a stream (dedup of redelivered rows within the watermark)."""
    src = _write_event_files(spark, sf_dir)
    out = scratch_path(spark, "cdc-out")
    s = C.without_redelivered(_read_events_stream(spark, src), LATENESS)
    C.run_available(s.writeStream.format("parquet").option("path", out)
                    .option("checkpointLocation", scratch_path(spark, "ckpt")))
    return spark.read.parquet(out)


@query("stream_user_sequence", with_ctes(E_SQL, """R AS (
  SELECT userId, movieId, event_timestamp, epoch_us(event_timestamp) AS us,
         row_number() OVER (PARTITION BY userId ORDER BY event_timestamp DESC, movieId DESC) AS rk FROM E)""", """G AS (
  SELECT userId, max(event_timestamp) AS event_timestamp, list(movieId ORDER BY us, movieId) AS items,
         list(us ORDER BY us, movieId) AS uss FROM R WHERE rk <= 10 GROUP BY userId)""") + """
SELECT userId, event_timestamp, array_to_string(list_transform(items, lambda x: x::VARCHAR), ',') AS user_rating_list_10_recent_movie,
       array_to_string(list_transform(uss, lambda x: strftime(make_timestamp(x), '%Y-%m-%dT%H:%M:%S.%fZ')), ',')
         AS user_rating_list_10_recent_movie_timestamp,
       list_concat(list_transform(range(10 - len(uss)), lambda x: -1::BIGINT), list_transform(uss, lambda x: x // 1000000))
         AS item_sequence_ts,
       list_concat(list_transform(range(10 - len(uss)), lambda x: -1::BIGINT),
                   list_transform(uss, lambda x: CASE """ + " ".join(
    f"WHEN uss[-1] // 1000000 - x // 1000000 < {e} THEN {i}" for i, e in enumerate(
        [600, 3600, 86400, 604800, 2592000, 31536000, 94608000, 157680000, 315360000])) + """ ELSE 9 END)) AS item_sequence_ts_bucket
FROM G""", "streaming")
def stream_user_sequence(spark, sf_dir):
    """Stateful last-10 per user (event-time merge, redelivery-safe),
    upserted into a bucketed online table by foreachBatch."""
    src = _write_event_files(spark, sf_dir)
    snap = scratch_path(spark, "user-seq")
    st = C.user_sequence_state(_read_events_stream(spark, src), LATENESS, ttl_days=30)
    C.run_available(st.writeStream.outputMode("update").foreachBatch(C.upsert_bucketed(snap, ["userId"], C.merge_sequences(), BUCKETS))
                    .option("checkpointLocation", scratch_path(spark, "ckpt")))
    return C.sequence_features(C.read_bucketed(spark, snap))


@query("stream_online_snapshot", with_ctes(E_SQL) + """
SELECT userId, arg_max(movieId, event_timestamp) AS movieId, arg_max(rating, event_timestamp) AS rating,
       max(event_timestamp) AS event_timestamp FROM E GROUP BY userId""", "streaming")
def stream_online_snapshot(spark, sf_dir):
    """Keyed latest-row upsert of every user's newest event."""
    src = _write_event_files(spark, sf_dir)
    snap = scratch_path(spark, "online")
    C.run_available(_read_events_stream(spark, src).writeStream
                    .foreachBatch(C.upsert_bucketed(snap, ["userId"], C.latest_row(["userId"], "event_timestamp"), BUCKETS))
                    .option("checkpointLocation", scratch_path(spark, "ckpt")))
    return C.read_bucketed(spark, snap).select("userId", "movieId", "rating", "event_timestamp")


@query("stream_dead_letter", "SELECT event_id, 'unparseable' AS reason FROM events WHERE event_type = 'error'",
       "streaming")
def stream_dead_letter(spark, sf_dir):
    """Good and bad messages to two sinks from one foreachBatch; returns the dead letters."""
    src = scratch_path(spark, "bodies")
    _bodies(spark, sf_dir).write.parquet(src)
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")

    def sink(batch, batch_id):
        p = C.parse_cdc(batch).persist()
        p.where("ok").drop("ok").write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
        p.where(~F.col("ok")).select("event_id", "body", F.lit("unparseable").alias("reason")) \
            .write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")
        p.unpersist()
    s = spark.readStream.schema("event_id long, ts timestamp_ntz, body string").option("maxFilesPerTrigger", 2) \
        .parquet(src)
    C.run_available(s.writeStream.foreachBatch(sink).option("checkpointLocation", scratch_path(spark, "ckpt")))
    return spark.read.option("basePath", bad).parquet(bad).select("event_id", "reason")


@query("stream_replay_counts", with_ctes(L_SQL, """HC AS (
  SELECT date_trunc('day', max(event_timestamp) - INTERVAL 30 DAY) AS cut FROM L)""") + """
SELECT CAST(event_timestamp AS DATE) AS day, count(*) AS n_rows FROM L, HC WHERE event_timestamp >= HC.cut GROUP BY 1""",
       "streaming")
def stream_replay_counts(spark, sf_dir):
    """The holdout replayed file by file (one day per file) into an
    empty mirror of the interaction table; counts per replayed day."""
    L = interactions_L(spark, sf_dir).select("userId", "movieId", "rating", "event_timestamp")
    _, hold = P.holdout_split(L, "event_timestamp", 30)
    src, mirror = scratch_path(spark, "holdout"), scratch_path(spark, "mirror")
    hold.withColumn("day", F.to_date("event_timestamp")).repartition("day").sortWithinPartitions("event_timestamp") \
        .write.partitionBy("day").parquet(src)
    spark.createDataFrame([], L.schema).write.parquet(mirror)         # S10: empty mirror, same schema
    s = spark.readStream.schema(L.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    C.run_available(s.writeStream.format("parquet").option("path", mirror)
                    .option("checkpointLocation", scratch_path(spark, "ckpt")))
    m = spark.read.schema(L.schema).parquet(mirror)
    return m.groupBy(F.to_date("event_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("stream_user_stats", with_ctes(E_SQL.replace("value::DOUBLE", "value::DECIMAL(12,2)"), user_stats_sql("E")) + """
SELECT userId, max(event_timestamp) AS event_timestamp,
       arg_max(user_rating_cnt_90d, event_timestamp) AS user_rating_cnt_90d,
       arg_max(user_rating_avg_prev_rating_90d, event_timestamp) AS user_rating_avg_prev_rating_90d
FROM USB GROUP BY userId""", "streaming")
def stream_user_stats(spark, sf_dir):
    """Per micro-batch, append to history and recompute the 90-day
    count/avg of the touched users only; upsert their latest row."""
    src = _write_event_files(spark, sf_dir)
    hist, snap = scratch_path(spark, "history"), scratch_path(spark, "user-stats")

    def refresh(batch, batch_id):
        spark_ = batch.sparkSession
        batch.dropDuplicates(["userId", "movieId", "event_timestamp"]).write.mode("overwrite").parquet(f"{hist}/batch={batch_id}")
        h = spark_.read.option("basePath", hist).parquet(hist).where(F.col("batch") <= batch_id).drop("batch")
        touched = h.join(batch.select("userId").distinct(), "userId", "left_semi") \
            .dropDuplicates(["userId", "movieId", "event_timestamp"]).withColumn("rating", F.col("rating").cast("decimal(12,2)"))
        st = T.user_rating_stats(touched)
        return P.dedup(st.select("userId", "movieId", "event_timestamp", "user_rating_cnt_90d",
                                 "user_rating_avg_prev_rating_90d"), ["userId"], ["event_timestamp"], "last") \
            .drop("movieId")
    C.run_available(_read_events_stream(spark, src).writeStream
                    .foreachBatch(C.upsert_bucketed(snap, ["userId"], C.latest_row(["userId"], "event_timestamp"), BUCKETS, refresh))
                    .option("checkpointLocation", scratch_path(spark, "ckpt")))
    out = C.read_bucketed(spark, snap)
    return out.select("userId", "event_timestamp", "user_rating_cnt_90d",
                      r6("user_rating_avg_prev_rating_90d").alias("user_rating_avg_prev_rating_90d"))


@query("stream_drift", None, "streaming")
def stream_drift(spark, sf_dir):
    """Count-triggered KS drift checks of arriving ratings against the
    first 20 days (rows-only: one result row per triggered check)."""
    src = _write_event_files(spark, sf_dir)
    ref = interactions_E(spark, sf_dir).where(F.col("event_timestamp") < F.lit("2024-01-21").cast("timestamp_ntz"))
    buf, res = scratch_path(spark, "drift-buf"), scratch_path(spark, "drift-res")
    C.run_available(_read_events_stream(spark, src).writeStream
                    .foreachBatch(C.drift_trigger_sink(buf, res, ref, "rating", min_rows=10))
                    .option("checkpointLocation", scratch_path(spark, "ckpt")))
    return spark.read.option("basePath", res).parquet(res).select("batch_id", "n_rows", r6("ks_d").alias("ks_d"),
                                                                  "drifted")
