"""Change-stream jobs (S14-S16, R1-R10) on Structured Streaming.

* :func:`parse_cdc` decodes message bodies: a JSON envelope
  ``{"data": {...}, "metadata": {"operation": ..}}``, a bare JSON row, or a
  base64-encoded envelope; anything else goes to the dead-letter output.
* :func:`user_sequence_state` keeps each user's last 10 (time, item) pairs in
  Spark state with ``applyInPandasWithState``.  Events are merged by *event
  time* with redelivered duplicates dropped, so the state equals the batch
  result whatever the arrival order (unlike appending in arrival order).
* :func:`upsert_bucketed` is the ``foreachBatch`` sink: a batch rewrites only the
  key buckets that it touches, and a manifest named by the batch id says which
  files are current, so a replayed batch changes nothing.
  :func:`upsert_versioned` is the simpler form that rewrites a small snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import PAD, bucket_list, iso_micros, lag_bucket, pad_left

CDC_ROW = T.StructType([
    T.StructField("userId", T.StringType()), T.StructField("movieId", T.StringType()),
    T.StructField("rating", T.StringType()), T.StructField("timestamp", T.StringType())])
CDC_ENVELOPE = T.StructType([
    T.StructField("data", CDC_ROW),
    T.StructField("metadata", T.StructType([T.StructField("operation", T.StringType())]))])
INTERACTION_CSV = "userId long, movieId long, rating double, event_timestamp timestamp_ntz"

SEQ_LEN = 10


def parse_cdc(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Decode message bodies; adds ``ok`` (all fields valid).

    Output columns: userId, movieId, rating (typed; NULL when invalid),
    ``timestamp`` (text as sent), ``ts_unix`` (epoch seconds or -1),
    ``operation``, ``ok``."""
    b = F.col(body_col)
    text = F.when(F.trim(b).startswith("{"), b).otherwise(F.expr(f"try_to_binary({body_col}, 'base64')").cast("string"))
    env = F.from_json(text, CDC_ENVELOPE)
    row = F.from_json(text, CDC_ROW)
    d = F.when(env["data"].isNotNull(), env["data"]).otherwise(row)
    parsed = bodies.select("*", d.alias("_d"), env["metadata"]["operation"].alias("operation"))
    uid = F.expr("try_cast(_d.userId as bigint)")
    mid = F.expr("try_cast(_d.movieId as bigint)")
    rat = F.expr("try_cast(_d.rating as double)")
    ts = F.expr("try_to_timestamp(_d.timestamp)")
    out = parsed.select(*bodies.columns, uid.alias("userId"), mid.alias("movieId"), rat.alias("rating"),
                        F.col("_d.timestamp").alias("timestamp"),
                        F.coalesce(F.unix_seconds(ts), F.lit(-1).cast("long")).alias("ts_unix"), "operation")
    return out.withColumn("ok", F.col("userId").isNotNull() & F.col("movieId").isNotNull()
                          & F.col("rating").isNotNull() & (F.col("ts_unix") >= 0))


# ----------------------------------------------------------------- state

STATE_SCHEMA = "ts_us array<long>, items array<long>"
STATE_OUT = "userId long, ts_us array<long>, items array<long>"


def _merge_last_n(key, pdfs, state, ttl_ms):
    """applyInPandasWithState function: merge new events into the kept
    (time, item) list by event time, drop exact repeats, keep the newest 10; a
    user's state goes when the watermark passes the newest event by ``ttl_ms``."""
    import pandas as pd
    if state.hasTimedOut:
        state.remove()
        return
    pairs = list(zip(*state.get)) if state.exists else []
    for pdf in pdfs:
        pairs.extend(zip(pdf["ts_us"].astype("int64").tolist(), pdf["movieId"].astype("int64").tolist()))
        pairs = sorted(set(pairs))[-SEQ_LEN:]
    state.update(([p[0] for p in pairs], [p[1] for p in pairs]))
    if ttl_ms is not None:
        state.setTimeoutTimestamp(max(pairs[-1][0] // 1000, state.getCurrentWatermarkMs()) + ttl_ms)
    yield pd.DataFrame({"userId": [key[0]], "ts_us": [[p[0] for p in pairs]], "items": [[p[1] for p in pairs]]})


def without_redelivered(events: DataFrame, lateness: str, keys=("userId", "movieId"), ts_col: str = "event_timestamp") -> DataFrame:
    """Change records without redelivered copies: a copy is dropped if it comes
    within ``lateness`` of event time; keys older than that leave the state, and
    records that late are dropped."""
    return (events.withColumn("_et", F.col(ts_col).cast("timestamp")).withWatermark("_et", lateness)
            .dropDuplicatesWithinWatermark([*keys, "_et"]).drop("_et"))


def user_sequence_state(events: DataFrame, watermark: str | None = None, ttl_days: int | None = None) -> DataFrame:
    """R2: streaming per-user last-10 state (update mode).

    With ``watermark`` (the lateness that is allowed) redelivered records are
    dropped by the merge, and with ``ttl_days`` the state of a user goes that
    long after the newest event, so the state holds the active users only; the
    sink that merges sequences (:func:`merge_sequences`) still has the others."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    src = events.select("userId", "movieId", "event_timestamp",
                        F.unix_micros(F.col("event_timestamp").cast("timestamp")).alias("ts_us"))
    if ttl_days is not None and not watermark:
        raise ValueError("ttl_days needs a watermark")
    if watermark:
        src = src.withColumn("_et", F.col("event_timestamp").cast("timestamp")).withWatermark("_et", watermark)
    ttl_ms = None if ttl_days is None else ttl_days * 86_400_000
    return src.groupBy("userId").applyInPandasWithState(
        lambda key, pdfs, state: _merge_last_n(key, pdfs, state, ttl_ms), STATE_OUT, STATE_SCHEMA, "update",
        GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.EventTimeTimeout)


def sequence_features(state_rows: DataFrame) -> DataFrame:
    """R3 (Q17 ``as_of_latest``): recent lists, padded epoch seconds and lag
    buckets relative to the newest kept event (its bucket is always 0)."""
    secs = F.transform("ts_us", lambda x: F.floor(x / 1_000_000).cast("long"))
    seq = pad_left(secs, SEQ_LEN)
    newest = F.element_at(secs, -1)
    return state_rows.select(
        "userId", F.timestamp_micros(F.element_at("ts_us", -1)).cast("timestamp_ntz").alias("event_timestamp"),
        F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("user_rating_list_10_recent_movie"),
        F.array_join(F.transform("ts_us", lambda x: iso_micros(F.timestamp_micros(x))), ",")
         .alias("user_rating_list_10_recent_movie_timestamp"),
        seq.alias("item_sequence_ts"), bucket_list(seq, newest).alias("item_sequence_ts_bucket"))


# ----------------------------------------------------------------- sinks

def upsert_versioned(snapshot_dir: str, keys, ts_col: str, transform=None, tie=()):
    """S16/R4 foreachBatch sink: keyed latest-row upsert into versioned parquet.
    Rows are ordered by (``ts_col``, batch id, ``tie`` columns): on equal event
    time the later batch wins, inside a batch the greatest tie, or without tie
    columns the greatest row, so a replay picks the same row.  ``transform(batch, batch_id)`` may prepare the batch first."""
    def sink(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        if transform is not None:
            batch = transform(batch, batch_id)
        batch = batch.withColumn("_batch", F.lit(batch_id).cast("long"))
        prev = latest_version(spark, snapshot_dir, before=batch_id)
        cur = batch
        if prev is not None:
            old = spark.read.parquet(prev)
            cur = old.unionByName(batch.select(*old.columns))
        rest = [c for c in cur.columns if c not in keys]
        out = cur.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts_col, "_batch", *(tie or rest))).alias("_v")) \
            .select(*keys, "_v.*")
        out.write.mode("overwrite").parquet(f"{snapshot_dir}/v={batch_id:012d}")
    return sink


def latest_row(keys, ts_col: str, tie=()):
    """Merge of a bucketed upsert: the row of the greatest (``ts_col``, batch id,
    ``tie`` columns or the whole row) of each key."""
    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts_col, "_batch", *(tie or rest))).alias("_v")).select(*keys, "_v.*")
    return merge


def merge_sequences(key: str = "userId", n: int = SEQ_LEN):
    """Merge of a bucketed upsert: the newest ``n`` different (ts_us, items) pairs
    of all lists of a key; at most one list of a batch and the stored one meet."""
    def merge(rows: DataFrame) -> DataFrame:
        pairs = F.explode(F.arrays_zip("ts_us", "items")).alias("p")
        newest = F.slice(F.sort_array(F.collect_set("p"), asc=False), 1, n)
        g = rows.select(key, "_batch", pairs).groupBy(key).agg(F.max("_batch").alias("_batch"), F.reverse(newest).alias("l"))
        return g.select(key, F.transform("l", lambda x: x["ts_us"]).alias("ts_us"), F.transform("l", lambda x: x["items"]).alias("items"), "_batch")
    return merge


def upsert_bucketed(root: str, keys, merge, buckets: int = 64, transform=None):
    """S16/R4 foreachBatch sink: a keyed table in ``buckets`` buckets of the keys'
    hash, of which a batch rewrites only those that it touches.

    ``merge(rows)`` combines a bucket's stored rows with the batch's (both have
    ``_batch``).  A batch writes ``data/batch=N/bucket=K`` and then the manifest
    ``manifest/v=N`` that names the batch of every bucket, so readers see all of
    a batch or nothing.  A replayed batch starts from the manifest before it and
    writes the same files again.  Bucket files that neither this manifest nor the
    one before names are deleted."""
    def sink(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        if transform is not None:
            batch = transform(batch, batch_id)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        batch = batch.withColumn("_batch", F.lit(batch_id).cast("long")).withColumn("bucket", bucket).persist()
        touched = {r["bucket"] for r in batch.select("bucket").distinct().collect()}  # at most ``buckets``
        old = _manifest(spark, root, before=batch_id)
        stored = _read_buckets(spark, root, {b: v for b, v in old.items() if b in touched})
        rows = batch if stored is None else stored.unionByName(batch.select(*stored.columns))
        if touched:
            out = merge(rows.drop("bucket"))
            out.withColumn("bucket", bucket).repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/batch={batch_id}")
        batch.unpersist()
        new = old | dict.fromkeys(touched, batch_id)
        spark.createDataFrame(sorted(new.items()), "bucket int, batch long").coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v={batch_id:012d}")
        _drop_unnamed(spark, root, {*old.items(), *new.items()})
    return sink


def _manifest(spark: SparkSession, root: str, before: int | None = None) -> dict:
    path = latest_version(spark, f"{root}/manifest", before)
    return {r["bucket"]: r["batch"] for r in spark.read.schema("bucket int, batch long").parquet(path).collect()} if path else {}


def _read_buckets(spark: SparkSession, root: str, named: dict) -> DataFrame | None:
    if not named:
        return None
    paths = [f"{root}/data/batch={v}/bucket={b}" for b, v in sorted(named.items())]
    return spark.read.option("basePath", f"{root}/data").parquet(*paths).drop("batch").withColumn("bucket", F.col("bucket").cast("int"))


def _drop_unnamed(spark: SparkSession, root: str, named: set) -> None:
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for batch in list_dirs(spark, f"{root}/data"):
        v = int(batch.rsplit("=", 1)[1])
        for d in list_dirs(spark, batch):
            if "bucket=" in d and (int(d.rsplit("=", 1)[1]), v) not in named:
                p = fs_path(d)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_bucketed(spark: SparkSession, root: str) -> DataFrame | None:
    """The current rows of a bucketed table, None before its first batch with rows."""
    df = _read_buckets(spark, root, _manifest(spark, root))
    return None if df is None else df.drop("bucket", "_batch")


def list_dirs(spark: SparkSession, path: str) -> list:
    """Child directories of ``path`` through the Hadoop FileSystem API, so the
    same code works on HDFS, S3 or ABFS."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list:
    """Files directly in ``path`` whose name ends in ``suffix``, as :func:`list_dirs`."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f for f in (st.getPath().toString() for st in fs.listStatus(p) if st.isFile()) if f.endswith(suffix)]


def _committed(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def latest_version(spark: SparkSession, snapshot_dir: str, before: int | None = None) -> str | None:
    """Newest committed snapshot version (optionally older than ``before``)."""
    vs = sorted(d for d in list_dirs(spark, snapshot_dir) if "/v=" in d and _committed(spark, d))
    if before is not None:
        vs = [d for d in vs if int(d.rsplit("=", 1)[1]) < before]
    return vs[-1] if vs else None


def run_available(query_builder) -> None:
    """Run a stream with ``availableNow`` to completion (tests, backfills)."""
    q = query_builder.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def read_stream_csv(spark: SparkSession, path: str, schema: str = INTERACTION_CSV, max_files: int | None = None,
                    max_bytes: int | None = None, start: str | None = None, newest_first: bool = False) -> DataFrame:
    """CSV folder as a stream (explicit schema, header row).  Rate: at most
    ``max_files`` files or ``max_bytes`` bytes a batch.  Start: events from
    ``start`` (ISO time) on; the backlog by age or newest first."""
    if max_files and max_bytes:
        raise ValueError("max_files or max_bytes, not both")
    r = spark.readStream.schema(schema).option("header", True).option("latestFirst", newest_first)
    for name, value in (("maxFilesPerTrigger", max_files), ("maxBytesPerTrigger", max_bytes)):
        if value:
            r = r.option(name, value)
    df = r.csv(path)
    return df.where(F.col("event_timestamp") >= F.lit(start).cast("timestamp_ntz")) if start else df


def drift_trigger_sink(buffer_dir: str, results_dir: str, reference: DataFrame, col: str, min_rows: int = 10):
    """foreachBatch that appends each batch to a buffer and, once the rows
    buffered since the last check reach ``min_rows``, runs a KS drift check
    against ``reference`` and records it.  The buffer position is derived
    from the recorded results, so a replayed batch sees the same state."""
    from ..operators.metrics import ks

    def sink(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{buffer_dir}/batch={batch_id}")
        done = [int(d.rsplit("=", 1)[1]) for d in list_dirs(spark, results_dir) if "batch=" in d
                and _committed(spark, d)]
        last = max([b for b in done if b < batch_id], default=-1)
        buf = spark.read.option("basePath", buffer_dir).parquet(buffer_dir) \
            .where((F.col("batch") > last) & (F.col("batch") <= batch_id))
        n = buf.count()
        if n >= min_rows:
            res = ks(reference, buf, col).select(F.lit(batch_id).alias("batch_id"), F.lit(n).alias("n_rows"),
                                                 "ks_d", "drifted")
            res.write.mode("overwrite").parquet(f"{results_dir}/batch={batch_id}")
    return sink
