"""Bucketed upserts, and state that forgets: late, redelivered and returning users."""

import os

from pyspark.sql import functions as F

from tidemark.streaming import cdc as C

ROW = "userId long, event_timestamp timestamp_ntz, v long"


def batch(spark, rows):
    return spark.createDataFrame([(u, t, v) for u, t, v in rows], "userId long, t long, v long").select(
        "userId", F.timestamp_seconds("t").cast("timestamp_ntz").alias("event_timestamp"), "v")


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root + "/data") for f in names if f.endswith(".parquet")}


def test_bucketed_upsert(spark, tmp_path):
    root = str(tmp_path / "t")
    sink = C.upsert_bucketed(root, ["userId"], C.latest_row(["userId"], "event_timestamp"), buckets=8)
    now = lambda: sorted((r.userId, r.v) for r in C.read_bucketed(spark, root).collect())
    assert C.read_bucketed(spark, root) is None
    sink(batch(spark, []), 0)
    assert C.read_bucketed(spark, root) is None
    sink(batch(spark, [(u, 10, u) for u in range(40)] + [(None, 10, -1)]), 1)
    first = now_null = {r.userId: r.v for r in C.read_bucketed(spark, root).collect()}
    assert first == {**{u: u for u in range(40)}, None: -1} and now_null
    before = files(root)
    two = batch(spark, [(3, 20, 300), (3, 5, 1), (3, 20, 299)])  # newer, older, and a tie in time
    sink(two, 2)
    kept = files(root) & before
    assert len(before - kept) == 0 and len(files(root) - before) == 1  # one bucket rewritten; the manifest before still stands
    want = {**first, 3: 300}
    for _ in range(2):  # a replay changes nothing
        assert {r.userId: r.v for r in C.read_bucketed(spark, root).collect()} == want
        sink(two, 2)
    sink(batch(spark, [(3, 19, 7)]), 3)
    assert {r.userId: r.v for r in C.read_bucketed(spark, root).collect()} == want
    assert not any("batch=1/" in f and f in before - kept for f in files(root))
    assert len({f for f in files(root) if "batch=1/" in f}) < len(before)  # the version that two manifests left behind is gone


def test_state_forgets_and_the_table_remembers(spark, tmp_path):
    """Users come back after their state has gone, records are redelivered and
    late; the table equals the newest ten pairs of all records."""
    day, src = 86_400, str(tmp_path / "in")
    feeds = [[(1, i, i * day) for i in range(8)] + [(2, 50, 2 * day)],
             [(1, i, i * day) for i in range(4)] + [(1, 100, 3 * day + 5), (2, 51, 30 * day)],  # again, late, and time goes on
             [(2, 52, 60 * day), (2, 51, 30 * day)],
             [(1, 200 + i, (61 + i) * day) for i in range(5)]]  # after 1's state has gone
    out = str(tmp_path / "t")
    sink = C.upsert_bucketed(out, ["userId"], C.merge_sequences(), buckets=4)
    schema = "userId long, movieId long, event_timestamp timestamp_ntz"
    os.makedirs(src)
    for i, rows in enumerate(feeds):
        part = str(tmp_path / f"p{i}")
        spark.createDataFrame(rows, "userId long, movieId long, t long").select(
            "userId", "movieId", F.timestamp_seconds("t").cast("timestamp_ntz").alias("event_timestamp")).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.rename(f"{part}/{name}", f"{src}/{i}.parquet")
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        st = C.user_sequence_state(s, "20 days", ttl_days=5)
        C.run_available(st.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", str(tmp_path / "ckpt")))
    got = {r.userId: list(zip(r.ts_us, r["items"])) for r in C.read_bucketed(spark, out).collect()}
    every = {(u, t * 1_000_000, m) for rows in feeds for u, m, t in rows}
    for u in (1, 2):
        assert got[u] == sorted((t, m) for w, t, m in every if w == u)[-10:]


def test_rate_and_start_options(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(3):
        spark.createDataFrame([(i, i, 1.0, f"2024-01-0{i + 1}T00:00:00")], "userId long, movieId long, rating double, event_timestamp string").coalesce(1) \
            .write.mode("append").option("header", True).csv(src)
    for options, n in (({"max_files": 1}, 3), ({"max_bytes": 1 << 30}, 3), ({"start": "2024-01-02T00:00:00"}, 2), ({"newest_first": True}, 3)):
        out = str(tmp_path / f"out{len(os.listdir(tmp_path))}")
        C.run_available(C.read_stream_csv(spark, src, **options).writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-c"))
        got = spark.read.schema("userId long").parquet(out).count() if os.path.isdir(out) else 0
        assert got == n, options


def test_arrivals_are_batches_whatever_their_files(spark, tmp_path):
    """F16: the number of batches is that of the arrivals, not of their files."""
    from tidemark.plans import q_streaming as Q
    rows = spark.range(120).selectExpr("id % 7 userId", "id movieId", "1.0D rating", "id * 1000000 ts_us")
    src, seen = str(tmp_path / "in"), []
    for _ in range(Q.SLICES + 1):
        rows.repartition(5).write.mode("append").option("header", True).csv(src)
    s = Q._read_events_stream(spark, src).writeStream.foreachBatch(lambda b, _: seen.append(b.count()))
    C.run_available(s.option("checkpointLocation", str(tmp_path / "ckpt")))
    assert seen == [120] * (Q.SLICES + 1)
