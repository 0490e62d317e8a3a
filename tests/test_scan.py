"""Scans of hot keys in segments against the plain windows and plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scan as S
from tidemark.operators import temporal as T

ROWS = "userId long, movieId long, event_timestamp timestamp_ntz, rating double"


@pytest.fixture()
def many_parts(spark):
    names = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield spark
    for n, v in old.items():
        spark.conf.set(n, v)


def events(spark, n=400, keys=(1,), days=1, seed=1):
    """``n`` events, most of them of one key, within ``days`` days; some of equal time."""
    r = random.Random(seed)
    rows = [(r.choice(keys) if r.random() < 0.2 else keys[0], k, r.randrange(days * 1440), r.choice([None, 1.0, 2.5, 4.0])) for k in range(n)]
    df = spark.createDataFrame(rows, "userId long, movieId long, m long, rating double")
    return df.select("userId", "movieId", F.timestamp_seconds(F.col("m") * 60).cast("timestamp_ntz").alias("event_timestamp"), "rating")


def same(a, b):
    assert a.columns == b.columns
    x, y = (sorted(map(tuple, df.collect()), key=repr) for df in (a, b))
    assert x == y and x


@pytest.mark.parametrize("days,keys", [(1, (1,)), (300, (1, 2, None))])
def test_windows_of_a_hot_key_in_segments(many_parts, days, keys):
    e = events(many_parts, days=days, keys=keys)
    same(T.user_rating_stats(e, rows=50), T.user_rating_stats(e))
    same(T.movie_rating_stats(e.withColumnRenamed("movieId", "x").withColumnRenamed("userId", "movieId").withColumnRenamed("x", "userId"), rows=50),
         T.movie_rating_stats(e.withColumnRenamed("movieId", "x").withColumnRenamed("userId", "movieId").withColumnRenamed("x", "userId")))


def test_one_key_on_one_day_uses_several_tasks(many_parts):
    seq = S.dealt(events(many_parts, keys=(1,)).withColumn("ms", F.unix_millis(F.col("event_timestamp").cast("timestamp"))), ["userId", "ms"])
    sizes = [r["count"] for r in seq.groupBy("_seg").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 150  # of 400


def test_trailing_totals_match_plain_python(many_parts):
    e = events(many_parts, n=150, days=3).withColumn("ms", F.unix_millis(F.col("event_timestamp").cast("timestamp")))
    rows = e.collect()
    widths = {"hour": 3_600_000, "day": 86_400_000}
    for limit in (10, 1_000_000):
        got = S.trailing_totals(e, "userId", "ms", {"n": F.lit(1).cast("long")}, widths, limit).collect()
        assert len(got) == len(rows)
        for g in got:
            for w, size in widths.items():
                assert g[f"n_{w}"] == sum(x.userId == g.userId and g.ms - size <= x.ms < g.ms for x in rows)


def test_asof_of_a_hot_key_in_segments(many_parts):
    left = events(many_parts, n=300, days=3).select("userId", "event_timestamp", F.col("movieId").alias("probe"))
    right = events(many_parts, n=200, days=3, seed=2, keys=(1, 5)).groupBy("userId", "event_timestamp").agg(F.max("rating").alias("r"), F.min("movieId").alias("m"))
    same(T.asof_backward(left, right, "userId", "event_timestamp", rows=40), T.asof_backward(left, right, "userId", "event_timestamp"))


def test_prefix_over_everything_and_by_key(many_parts):
    vals = [-5, 1 << 40, 3, 1 << 62, 7, 8, 9, 10, 11, 12, 13, 0]
    df = many_parts.createDataFrame([(k % 3, v, 2) for k, v in enumerate(vals)], "k int, v long, w int")
    got = {r.v: r._cum_w for r in S.prefix(df, ["v"], ["w"]).collect()}
    assert got == {v: 2 * i for i, v in enumerate(sorted(vals))}
    got = {(r.k, r.v): r._cum_v for r in S.prefix(df.where("v < 100"), ["v"], ["v"], key="k").collect()}
    assert got == {(k % 3, v): sum(x for j, x in enumerate(vals) if j % 3 == k % 3 and x < v) for k, v in enumerate(vals) if v < 100}
    assert S.prefix(df.where("false"), ["v"], ["w"]).count() == 0
