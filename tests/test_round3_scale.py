"""Steps that must stay in proportion to their input."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import temporal as T


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _events(spark):
    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
    rows = [(u, i % 5, day(i * (u + 1) * 7), float(i % 4) + 0.1) for u in range(3) for i in range(40)]
    rows += [(9, 1, None, 2.0), (9, 2, day(1), 1.0)]
    return spark.createDataFrame(rows, "userId long, movieId long, event_timestamp timestamp_ntz, rating double")


def test_trailing_stats_copy_no_rows(spark):
    """a row is neither copied nor joined to itself, by either strategy."""
    for strategy in ("prefix", "scan"):
        plan = _plan(T.movie_rating_stats(_events(spark), strategy=strategy))
        assert "Generate" not in plan and "Join" not in plan, strategy


def test_strategies_agree_with_hot_keys(spark):
    ev = _events(spark).where("event_timestamp is not null")
    got = [sorted(map(tuple, T.movie_rating_stats(ev, strategy=s, rows=n).collect())) for s in ("prefix", "scan") for n in (1_000_000, 3)]
    assert got[0] == got[1] == got[2] == got[3]
    null = T.user_rating_stats(_events(spark)).where("event_timestamp is null").select("user_rating_cnt_90d").collect()
    assert [r[0] for r in null] == [0]


def test_negatives_meet_few_pieces_and_copy_no_features(spark):
    """buckets as wide as the mean item; duplicates of a row need
    no join; derived features give the rows that joined ones give."""
    from tidemark.operators import sampling as S
    ev = _events(spark).where("event_timestamp is not null")
    assert S.piece_width(36_000_000, 1_200_000) == 30 and S.piece_width(0, 0) == 1
    twice = S.negative_samples(ev.unionByName(ev), ev)
    assert sorted(map(tuple, twice.collect())) == sorted(2 * [tuple(r) for r in S.negative_samples(ev, ev).collect()])
    feats = ["user_rating_cnt_90d", "item_sequence_ts"]
    wide = T.user_rating_stats(ev, keep=["rating"])
    keys, cut = ["userId", "movieId", "rating"], F.lit(dt.datetime(2024, 1, 5))
    a = S.negative_training_rows(wide, cut, keys, feats)
    b = S.negative_training_rows(ev, cut, keys, feats, derive=lambda rows: T.user_rating_stats(rows, keep=["rating", "_negs"]))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > ev.count()


def test_users_of_one_last_item_are_one_query(spark, monkeypatch):
    """Searches grow with the items, not with the users, and tiles
    with ties give the whole search's rows."""
    from tidemark.operators import retrieval as R
    vec = spark.createDataFrame([(i, [float(i % 4), float(i % 3)]) for i in range(12)], "item_id long, vector array<double>")
    day = lambda i: dt.datetime(2024, 1, 1 + i)
    ev = spark.createDataFrame([(u, 3 + 90 * (u % 2) + i, day(i), 1.0) for u in range(60) for i in range(3)],
                               "userId long, movieId long, event_timestamp timestamp_ntz, rating double")
    asked = []
    whole = R.blocked_topk
    monkeypatch.setattr(R, "blocked_topk", lambda q, *a, **k: asked.append(q.count()) or whole(q, *a, **k))
    got = sorted(map(tuple, R.user_topk(ev, vec, 5).collect()))
    assert asked == [2] and len(got) == 60 * 5
    uv = R.user_vectors(ev, vec).select(F.col("userId").alias("qid"), "vector")
    cands = vec.select(F.col("item_id").alias("cid"), "vector")
    want = sorted((r.qid, r.cid, r.score, r["rank"]) for r in whole(uv, cands, 5, "dot").collect())
    assert got == want
    small = sorted((r.qid, r.cid, r.score, r["rank"]) for r in whole(uv, cands, 5, "dot", block_size=5).collect())
    assert small == want


def test_sequences_are_read_off_one_sort(spark):
    """positions and lengths without a join, the same for hot users."""
    from tidemark.operators import sequences as Q
    ev = _events(spark)
    got = Q.item_sequences(ev, min_len=3)
    assert "Join" not in _plan(got) and got.count() == 120
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, Q.item_sequences(ev, min_len=3, rows=5).collect()))


def test_stats_are_made_once_and_shuffled_once(spark):
    """The dedup and the windows of the stats lie by item
    alone, and a join by key and instant does not shuffle them again."""
    ev = _events(spark)
    stats = T.movie_rating_stats(ev)
    assert stats._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    probes = ev.select("movieId", "event_timestamp", "userId")
    plan = T.point_in_time_join(probes, stats, "movieId", "event_timestamp", 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2


def test_instant_join_is_the_left_join(spark):
    ev = _events(spark).unionByName(spark.createDataFrame([(None, 1, dt.datetime(2024, 1, 2), 1.0), (1, None, dt.datetime(2024, 1, 3), 2.0)],
                                                          _events(spark).schema))
    us = T.collapse_user_stats(T.user_rating_stats(ev)).drop("movieId")
    want = ev.join(us, ["userId", "event_timestamp"], "left").select(*ev.columns, *[c for c in us.columns if c not in ("userId", "event_timestamp")])
    rows = lambda df: sorted(map(str, df.collect()))
    for n in (1_000_000, 3):
        assert rows(T.instant_join(ev, us, "userId", "event_timestamp", n)) == rows(want)


def test_end_rows_are_both_one_rows(spark):
    from tidemark.operators import features as X
    ev = _events(spark).where("event_timestamp is not null")
    early = F.col("event_timestamp") < F.lit(dt.datetime(2024, 1, 9))
    got = X.end_rows(ev, early)
    for part, rows, which in ((got.where("early"), ev.where(early), "first"), (got.where("not early"), ev.where(~early), "last")):
        want = X.one_row(rows, which=which)
        assert sorted(map(tuple, part.select(*want.columns).collect())) == sorted(map(tuple, want.collect())) != []
