"""Recent-10 seen list, online features, class weights and the trained ranking, by force."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml as ML
from tidemark.operators import retrieval as R

EV = "userId long, movieId long, event_timestamp timestamp_ntz, rating double"


def test_recent_seen_by_force(spark):
    r = random.Random(2)
    import datetime as dt
    rows = [(u, r.randrange(30), dt.datetime(2000, 1, 1) + dt.timedelta(days=r.randrange(40)), 1.0) for u in (1, 1, 1, 2) for _ in range(25)]
    rows.append((3, 7, dt.datetime(2000, 1, 1), 1.0))
    want = set()
    for u in (1, 2, 3):
        want |= {(u, m) for m, _ in sorted(((x[1], x[2]) for x in rows if x[0] == u), key=lambda p: (p[1], p[0]))[-10:]}
    got = [tuple(x) for x in R.recent_seen(spark.createDataFrame(rows, EV).repartition(5)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_scoring_rows_fill_unknown_and_ignore_other_columns(spark):
    c = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (9, 10, 1)], "userId long, movieId long, cand_rank int")
    items = spark.createDataFrame([(10, 2.0, "x")], "movieId long, a double, cand_rank string")
    users = spark.createDataFrame([(1, 5, "y")], "userId long, b long, movieId string")
    got = {(r.userId, r.movieId): (r.cand_rank, r.a, r.b) for r in R.scoring_rows(c, items, users, ["a", "b"]).collect()}
    assert got == {(1, 10): (1, 2.0, 5.0), (1, 11): (2, 0.0, 5.0), (9, 10): (1, 2.0, 0.0)}


def test_class_weights(spark):
    rows = spark.createDataFrame([(1,)] * 3 + [(0,)] * 9 + [(None,)], "label int")
    sums = defaultdict(float)
    for r in ML.class_weights(rows).collect():
        sums[r.label] += r.weight
    assert sums[1] == pytest.approx(6) and sums[0] == pytest.approx(6) and sums[None] == 0
    assert ML.class_weights(rows.where("false")).count() == 0


def test_rank_candidates_by_force(spark):
    r = random.Random(3)
    train = [(int(x + r.gauss(0, 0.5) > 0.5), x, r.random()) for x in (r.random() for _ in range(300))]
    model = ML.train_ranker(ML.class_weights(spark.createDataFrame(train, "label int, a double, b double")), ["a", "b"])
    cands = [(u, m, round(r.random(), 1), 0.5) for u in range(6) for m in range(1 + 4 * u)]
    got = ML.rank_candidates(model, spark.createDataFrame(cands, "userId long, movieId long, a double, b double"), ["a", "b"], 5).collect()
    w, c0 = model.coefficients.toArray(), model.intercept
    by_user = defaultdict(list)
    for u, m, a, b in cands:
        by_user[u].append((-1 / (1 + math.exp(-(w[0] * a + w[1] * b + c0))), m))
    want = {(u, m): (i + 1, -p) for u, l in by_user.items() for i, (p, m) in enumerate(sorted((round(p, 12), m) for p, m in l)[:5])}
    assert w[0] > 0 and {(g.userId, g.movieId): g.rec_ranking for g in got} == {k: v[0] for k, v in want.items()}
    assert all(g.prob == pytest.approx(want[g.userId, g.movieId][1]) for g in got)


def test_dataset_drift_flag(spark):
    from tidemark.operators.metrics import dataset_drift
    rows = lambda *d: spark.createDataFrame([(str(i), x) for i, x in enumerate(d)], "column string, drifted boolean")
    flag = lambda *d: tuple(dataset_drift(rows(*d)).first())
    assert flag(True, False) == (2, 1, 0.5, True) and flag(True, False, None) == (3, 1, 1 / 3, False) and flag() == (0, 0, 0.0, False)


def test_temporal_split_reaches_the_scan(spark, tmp_path):
    from tidemark.operators.prep import temporal_split
    path = str(tmp_path / "t")
    spark.range(200).selectExpr("id", "timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(cast(id as int), 0, 0, 0.5) AS at").write.parquet(path)
    df = spark.read.parquet(path).selectExpr("*", "unix_seconds(cast(at as timestamp)) AS timestamp")
    both = temporal_split(df, "timestamp", 90), temporal_split(df, "timestamp", 90, "at")
    for a, b in zip(*both):
        assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    assert "GreaterThanOrEqual(at" in both[1][1]._jdf.queryExecution().executedPlan().toString()
    assert temporal_split(df.where("id < 0"), "timestamp", 90, "at")[0].count() == 0


def test_ranking_makes_interactions_and_stats_once(spark, monkeypatch):
    from conftest import SF
    from tidemark.operators import temporal as T
    from tidemark.plans import q_two_stage
    from tidemark.sources import adapters
    made = defaultdict(int)
    for module, name in ((adapters, "interactions_L"), (T, "movie_rating_stats")):
        def counted(*a, _of=getattr(module, name), _name=name, **kw):
            made[_name] += 1
            return _of(*a, **kw)
        monkeypatch.setattr(module, name, counted)
    got = q_two_stage.two_stage_ranked(spark, SF)
    assert made == {"interactions_L": 1, "movie_rating_stats": 1}
    users = got.groupBy("userId").agg(F.count(F.lit(1)).alias("n"), F.max("rec_ranking").alias("last")).collect()
    assert users and all(u.n == u.last <= 10 for u in users)


def test_written_shuffle_is_the_same_order(spark):
    from tidemark.operators.prep import hash_shuffle
    rows = spark.range(500).selectExpr("id", "id % 7 AS x")
    a, b = (hash_shuffle(rows, 42, ["x", "id"], once=once) for once in (False, True))
    assert a.collect() == b.collect() and a.columns == b.columns
    assert "shuffle-keys" in "".join(b.inputFiles())
