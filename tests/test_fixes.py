"""Data that the test tables lack: wide and fractional ids, null ratings, many decimals, hard-to-serve rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import hash64, safe_long
from tidemark.operators import prep as P
from tidemark.operators import retrieval as R
from tidemark.operators import temporal as T
from tidemark.operators.sampling import negative_samples


def test_wide_and_double_ids(spark):
    t = spark.createDataFrame([("1234567890123456789",), ("99999999999999999999",), ("4.5",), (" -7 ",), (None,)], "x string")
    assert [r[0] for r in t.select(safe_long("x")).collect()] == [1234567890123456789, None, None, -7, None]
    d = spark.createDataFrame([(4.0, 7.0, 3.5, 100), (4.5, 7.0, 3.5, 100), (1e30, 7.0, 3.5, 100)], "userId double, movieId double, rating double, timestamp long")
    got = P.standardize_dtypes(d).collect()
    assert [(r.userId, r.movieId, r.rating) for r in got] == [(4, 7, 3.5)]
    s = spark.createDataFrame([("1234567890123456789", "2", "4", 100)], "userId string, movieId string, rating string, timestamp long")
    assert P.standardize_dtypes(s).first().userId == 1234567890123456789


def test_hash_has_sixty_bits(spark):
    top = spark.range(2000).select(F.max(hash64("id")).alias("m")).first().m
    assert 2 ** 59 < top < 2 ** 60


def test_prefix_and_range_agree_on_nulls_and_decimals(spark):
    t0 = dt.datetime(2020, 1, 1)
    rows = [(1, 1, t0 + dt.timedelta(hours=h), r) for h, r in enumerate([0.1234567891, None, 2.5, None, 1e-9, 4.0])]
    e = spark.createDataFrame(rows, "userId long, movieId long, event_timestamp timestamp_ntz, rating double")
    a, b = ([tuple(r) for r in T.movie_rating_stats(e, strategy=s).orderBy("event_timestamp").collect()] for s in ("range", "prefix"))
    for x, y in zip(a, b):
        assert x[:2] == y[:2] and x[2:] == pytest.approx(y[2:], abs=1e-12)
    assert a[5][2] == 3


def test_kcore_bound_raises(spark):
    chain = spark.createDataFrame([(u, i) for u in range(8) for i in (u, u + 1)], "userId long, movieId long")
    assert P.kcore(chain, min_user=2, min_item=2).count() == 0
    with pytest.raises(RuntimeError):
        P.kcore(chain, min_user=2, min_item=2, max_rounds=2)


def test_negatives_of_a_user_with_rare_unseen_items(spark):
    rows = [(1, i, i) for i in range(40)] + [(u, i, 100 + u) for u in range(2, 60) for i in range(40)] + [(99, 40, 5), (99, 41, 6)]
    e = spark.createDataFrame(rows, "userId long, movieId long, event_timestamp long").withColumn("rating", F.lit(1.0))
    for limit in (0, 10_000):
        got = negative_samples(e, enumerate_limit=limit, max_rounds=1)
        one = got.where("userId = 1")
        assert one.count() == 40 and {r.movieId for r in one.collect()} <= {40, 41}


def test_users_without_vectors_are_kept(spark):
    e = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 12, 1)], "userId long, movieId long, event_timestamp long")
    v = spark.createDataFrame([(10, [1.0, 2.0])], "item_id long, vector array<double>")
    assert {r.userId: r.vector for r in R.user_vectors(e, v).collect()} == {1: [1.0, 2.0], 2: [0.0, 0.0]}


def test_tables_of_a_folder(spark, tmp_path):
    from tidemark.sources import files as S
    d = str(tmp_path)
    spark.range(10).repartition(3).write.parquet(f"{d}/a/big.parquet")
    spark.range(4).write.json(f"{d}/b/big.jsonl")
    (tmp_path / "x.csv").write_text("k,v\n1,2\n")
    (tmp_path / "bad.parquet").write_text("no")
    (tmp_path / "notes.bin").write_text("no")
    tables, rejected = S.load_all_tables(spark, d)
    assert {k: v.count() for k, v in tables.items()} == {"a/big": 10, "b/big": 4, "x": 1}
    assert {r.relative_path for r in rejected.collect()} == {"bad.parquet", "notes.bin"}
