"""The fitted item pipeline on unseen rows, and training rows with their checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features as X
from tidemark.operators import sampling as S

STATS = ("cnt", "avg")
ROWS = "movieId long, event_timestamp timestamp_ntz, title string, genres string, cnt long, avg double"


def at(day):
    return dt.datetime(2024, 1, day)


def test_pipeline_is_fitted_once_and_reused(spark, tmp_path):
    seen = [(i, at(d), t, g, c, a) for i, t, g in ((1, "red moon rising", "Drama|War"), (2, "red moon", "Drama"), (3, None, None))
            for d, c, a in ((1, 0, 0.0), (9, 4 * i, i / 2))]
    rows = spark.createDataFrame(seen, ROWS)
    first, last = X.one_row(rows), X.one_row(rows, which="last")
    assert {r.cnt for r in first.collect()} == {0} and {r.cnt for r in last.collect()} == {4, 8, 12}
    pipe = X.ItemPipeline.fit(last, STATS, min_df=1)
    pipe.save(str(tmp_path / "p"))
    again = X.ItemPipeline.load(spark, str(tmp_path / "p"))
    assert again.stats == STATS
    f = lambda df: {(r.movieId, r.feature): (round(r.value, 9), round(r.absent_value, 9)) for r in df.collect()}
    assert f(again.transform(last)) == f(pipe.transform(last))
    new = spark.createDataFrame([(9, at(20), "moon base", "War|Opera", 20, None)], ROWS)
    got = f(again.transform(new))
    names = {k[1] for k in got}
    assert {"title:moon", "genre:war", "agg:cnt", "agg:avg"} <= names and not names & {"title:base", "genre:opera"}
    # the least-squares scale of cnt over 4, 8, 12 is fitted state, not of the new row
    assert abs(got[9, "agg:cnt"][0] - (20 - 8) / (32 / 3) ** 0.5) < 1e-6
    # fitted on first rows, whose windows are empty, the aggregates pass unchanged
    plain = f(X.ItemPipeline.fit(first, STATS, min_df=1).transform(new))
    assert plain[9, "agg:cnt"][0] == 20


def test_training_rows_take_features_over_and_reject_nulls(spark):
    rows = [(u, i, 1.0, at(1 + (u + i) % 20), f"seq-{u}-{i}") for u in range(6) for i in range(8) if (u + i) % 3]
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double, event_timestamp timestamp_ntz, item_sequence string")
    cut = F.lit(at(10))
    got = S.negative_training_rows(df, cut, ["userId", "movieId", "item_sequence"], ["item_sequence"], k=1).collect()
    assert len(got) == 2 * len(rows)
    own = {(r[0], r[3], r[4]) for r in rows}
    assert all((g.userId, g.event_timestamp, g.item_sequence) in own for g in got)
    assert all(g.source == ("val" if g.event_timestamp >= at(10) else "train") for g in got)
    bad = df.withColumn("item_sequence", F.when(F.col("userId") != 2, F.col("item_sequence")))
    with pytest.raises(ValueError, match="item_sequence"):
        S.negative_training_rows(bad, cut, ["userId", "item_sequence"], ["item_sequence"])
