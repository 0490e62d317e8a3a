"""Round 4: what queries leave on the disk, by force."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import prep as P
from tidemark.session import checkpoint_dir, written


def _size(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs)


def _core(rows, min_user, min_item):
    while True:
        u, i = Counter(r[0] for r in rows), Counter(r[1] for r in rows)
        left = [r for r in rows if r[0] is not None and r[1] is not None and u[r[0]] >= min_user and i[r[1]] >= min_item]
        if len(left) == len(rows):
            return sorted(rows)
        rows = left


@pytest.mark.parametrize("share,sent", [(0.0, 0), (0.1, 500_000), (2.0, 0)])
def test_kcore_by_force(spark, monkeypatch, share, sent):
    monkeypatch.setattr(P, "COMPACT_SHARE", share)
    monkeypatch.setattr(P, "BROADCAST_KEYS", sent)
    r = random.Random(7)
    rows = [(r.choice([None, *range(12)]), r.choice([None, *range(int(1 + 25 * r.random() ** 2))]), n) for n in range(300)]
    got = P.kcore(spark.createDataFrame(rows, "userId long, movieId long, n long"), min_user=15, min_item=8)
    want = _core(rows, 15, 8)
    assert 0 < len(want) < len(rows) and sorted(tuple(x) for x in got.select("userId", "movieId", "n").collect()) == want


def test_kcore_does_not_write_its_rows_each_round(spark):
    chain = [(u, i) for u in range(5) for i in (u, u + 1)]
    block = [(u, i) for u in range(100, 130) for i in range(100, 130)]
    df = spark.createDataFrame(chain + block, "userId long, movieId long").withColumn("pay", F.repeat(F.md5(F.concat("userId", "movieId", F.lit("x"))), 20))
    df = df.withColumn("pay", F.concat(*[F.md5(F.concat("pay", F.lit(i))) for i in range(40)]))
    one = _size(written(df, "one")._written_at)
    before = _size(checkpoint_dir(spark))
    assert P.kcore(df, min_user=2, min_item=2).count() == len(block)
    assert _size(checkpoint_dir(spark)) - before < 3 * one


def test_written_leaves_no_shuffle_files(spark):
    import time
    app = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def data():
        return sum(f.startswith("shuffle") and f.endswith(".data") for d in app for _, _, fs in os.walk(d) for f in fs)

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(key, None), data()
    assert len(written(spark.range(1000).repartition(7, "id"), "plain").collect()) == 1000
    for _ in range(50):
        if data() <= before:
            break
        time.sleep(0.1)
    assert data() <= before and spark.conf.get(key, None) == was
