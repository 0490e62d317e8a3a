"""Negative draws and exact quantiles against plain Python."""

import hashlib
import math
import random
import statistics

import numpy as np
import pytest

from tidemark.operators import ids as I
from tidemark.operators import prep as P
from tidemark.operators.quantiles import quantiles
from tidemark.operators.sampling import negative_samples


def uniform(*parts):
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16) + 0.5) / 2 ** 60


def draws_by_hand(rows, k, seed):
    pop = {}
    for _, i, _ in rows:
        pop[i] = pop.get(i, 0) + 1
    out = []
    for u, i, t in set(rows):
        seen, picked = {x[1] for x in rows if x[0] == u}, []
        for j in range(k):
            pool = [(x, c) for x, c in sorted(pop.items()) if x not in seen and x not in picked]
            if not pool:
                break
            x = math.floor(uniform(seed, u, i, t, j) * sum(c for _, c in pool))
            for item, c in pool:
                if x < c:
                    break
                x -= c
            picked.append(item)
        out += [(u, p, t) for p in picked]
    return sorted(out)


@pytest.mark.parametrize("segment", [10, 1_000_000])
def test_negatives_match_plain_python(spark, segment):
    r = random.Random(2)
    rows = [(u, r.randrange(30) ** 2 * 1_000_000_007, t) for u in range(8) for t in range(r.randint(1, 25))]
    rows += [(50, i * i * 1_000_000_007, i) for i in range(30)] + [(51, i * i * 1_000_000_007, i) for i in range(28)]  # saw all; all but two
    df = spark.createDataFrame([(*x, 1.0) for x in rows], "userId long, movieId long, event_timestamp long, rating double")
    got = negative_samples(df, k=3, seed=9, rows=segment)
    assert sorted((x.userId, x.movieId, x.event_timestamp) for x in got.collect()) == draws_by_hand(rows, 3, 9)


def test_negatives_of_empty_tables(spark):
    df = spark.createDataFrame([], "userId long, movieId long, event_timestamp long, rating double")
    assert negative_samples(df).count() == 0


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [5.0] * 50, [0.1 * k * k - 7 for k in range(999)], [1e300, -1e300, 1e-300, 0.0, -0.0, 2.0],
    [1.0 + k * 2 ** -52 for k in range(40)] + [9e15], [math.inf, 1.0, 2.0, -math.inf, math.nan, 4.0], [1.7e308, -1.7e308, 1.0]])
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    finite = sorted(v for v in values if math.isfinite(v))
    for got, q in zip(quantiles(df, ["x"], qs)["x"], qs):
        at = q * (len(finite) - 1)
        lo, hi = finite[math.floor(at)], finite[math.ceil(at)]
        assert got == (lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)))


def test_describe_of_integers_is_exact(spark):
    r = random.Random(1)
    values = [10 ** 9 + r.randrange(10 ** 8) for _ in range(500)]
    df = spark.createDataFrame([(v, None) for v in values], "a long, b double")
    a, b = P.describe_numeric(df, ["a", "b"]).collect()
    assert a["count"] == 500 and math.isclose(a["std"], statistics.stdev(values), rel_tol=1e-15) and a["mean"] == float(sum(values)) / 500
    assert np.allclose([a["p25"], a["p50"], a["p75"]], np.quantile(values, [0.25, 0.5, 0.75]), rtol=1e-15)
    assert b["count"] == 0 and b["p50"] is None and b["std"] is None
    assert P.describe_numeric(df.where("false"), ["a", "b"]).count() == 2


def test_ids_of_any_spread_are_numbered_in_even_parts(spark):
    ids = [0, 1, 2, -(1 << 62), 1 << 62, *range(10 ** 15, 10 ** 15 + 50)]
    got = {x.raw_id: x.idx for x in I.dense_index(spark.createDataFrame([(i,) for i in ids + [None]], "v long"), "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}
