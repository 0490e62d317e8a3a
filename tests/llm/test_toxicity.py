"""The toxicity classifier against plain Python, and its edge cases."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from test_llm_ops import DOCS, ODD, SF, docs, words
from tidemark.llm import toxicity as T
from tidemark.llm.common import table
from tidemark.llm.textblocks import blocks


def feature_sets(texts):
    return [u for _, _, buf, offs in blocks(pa.array(texts, pa.string())) for u in T.feature_sets(buf, offs)]


def plain_ftrl(rows, rates, shards, rounds):
    """The same training written per coordinate, in dictionaries."""
    z, n = {}, {}

    def weight(z, n, i):
        l1 = 0.0 if i == T.BIAS else rates.l1
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else (math.copysign(l1, v) - v) / ((rates.beta + math.sqrt(n.get(i, 0.0))) / rates.alpha + rates.l2)

    for _ in range(rounds):
        change = {}
        for s in range(shards):
            zs, ns = dict(z), dict(n)
            for u, y in rows[s]:
                w = {i: weight(zs, ns, i) for i in u}
                g = 1 / (1 + math.exp(-sum(w.values()))) - y
                for i in u:
                    old = ns.get(i, 0.0)
                    ns[i] = old + g * g
                    zs[i] = zs.get(i, 0.0) + g - (math.sqrt(ns[i]) - math.sqrt(old)) / rates.alpha * w[i]
            for i in ns:
                if ns[i] != n.get(i, 0.0):
                    change.setdefault(i, []).append((zs[i] - z.get(i, 0.0), ns[i] - n.get(i, 0.0)))
        for i, parts in change.items():
            z[i] = z.get(i, 0.0) + sum(p[0] for p in parts) / len(parts)
            n[i] = n.get(i, 0.0) + sum(p[1] for p in parts) / len(parts)
    return {i: weight(z, n, i) for i in z}


def test_training_and_scores_match_plain_ftrl(spark):
    r, bad = random.Random(3), words(9, 4)
    rows = []
    for k in range(160):
        t = words(100 + k, r.randint(1, 60))
        if k % 4 == 0:
            t.insert(r.randrange(len(t) + 1), bad[k // 4 % 4])
        rows.append((k, " ".join(t), int(k % 4 == 0)))
    d = docs(spark, [x[:2] for x in rows])
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, label int")
    rates = T.Rates(l1=0.5)
    model = T.fit(d, labels, shards=3, rounds=2, rates=rates)
    # the shard and the order of a row come from hashes of its id: take them from Spark
    at = {x.doc_id: (x.s, x.d) for x in d.select("doc_id", F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(3)).alias("s"),
                                                 (F.abs(F.xxhash64(F.lit(11), "doc_id") % (1 << 53)) / F.lit(float(1 << 53))).alias("d")).collect()}
    sets = dict(zip([k for k, _, _ in rows], feature_sets([t for _, t, _ in rows])))
    parts = [[(sets[k], y) for k, _, y in sorted(rows, key=lambda x: at[x[0]][1]) if at[k][0] == s] for s in range(3)]
    want = plain_ftrl(parts, rates, 3, 2)
    assert {i for i, w in want.items() if w and i != T.BIAS} == set(model.index.tolist())
    assert np.allclose([want[i] for i in model.index], model.weight) and math.isclose(want[T.BIAS], model.bias)
    got = {x.doc_id: x.score for x in T.score(d, model).collect()}
    for k, _, _ in rows:
        assert math.isclose(got[k], 1 / (1 + math.exp(-sum(want.get(i, 0.0) for i in sets[k]))), rel_tol=1e-9, abs_tol=1e-12)  # logits are held within 35


def test_features_are_words_stems_and_skips():
    a, b, c, d = feature_sets(["Big CAT, big-cat!", "big cat big cat", "big cat", ""])
    assert a.tolist() == b.tolist() and len(a) == 2 + 2 + 2 + 1 + 1  # words, neighbours, one between, two between, bias
    assert len(c) == 4 and d.tolist() == [T.BIAS]
    long = feature_sets(["unbelievably", "unbelieving"])
    assert len(set(long[0]) & set(long[1])) == 3  # two stems and the bias


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = T.classify(table(spark, sf, "documents"), table(spark, sf, "labels")).where("held_out")
    x = got.join(table(spark, sf, "labels"), "doc_id").agg(
        F.sum("toxic").alias("bad"), F.sum(F.expr("toxic * predicted")).alias("caught"),
        F.sum(F.expr("1 - toxic")).alias("clean"), F.sum(F.expr("(1 - toxic) * predicted")).alias("wrong")).first()
    assert x.caught >= 0.8 * x.bad and x.wrong <= 0.02 * x.clean


def test_edges(spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1), (7, 0), (4, 1)], "doc_id long, toxic int")
    got = T.classify(docs(spark, ODD).withColumn("score", F.lit("x")).withColumn("_k", F.lit(1)), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0) for r in got)
    none = T.classify(docs(spark, ODD), labels.where("false")).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(ODD)
    assert T.classify(spark.createDataFrame([], DOCS), labels).count() == 0


def test_rounds_read_coordinates_and_no_texts(spark):
    sets = feature_sets(["", "a", " ".join(words(5, 400))])
    assert all(T.unpacked(T.packed(u)).tolist() == u.tolist() for u in sets)
    rows = spark.createDataFrame([(k % 2, k / 7, float(k % 2), bytearray(T.packed(u))) for k, u in enumerate(sets * 2)],
                                 "shard int, draw double, y double, u binary")
    z, n = T._round(rows, np.zeros(T.DIMS), np.zeros(T.DIMS), 2, T.Rates())
    assert np.flatnonzero(n).tolist() == sorted({int(i) for u in sets for i in u})
