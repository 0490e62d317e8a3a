"""Repeated ids in the top-k search; short items in decontamination."""

import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from test_llm_ops import docs, words
from tidemark.llm import decontaminate, topk


def test_topk_keeps_every_row_of_an_id(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.integers(0, 90, 300), rng.normal(size=(300, 6)) * rng.choice([0.2, 1, 4], size=(300, 1)))]
    rows += [(1, rows[0][1]), (1, rows[0][1]), (20, rows[1][1]), (20, rows[2][1])]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = sorted(con.execute(topk.oracle_sql()).fetchall())
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for sizes in ({}, {"block_rows": 16, "query_rows": 3, "seed_rows": 30}):
        got = topk.topk(t, F.col("vec_id") % 20 == 0, **sizes)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want


def test_short_items_are_all_found(spark):
    r = random.Random(8)
    items = [(k, " ".join(words(500 + k, 5 + k % 8))) for k in range(200)]
    rows = []
    for k, text in items:
        w = words(9_000 + k, r.randint(0, 120))
        at = r.randrange(len(w) + 1)
        rows.append((k, " ".join(w[:at] + text.upper().split() + w[at:])))
    clean = [(1_000 + k, " ".join(words(20_000 + k, 150))) for k in range(50)]
    bench = spark.createDataFrame([(k, t) for k, t in items], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.report(docs(spark, rows + clean), bench).collect()}
    assert got == {(k, k) for k, _ in items}


def test_items_under_five_words_are_whole_texts(spark):
    bench = spark.createDataFrame([(1, "Three short words"), (2, "x"), (3, None), (4, " ")], "item_id long, text string")
    rows = [(1, "three  short words\n"), (2, "X"), (3, "here are three short words inside"), (4, "short words"), (5, ""), (6, None)]
    got = {(x.doc_id, x.item_id, x.containment) for x in decontaminate.report(docs(spark, rows), bench).collect()}
    assert got == {(1, 1, 1.0), (2, 2, 1.0)}
    assert sorted(x.doc_id for x in decontaminate.clean(docs(spark, rows).withColumn("_hit", F.lit(1)), bench).collect()) == [3, 4, 5, 6]


def test_passage_bands_are_counted_by_hash(spark, monkeypatch):
    """op5: bands are cut to those of several texts by two numbers a band, not by
    sorted structs of every paragraph."""
    from tidemark.llm import passages as P
    plans, real = {}, P.stored
    monkeypatch.setattr(P, "stored", lambda df, name: (plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()), real(df, name))[1])
    line = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(1, line), (2, "x " + line), (3, "y")], "doc_id long, text string")
    assert sorted(r.doc_id for r in P.repeats(rows).collect()) == [1, 2]
    assert "SortAggregate" not in plans["passage-met"] and "HashAggregate" in plans["passage-met"]
