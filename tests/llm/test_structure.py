"""Conversation repair against exhaustive search and the SQL, and its edge cases."""

import hashlib
import heapq
import random

import duckdb
import numpy as np
import pytest

from tidemark.llm import fourrussians as fr
from tidemark.llm import structure

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(syms):
    """(cost, letters) by a search over (rows done, state), without tables."""
    queue, seen = [(0, "", 0, fr.START)], set()
    while queue:
        cost, letters, i, q = heapq.heappop(queue)
        if (i, q) in seen:
            continue
        if i == len(syms) and q in (fr.START, fr.ASSISTANT):
            return cost, letters
        seen.add((i, q))
        heapq.heappush(queue, (cost + fr.INSERT, letters + "I", i, fr.NEXT[q]))
        if i < len(syms):
            for letter, c, to in fr.edits(q, syms[i]):
                heapq.heappush(queue, (cost + c, letters + letter, i + 1, to))


def test_block_tables_match_search():
    r, t = random.Random(1), fr.tables()
    for _ in range(1500):
        s = np.array([r.randrange(fr.SYMBOLS) for _ in range(r.randrange(14))], np.int64)
        m = r.randrange(len(s) + 1)
        right, _ = t.function(s[m:])
        first, states = t.function(s[:m])
        v = int(right[0])
        a, q, c = t.trace(s[:m], v, fr.START)
        assert q == states[v, fr.START]
        b, end, d = t.trace(s[m:], 0, q)
        tail = fr.ending(end)
        assert (c + d + fr.INSERT * len(tail), "".join(a + b) + tail) == cheapest(s.tolist())


def conversations(seed, n):
    r = random.Random(seed)
    text = lambda: r.choice(["", " \t", "Yes.", "No", "Why? ", "so on!\n", "é.", None, "a" * 3000, f"n{r.randrange(4)}."])
    out = []
    for c in range(n):
        for t in range(r.randrange(9)):
            out.append((c, r.choice([t, t, t, t + 2, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text()))
    return out + [(None, t, "user", "x.") for t in range(3)] + out[:20]


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = con.execute(structure.oracle_sql())
    names = [d[0] for d in got.description]
    return sorted((dict(zip(names, x)) for x in got.fetchall()), key=str)


def by_spark(spark, rows, **extra):
    df = spark.createDataFrame(rows, TURNS)
    for k, v in extra.items():
        df = df.withColumn(k, v)
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(({c: r[c] for c in cols} for r in structure.report(df).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_report_matches_sql(spark, seed):
    from pyspark.sql import functions as F
    rows = conversations(seed, 120)
    want = by_sql(rows)
    assert by_spark(spark, rows, pos=F.lit("x"), seg=F.lit(1), sym=F.lit(1), sha=F.lit(2)) == want
    assert any(x["cost"] for x in want) and any(x["duplicate"] for x in want) and any(x["gaps"] for x in want)


def test_conversations_in_many_segments(spark):
    """One conversation holds most of the rows and lies in many partitions."""
    r = random.Random(5)
    rows = [(7, t // 2 if t % 50 else None, r.choice(["user", "assistant", "system", "x"]), r.choice([f"t{t}.", f"t{t}", "again.", ""])) for t in range(1500)]
    rows += conversations(3, 25)
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    old = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "9"), spark.conf.set(names[1], "false")
        seq = structure._sequenced(structure.damage(spark.createDataFrame(rows, TURNS)))
        assert seq.where("conv_id = 7").select("seg").distinct().count() > 4
        assert by_spark(spark, rows) == by_sql(rows)
        structure.CHUNK, chunk = 200, structure.CHUNK
        assert by_spark(spark, rows) == by_sql(rows)
    finally:
        structure.CHUNK = chunk
        for n, v in zip(names, old):
            spark.conf.set(n, v)


def test_edges(spark):
    assert by_spark(spark, []) == []
    empty = hashlib.sha256(b"").hexdigest()
    # every row of a conversation dropped
    import zlib
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = by_spark(spark, [(gone, 0, "user", "hi.")])
    assert got == [{"conv_id": gone, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": empty}]
    whole = structure.repair(spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "user", "b."), (2, 0, "user", "c")], TURNS))
    got = {x.conv_id: (x.cost, x.audit, x.repaired_sha256) for x in whole.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1] == (2, "RR", sha("user:a.\nassistant:b.")) and got[2] == (2, "D", empty)


def test_crc32_sql():
    import zlib
    for text in ["0", "12:3", " : ", "-5:9999999999"]:
        assert duckdb.execute("SELECT " + structure.crc32_sql(f"'{text}'")).fetchone()[0] == zlib.crc32(text.encode())
