"""The prefix trie against the SQL, the double array against a dictionary, and
edge cases."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefixtrie
from tidemark.llm.doublearray import DoubleArray

TURNS = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("seed", range(6))
def test_double_array_matches_dictionary(seed):
    r = random.Random(seed)
    seqs = [[r.randrange(1 + 40 * (seed % 3) + k) for k in range(r.randint(1, 12))] for _ in range(300)]
    offs = np.append(0, np.cumsum([len(s) for s in seqs]))
    trie = DoubleArray(np.array([c for s in seqs for c in s]), offs)
    node = {}
    for i, s in enumerate(seqs):
        for k in range(len(s)):
            at = int(trie.slot[offs[i] + k])
            assert node.setdefault(tuple(s[:k + 1]), at) == at and trie.walk(s[:k + 1]) == at
            assert trie.check[at] == (trie.slot[offs[i] + k - 1] if k else 0)
    assert len(set(node.values())) == len(node)  # no two prefixes share a slot
    for _ in range(300):
        s = [r.randrange(60) for _ in range(r.randint(1, 4))]
        assert (trie.walk(s) is not None) == (tuple(s) in node)


def conversations(seed, n):
    r = random.Random(seed)
    openers = ["hi", "hello there", "", None, "é à"]
    out = []
    for c in r.sample(range(-50, 4 * n), n):
        for t in range(r.choice([1, 2, 3, 3, 7, 9])):
            out.append((c, r.choice([t, t, t, None]), r.choice(["user", "assistant"]) if t else "user", r.choice(openers) if t < 3 else f"turn {r.randrange(3)}"))
    copies = [row for row in out if row[0] == out[0][0]]
    out += [(100_000 + k, *row[1:]) for k in range(40) for row in copies]
    return out + out[:10] + [(None, 0, "user", "hi")]


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = con.execute(prefixtrie.oracle_sql())
    names = [d[0] for d in got.description]
    return sorted((tuple(dict(zip(names, x))[c] for c in COLS) for x in got.fetchall()), key=str)


def by_spark(spark, rows, limit, **extra):
    df = spark.createDataFrame(rows, TURNS)
    for k, v in extra.items():
        df = df.withColumn(k, v)
    return sorted((tuple(x[c] for c in COLS) for x in prefixtrie.nodes(df, limit=limit).collect()), key=str)


def test_nodes_match_sql(spark):
    rows = conversations(1, 150)
    assert by_spark(spark, rows, 16_384, depth=F.lit(1), a=F.lit("x"), size=F.lit(2)) == by_sql(rows)


def test_heavy_nodes_go_up_in_rounds(spark):
    """Shards of a few rows, so that most prefixes are heavy, and a conversation
    that is longer than a shard and than a block of hashes."""
    rows = conversations(2, 60) + [(7_777, t, "user", f"t{t}") for t in range(90)] + [(7_776, t, "user", f"t{t}") for t in range(70)]
    block, chunk = prefixtrie.BLOCK, prefixtrie.CHUNK_IDS
    try:
        prefixtrie.BLOCK, prefixtrie.CHUNK_IDS = 16, 7
        assert by_spark(spark, rows, 25) == by_sql(rows)
    finally:
        prefixtrie.BLOCK, prefixtrie.CHUNK_IDS = block, chunk


def test_rows_of_a_conversation_in_many_partitions(spark):
    rows = [(0, t, "user", f"t{t % 300}") for t in range(900)] + conversations(3, 20)
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    old = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "7"), spark.conf.set(names[1], "false")
        assert by_spark(spark, rows, 16_384) == by_sql(rows)
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)


def test_edges(spark):
    assert by_spark(spark, [], 100) == [] and by_spark(spark, [(None, 1, "user", "x")], 100) == []
    import zlib
    bare = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 > 1)  # loses its turn, and has no family
    got = by_spark(spark, [(bare, 0, "user", "x")], 100)
    assert got == [(bare, 0, None, 1, 0, 1, 0, hashlib.sha256(str(bare).encode()).hexdigest())]
