"""Skip-gram negatives against the same draws in plain Python; approximate
neighbours against exact ones."""

import hashlib
import math
import random
from collections import defaultdict

import pytest

from tidemark.operators import ann as A
from tidemark.operators import retrieval as R
from tidemark.operators import skipgram as G
from tidemark.operators.sequences import skipgram_pairs


def uniform(*parts):
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16) + 0.5) / 2 ** 60


def by_hand(seqs, pairs, n, seed):
    """The contract, target by target: free items in order, draws in order."""
    items = sorted({i for s in seqs.values() for i in s})
    weight = {i: math.floor(sum(i in s for s in seqs.values()) ** 0.75 * G.SCALE + 0.5) for i in items}
    out = set()
    for s, t_pos, c_pos, t in pairs:
        shared = {i for q in seqs.values() if t in q for i in q}
        free = {i: weight[i] for i in items if i not in shared} or dict.fromkeys(items, 1)
        again, picked = len(free) < n, []
        for j in range(n):
            pool = free if again else {i: w for i, w in free.items() if i not in picked}
            x = math.floor(uniform(seed, s, t_pos, c_pos, j) * sum(pool.values()))
            for i, w in pool.items():
                if x < w:
                    break
                x -= w
            picked.append(i)
            out.add((s, t_pos, c_pos, t, j, i, 0.0))
    return out


@pytest.mark.parametrize("bits,block_rows", [(G.BITS, 200_000), (7, 30)])
def test_negatives_match_plain_python(spark, bits, block_rows):
    r = random.Random(4)
    seqs = {s: [r.randrange(1, 60) * 1_000_003 for _ in range(r.randint(2, 9))] for s in range(25)}
    seqs[100] = [5, 7] + [i for s in seqs.values() for i in s][:400:2]  # 5 shares with nearly all: few free, or none
    seqs[101] = [5, 9] + [i for s in seqs.values() for i in s][1:400:2][:-6]
    rows = [(s, p, i) for s, q in seqs.items() for p, i in enumerate(q)]
    df = spark.createDataFrame(rows, "userId long, pos long, movieId long")
    pairs = skipgram_pairs(df, 2)
    want = by_hand(seqs, [(x.userId, x.t_pos, x.c_pos, x.target_item) for x in pairs.collect()], 3, 42)
    got = G.skipgram_negatives(pairs, df, n=3, bits=bits, block_rows=block_rows)
    assert {tuple(x) for x in got.collect()} == want and got.count() == len(want)


def test_negatives_where_everything_is_shared(spark):
    df = spark.createDataFrame([(1, p, i) for p, i in enumerate([10, 20, 30])], "userId long, pos long, movieId long")
    pairs = skipgram_pairs(df, 1)
    got = G.skipgram_negatives(pairs, df, n=5).collect()
    per = defaultdict(list)
    for x in got:
        per[x.userId, x.t_pos, x.c_pos].append(x.context_item)
    assert len(per) == 4 and all(len(v) == 5 and set(v) <= {10, 20, 30} for v in per.values())
    three = G.skipgram_negatives(pairs, df, n=3).collect()
    per = defaultdict(set)
    for x in three:
        per[x.userId, x.t_pos, x.c_pos].add(x.context_item)
    assert all(v == {10, 20, 30} for v in per.values())  # without replacement where items suffice
    assert G.skipgram_negatives(pairs.where("false"), df.where("false")).count() == 0


def clustered(spark, n=600, dim=8, seed=1):
    r = random.Random(seed)
    heads = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    rows = [(i, [x + 0.15 * r.gauss(0, 1) for x in heads[i % 12]]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(300)]  # a third of all are one vector
    rows += [(5_000, [0.0] * dim), (5_001, None), (None, heads[0])]
    return spark.createDataFrame(rows, "item_id long, vector array<double>")


def test_neighbours_of_clustered_vectors(spark):
    v = clustered(spark)
    found = A.neighbours(v, k=5, lists=12)
    exact = R.neighbours(v.where("vector is not null and item_id is not null"), 5)
    got = A.recall(found, exact).first()
    assert got.n_queries == 901 and got.recall >= 0.9
    score = {(x.target_item, x.rec_item): x.score for x in exact.collect()}
    assert all(math.isclose(score.get((x.target_item, x.rec_item), x.score), x.score, abs_tol=1e-12) for x in found.collect())
    assert found.where("target_item = rec_item").count() == 0


def test_all_lists_give_the_exact_neighbours(spark):
    v = clustered(spark, 200).where("vector is not null and item_id is not null")
    base = v.selectExpr("item_id as cid", "vector")
    index = A.build(base, A.fit(base, lists=6))
    q = base.withColumnRenamed("cid", "qid").where("qid % 7 = 0")
    got = A.search(index, q, 10, probes=6, exclude_self=True, block_rows=50)  # hot lists in chunks
    want = R.blocked_topk(q, base, 10, "cosine", exclude_self=True)
    f = lambda df: sorted((x.qid, x.rank, x.cid, round(x.score, 9)) for x in df.collect())
    ties = lambda rows: [(q, k, s) for q, k, _, s in rows]
    assert ties(f(got)) == ties(f(want))


def test_ann_edges(spark):
    none = spark.createDataFrame([], "item_id long, vector array<double>")
    assert A.neighbours(none).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0])], "item_id long, vector array<double>")
    assert A.neighbours(one).count() == 0
