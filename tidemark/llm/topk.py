"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length: a bucket holds norms within a factor of
``ratio``, cut by a hash of the id into blocks of about ``block_rows`` rows, so
that many vectors of one length don't make a large group.  Queries are dealt
into blocks of about ``query_rows``.

1. Each query's best k among the longest vectors (whole buckets from the top
   until ``seed_rows``, capped at a block of each bucket) give a lower bound
   theta on its k-th score.
2. A query meets only buckets with |q| * (largest norm) >= theta.  Queries of
   like theta / |q| share blocks, and vectors are copied only to the blocks of
   queries that their bucket is left for.
3. In a block, theta gives the query's local cosine threshold
   t = theta / (|q| * largest norm of the block).  If t is at least
   ``coordinate_from``, candidates are pruned by coordinates: a vector with a
   cosine of t or more must have, in each of the query's ``focus`` largest
   coordinates, a value within arccos t (as an angle) of the query's.
   Otherwise they are pruned by length: only norms of at least theta / |q|.
4. What is left is verified by exact integer products; each block returns its
   best k of each query, ties to the smaller id, and the best k of those are kept.

Edge cases: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows with a null id; every row is a candidate,
but for rows with the query's own id; an id on several query rows gets the best of
all of them; vectors meet only vectors of the same dimension; zero vectors count (all products are 0); an empty table
gives no rows; fewer than k candidates are all returned; other columns are
ignored.  Scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

NO_BOUND = -(1 << 62)


def integers(vec: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component, null for vectors that take no part."""
    x = vec.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when((F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def vectors(table: DataFrame, vec_id: str, vec: str, ratio: float) -> DataFrame:
    """(vec_id, v, dim, norm, bucket) of every row that takes part."""
    v = table.select(F.col(vec_id).cast("long").alias("vec_id"), integers(F.col(vec)).alias("v")).where("vec_id is not null and v is not null")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    v = v.select("vec_id", "v", F.size("v").alias("dim"), norm.alias("norm"))
    return v.withColumn("bucket", F.when(F.col("norm") > 0, F.floor(F.log("norm") / float(np.log(ratio))).cast("int")).otherwise(F.lit(-1)))


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest scores, ties to the smaller id, in order."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))][:k]


def block_topk(q: np.ndarray, qid: np.ndarray, theta: np.ndarray, c: np.ndarray, cid: np.ndarray, k: int,
               coordinate_from: float = 0.7, focus: int = 3) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query index, candidate ids, scores) of each query's best k candidates
    with a score of at least its ``theta`` in one block."""
    qn, cn = (np.sqrt((x.astype(float) ** 2).sum(axis=1)) for x in (q, c))
    o = np.argsort(-cn, kind="stable")
    c, cid, cn = c[o], cid[o], cn[o]
    exact = float if qn.max() * cn[0] < 2.0 ** 52 else np.int64  # both give whole products
    qx, cx = q.astype(exact), c.astype(exact)
    slack = 1 - 1e-9
    t = np.where((qn > 0) & (cn[0] > 0), theta / np.maximum(qn * cn[0], 1e-300), -1.0) * slack
    out = []

    def add(i: int, at: np.ndarray, s: np.ndarray) -> None:
        keep = (s >= theta[i]) & (cid[at] != qid[i])
        at, s = at[keep], s[keep]
        b = best(s, cid[at], k)
        if len(b):
            out.append((i, cid[at[b]], s[b].astype(np.int64)))

    unit = c / np.maximum(cn, 1e-300)[:, None]
    for i in np.flatnonzero((t >= coordinate_from) & (t <= 1)):
        u = q[i] / qn[i]
        at = np.arange(len(c))
        for f in np.argsort(-np.abs(u))[:focus]:
            width = np.sqrt(max(0.0, (1 - u[f] ** 2) * (1 - t[i] ** 2))) + 1e-9
            low = -2.0 if u[f] <= -t[i] else u[f] * t[i] - width
            high = 2.0 if u[f] >= t[i] else u[f] * t[i] + width
            x = unit[at, f]
            at = at[(x >= low) & (x <= high)]
        add(i, at, cx[at] @ qx[i])
    by_length = np.flatnonzero(t < coordinate_from)
    if len(by_length):
        need = np.where(qn[by_length] > 0, theta[by_length] / np.maximum(qn[by_length], 1e-300), -1.0) * slack
        reach = np.searchsorted(-cn, -np.where(need > 0, need, -1.0), side="right")
        for lo in range(0, len(by_length), 256):  # bounds the products held at once
            some, ends = by_length[lo:lo + 256], reach[lo:lo + 256]
            if ends.max() == 0:
                continue
            s = qx[some] @ cx[:ends.max()].T
            for j, i in enumerate(some):
                add(i, np.arange(ends[j]), s[j, :ends[j]])
    return out


def _matrix(t: pa.Table, name: str) -> np.ndarray:
    col = t.column(name).combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def topk(table: DataFrame, is_query: Column, vec_id: str = "vec_id", vec: str = "embedding", k: int = 20, ratio: float = 1.05,
         block_rows: int = 4096, query_rows: int = 1024, seed_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest integer inner
    products of each query with the other vectors; ``is_query`` is a condition
    on the column vec_id."""
    v = stored(vectors(table, vec_id, vec, ratio), "topk-vectors")
    # One row for each dimension and bucket: some hundreds of buckets at most,
    # as a norm spans no more than the powers of ``ratio`` in a long's range.
    sizes = v.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()
    n_query = v.where(is_query).count()
    if not n_query:
        return v.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    blocks = {(r["dim"], r["bucket"]): -(-r["n"] // block_rows) for r in sizes}
    seeds, got = [], {}
    for r in sorted(sizes, key=lambda r: -r["bucket"]):
        if got.get(r["dim"], 0) < seed_rows:
            seeds.append((r["dim"], r["bucket"]))
            got[r["dim"]] = got.get(r["dim"], 0) + min(r["n"], block_rows)
    cells = table.sparkSession.createDataFrame(
        [(r["dim"], r["bucket"], blocks[r["dim"], r["bucket"]], float(r["top"]), (r["dim"], r["bucket"]) in set(seeds)) for r in sizes],
        "dim int, bucket int, blocks int, top double, seed boolean")
    cand = v.join(F.broadcast(cells.select("dim", "bucket", "blocks", "seed")), ["dim", "bucket"]).select(
        "dim", "bucket", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), "vec_id", "v", "seed")
    query = v.where(is_query).select(F.col("vec_id").alias("qid"), F.col("v").alias("qv"), F.col("norm").alias("qn"), F.col("dim").alias("dim"))
    hashed = lambda n: F.pmod(F.xxhash64("qid", F.lit(1)), n).cast("int").alias("qb")

    def task(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if len(left) and len(right):
            qid = left.column("qid").to_numpy()
            rows = block_topk(_matrix(left, "qv"), qid, left.column("theta").to_numpy().astype(float), _matrix(right, "v"), right.column("vec_id").to_numpy(), k)
        cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        return pa.table({"query_id": cat([np.full(len(c), qid[i]) for i, c, _ in rows]), "vec_id": cat([c for _, c, _ in rows]), "score": cat([s for _, _, s in rows])})

    def meet(q: DataFrame, c: DataFrame) -> DataFrame:
        """Top k of each block of candidates and block of queries that meet."""
        key = ["dim", "bucket", "block", "level", "qb"]
        q = stored(q, "topk-asked")
        c = c.join(q.select(*[F.col(x).alias(x) for x in key]).distinct(), ["dim", "bucket", "block"])
        return q.groupBy(*key).cogroup(c.groupBy(*key)).applyInArrow(task, "query_id long, vec_id long, score long")

    seed_cells = F.broadcast(cells.where("seed").select("dim", "bucket", F.lit(0).alias("block")))  # a row a bucket at most, like cells
    first = query.select("*", F.lit(NO_BOUND).alias("theta"), F.lit(0).alias("level"), hashed(F.lit(-(-n_query // query_rows)))).join(seed_cells, "dim")
    found = meet(first, cand.where("seed and block = 0"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    theta = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(F.col("query_id").alias("qid"), F.col("score").alias("theta")), "topk-theta")
    bound = query.join(theta, "qid", "left").withColumn("theta", F.coalesce("theta", F.lit(NO_BOUND)))
    level = F.when((F.col("theta") > 0) & (F.col("qn") > 0), F.floor(F.log(F.col("theta") / F.col("qn")) / float(np.log(ratio))).cast("int")).otherwise(F.lit(-(1 << 30)))
    bound = stored(bound.withColumn("level", level), "topk-bound")
    # levels are powers of ``ratio``, like buckets
    levels = bound.groupBy("level").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("parts"))
    bound = bound.join(levels, "level").select("*", hashed(F.col("parts"))).drop("parts")
    bound = bound.join(F.broadcast(cells.select("dim", "bucket", "blocks", "top")), "dim").where(F.col("qn") * F.col("top") * (1 + 1e-9) >= F.col("theta"))
    bound = bound.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("top", "blocks")
    ranked = meet(bound, cand).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def oracle_sql(every: int = 20, k: int = 20) -> str:
    """DuckDB SQL for the registered query."""
    return f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {k}"""
