"""Approximate nearest neighbours by an inverted-list index.

``fit`` finds ``lists`` directions by k-means on a bounded sample of the unit
vectors; ``build`` puts *every* vector into the list of its closest direction;
``search`` scores a query only against the lists closest to it, and the scores of
what it finds are exact cosines.  How many lists a query looks into (``probes``)
comes from ``calibrated``: the fewest that find the wanted share of the exact
neighbours of a bounded sample of queries.

Lists are cut into chunks of at most ``block_rows`` vectors and the queries of a
list into blocks as large, so a list that holds a third of all vectors, or that
all queries look into, is many tasks.  Vectors are copied only to blocks of
queries that look into their list.  What the driver holds is bounded by
``lists`` and by the calibration sample.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .retrieval import blocked_topk

EPS = 1e-12


@dataclass(frozen=True)
class Index:
    """``rows``: (cid, vector, list); ``centres``: unit directions of the lists."""

    rows: DataFrame
    centres: np.ndarray
    probes: int = 0


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), EPS)


def _sample(df: DataFrame, id_col: str, rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if fewer), picked by a hash of the id."""
    share = rows / max(df.count(), 1)
    draw = F.abs(F.xxhash64(F.lit(seed), id_col) % (1 << 53)) / F.lit(float(1 << 53))
    return df if share >= 1 else df.where(draw < share)


def fit(vectors: DataFrame, lists: int | None = None, sample_rows: int = 65_536, seed: int = 3) -> np.ndarray:
    """Directions of the lists from at most about ``sample_rows`` of (cid, vector);
    by default the square root of the number of vectors, and one for 32 sampled
    rows at most."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = vectors.count()
    lists = lists or max(1, min(math.isqrt(n), sample_rows // 32))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    unit = F.when(norm > EPS, F.transform("vector", lambda x: x / norm))
    rows = _sample(vectors, "cid", sample_rows, seed).select(unit.alias("u")).where("u is not null").select(array_to_vector("u").alias("features"))
    first = rows.first()
    if first is None or lists < 2:  # one list
        return _unit(np.array([first["features"].toArray() if first else [0.0]]))
    model = KMeans(k=lists, seed=seed, maxIter=10).fit(written(rows.select("features"), "ann-sample"))
    return _unit(np.array([list(c) for c in model.clusterCenters()]))


def build(vectors: DataFrame, centres: np.ndarray) -> Index:
    """Every vector with the number of its list."""
    def assign(batches):
        for b in batches:
            x = _matrix(b.column(1))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(np.argmax(_unit(x) @ centres.T, axis=1).astype(np.int32) if len(x) else np.zeros(0, np.int32))],
                                  names=["cid", "vector", "list"])

    rows = vectors.select("cid", F.col("vector").cast("array<double>").alias("vector"))
    return Index(written(rows.mapInArrow(assign, "cid long, vector array<double>, list int"), "ann-lists"), centres)


def _ranked_lists(queries: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """(qid, qvec, list): the ``probes`` closest lists of each query."""
    def near(batches):
        for b in batches:
            if not b.num_rows:
                continue
            close = np.argsort(-(_unit(_matrix(b.column(1))) @ centres.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
            at = np.repeat(np.arange(len(close)), close.shape[1])
            yield pa.record_batch([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(close.ravel())], names=["qid", "qvec", "list"])

    return (queries.select("qid", F.col("vector").cast("array<double>").alias("vector"))
            .mapInArrow(near, "qid long, qvec array<double>, list int"))


def _best(k: int, exclude_self: bool):
    """The k best of a block of queries against a chunk of a list; ties to the smaller id."""
    def run(_, q, c):
        out = ([], [], [])
        if q.num_rows and c.num_rows:
            a, b = _matrix(q.column("qvec").combine_chunks()), _matrix(c.column("vector").combine_chunks())
            s = (a @ b.T) / np.maximum(np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :], EPS)
            qid, cid = q.column("qid").to_numpy(), c.column("cid").to_numpy()
            if exclude_self:
                s[qid[:, None] == cid[None, :]] = -np.inf
            n = min(k, s.shape[1])
            kth = -np.partition(-s, n - 1, axis=1)[:, n - 1]
            for i, row in enumerate(s):
                near = np.flatnonzero((row >= kth[i]) & np.isfinite(row))
                near = near[np.lexsort((cid[near], -row[near]))][:k]
                out[0].append(np.full(len(near), qid[i])), out[1].append(cid[near]), out[2].append(row[near])
        col = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
        return pa.table({"qid": col(out[0], pa.int64()), "cid": col(out[1], pa.int64()), "score": col(out[2], pa.float64())})
    return run


def search(index: Index, queries: DataFrame, k: int, probes: int | None = None, exclude_self: bool = False, block_rows: int = 2048) -> DataFrame:
    """(qid, rank, cid, score): the k best cosines among the lists that each
    query (qid, vector) looks into."""
    looked = written(_ranked_lists(queries, index.centres, probes or index.probes), "ann-probes")
    # a row a list; chunks of vectors and blocks of queries are counted from it
    sizes = index.rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("chunks"))
    asked = looked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    plan = written(sizes.join(asked, "list"), "ann-plan")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = looked.join(plan, "list").select("qid", "qvec", "list", F.pmod(F.xxhash64("qid"), "blocks").alias("block"), upto("chunks").alias("chunk"))
    c = index.rows.join(plan, "list").select("cid", "vector", "list", F.pmod(F.xxhash64("cid"), "chunks").alias("chunk"), upto("blocks").alias("block"))
    q, c = (df.withColumn("block", F.col("block").cast("int")).withColumn("chunk", F.col("chunk").cast("int")) for df in (q, c))
    key = ["list", "chunk", "block"]
    found = q.groupBy(*key).cogroup(c.groupBy(*key)).applyInArrow(_best(k, exclude_self), "qid long, cid long, score double")
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), "cid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("qid", "rank", "cid", "score")


def calibrated(index: Index, k: int, target: float = 0.9, margin: float = 0.03, sample_queries: int = 256, exclude_self: bool = True, seed: int = 5) -> Index:
    """The index with the fewest probes that find ``target`` + ``margin`` of the
    exact neighbours of about ``sample_queries`` of its own vectors."""
    sample = _sample(index.rows, "cid", sample_queries, seed).select(F.col("cid").alias("qid"), "vector")
    exact = blocked_topk(sample, index.rows.select("cid", "vector"), k, "cosine", exclude_self)
    homes = exact.join(index.rows.select("cid", "list"), "cid").select("qid", "list")
    order = _ranked_lists(sample, index.centres, len(index.centres)).groupBy("qid").agg(F.collect_list("list").alias("lists"))
    at = homes.join(order, "qid").select(F.array_position("lists", F.col("list")).alias("at"))
    counts = {r["at"]: r["count"] for r in at.groupBy("at").count().collect()}  # at most a row a list
    need, got, probes = min(1.0, target + margin) * sum(counts.values()), 0, 1
    for p in sorted(counts):
        if got >= need:
            break
        got, probes = got + counts[p], p
    return Index(index.rows, index.centres, probes)


def neighbours(vectors: DataFrame, queries: DataFrame | None = None, k: int = 10, target: float = 0.9, **options) -> DataFrame:
    """(target_item, rank, rec_item, score) of ``queries`` (item_id, vector;
    by default every item) among the other items of ``vectors``.  Null vectors
    take no part; a zero vector's cosine is 0."""
    rows = vectors.where("vector is not null and item_id is not null")
    base = rows.select(F.col("item_id").alias("cid"), F.col("vector").cast("array<double>").alias("vector"))
    index = calibrated(build(base, fit(base, **options)), k, target)
    asked = (rows if queries is None else queries.where("vector is not null and item_id is not null")).select(F.col("item_id").alias("qid"), "vector")
    top = search(index, asked, k, exclude_self=True)
    return top.select(F.col("qid").alias("target_item"), "rank", F.col("cid").alias("rec_item"), "score")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, exact neighbours, how many were found, and their share."""
    both = exact.join(found.select("target_item", "rec_item", F.lit(1).alias("_hit")), ["target_item", "rec_item"], "left")
    return both.agg(F.countDistinct("target_item").alias("n_queries"), F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_found")) \
        .withColumn("recall", F.col("n_found") / F.col("n_exact"))
