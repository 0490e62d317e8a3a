"""Retrieval: popularity, exact vector top-k, candidates, batch recommendation
(A1, T2, F18, M11, M12, M15, J13/M17, U3, M18, A20).

Exact top-k over vectors uses a blocked scheme instead of a row-level cross
join: queries and candidates are cut into blocks of about ``block_size`` rows;
every (query block, candidate block) pair is one cogroup task that does NumPy
matrix products, ``TILE`` query rows at a time, and emits only its top-k per
query row; a final row_number over the k x n_blocks survivors per query picks the
global top-k.  A row is copied once for each block of the other side, in the
type it came in; task memory is bounded by the block size and ``TILE``, output
by k.  Queries with one vector are one query (:func:`user_topk`).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cosine, dot, l2norm, sigmoid
from ..session import written
from .store import online_lookup

TILE = 1 << 21    # scores that a task holds at once
MIN_TILES = 24    # pairs of blocks, so that a few large blocks don't leave tasks idle
MIN_BLOCK = 256   # rows of a query block that are worth a task


def popularity(events: DataFrame, item_col: str = "movieId") -> DataFrame:
    """A1: interactions per item (partial + final hash aggregate)."""
    return events.groupBy(item_col).agg(F.count(F.lit(1)).alias("score"))


def top_popular(pop: DataFrame, k: int, item_col: str = "movieId") -> DataFrame:
    """T2/W9 (Q20): top-k by score, ties by the id *as text* descending; rank
    1..k.  ``orderBy().limit()`` plans as a distributed TakeOrderedAndProject."""
    top = pop.orderBy(F.col("score").desc(), F.col(item_col).cast("string").desc()).limit(k)
    w = Window.orderBy(F.col("score").desc(), F.col(item_col).cast("string").desc())
    return top.withColumn("rank", F.row_number().over(w))  # k rows only


def pair_scores(pairs: DataFrame, vectors: DataFrame, a: str, b: str) -> DataFrame:
    """Dot, cosine and sigmoid(dot) for (a, b) item pairs."""
    va = vectors.select(F.col("item_id").alias(a), F.col("vector").alias("_va"))
    vb = vectors.select(F.col("item_id").alias(b), F.col("vector").alias("_vb"))
    j = pairs.join(va, a).join(vb, b)
    return j.select(*pairs.columns, dot("_va", "_vb").alias("dot"), cosine("_va", "_vb").alias("cosine"),
                    sigmoid(dot("_va", "_vb")).alias("prob"))


def _blocks(df: DataFrame, id_col: str, n_blocks: int) -> DataFrame:
    return df.withColumn("_blk", F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_blocks)).cast("int"))


def blocked_topk(queries: DataFrame, cands: DataFrame, k: int, metric: str = "cosine",
                 exclude_self: bool = False, block_size: int = 16384, eps: float = 1e-12) -> DataFrame:
    """Exact top-k candidates per query by ``dot`` or ``cosine``.

    ``queries``: (qid, vector); ``cands``: (cid, vector).  Returns
    (qid, rank, cid, score), ties broken by smaller cid."""
    import numpy as np
    import pandas as pd

    nq = queries.count()
    nc = cands.count()
    bc = max(1, math.ceil(nc / block_size))
    bq = max(1, math.ceil(nq / block_size), min(math.ceil(MIN_TILES / bc), nq // MIN_BLOCK))
    q = _blocks(queries.select(F.col("qid").alias("qid"), F.col("vector").alias("qvec")), "qid", bq) \
        .withColumnRenamed("_blk", "qb")
    c = _blocks(cands.select(F.col("cid").alias("cid"), F.col("vector").alias("cvec")), "cid", bc) \
        .withColumnRenamed("_blk", "cb")
    # each query row goes to every candidate block and vice versa: copies are
    # n_blocks per row, the pair key (qb, cb) is an equi-join key
    qx = q.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(bc - 1))))
    cx = c.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(bq - 1))))

    def score_block(qp: pd.DataFrame, cp: pd.DataFrame) -> pd.DataFrame:
        if qp.empty or cp.empty:
            return pd.DataFrame({"qid": [], "cid": [], "score": []})
        A = np.stack(qp["qvec"].to_numpy()).astype(np.float64)
        B = np.stack(cp["cvec"].to_numpy()).astype(np.float64)
        qids = qp["qid"].to_numpy()
        cids = cp["cid"].to_numpy()
        kk = min(k, len(cids))
        if metric == "cosine":
            na = np.linalg.norm(A, axis=1)[:, None]
            nb = np.linalg.norm(B, axis=1)[None, :]
        step = max(1, TILE // len(cids))
        # order by score desc, then cid asc: lexsort on (cid, -score)
        out_q, out_c, out_s = [], [], []
        for lo in range(0, len(A), step):
            S = A[lo:lo + step] @ B.T
            if metric == "cosine":
                S = S / np.maximum(na[lo:lo + step] * nb, eps)
            if exclude_self:
                S = np.where(qids[lo:lo + step, None] == cids[None, :], -np.inf, S)
            # the k-th score of each row; every candidate tied with it stays, so that ties resolve by id
            kth = np.partition(S, S.shape[1] - kk, axis=1)[:, S.shape[1] - kk]
            r, c = np.nonzero((S >= kth[:, None]) & np.isfinite(S))
            score = S[r, c]
            o = np.lexsort((cids[c], -score, r))
            r, c, score = r[o], c[o], score[o]
            first = np.searchsorted(r, np.arange(len(S)))
            ok = np.arange(len(r)) - first[r] < kk
            out_q.append(qids[lo + r[ok]])
            out_c.append(cids[c[ok]])
            out_s.append(score[ok])
        return pd.DataFrame({"qid": np.concatenate(out_q), "cid": np.concatenate(out_c),
                             "score": np.concatenate(out_s)})

    part = qx.groupBy("qb", "cb").cogroup(cx.groupBy("qb", "cb")).applyInPandas(
        lambda a, b: score_block(a, b), schema="qid long, cid long, score double")
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("cid"))
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("qid", "rank", "cid", "score")


def neighbours(vectors: DataFrame, k: int = 10, block_size: int = 16384, targets: DataFrame | None = None) -> DataFrame:
    """Each item's k most cosine-similar other items.  With ``targets``
    (a column ``item_id``, repeats allowed) only these items are asked for."""
    v = vectors.select(F.col("item_id").alias("qid"), "vector")
    asked = v if targets is None else v.join(targets.select(F.col("item_id").alias("qid")), "qid", "left_semi")
    top = blocked_topk(asked, v.withColumnRenamed("qid", "cid"), k, "cosine", exclude_self=True, block_size=block_size)
    return top.select(F.col("qid").alias("target_item"), "rank", F.col("cid").alias("rec_item"), "score")


def neighbour_records(nb: DataFrame) -> DataFrame:
    """M12 record form: (target_item, rec_item_ids[], rec_scores[]) in rank order."""
    g = nb.groupBy("target_item").agg(F.sort_array(F.collect_list(F.struct("rank", "rec_item", "score"))).alias("l"))
    return g.select("target_item", F.transform("l", lambda x: x["rec_item"]).alias("rec_item_ids"),
                    F.transform("l", lambda x: x["score"]).alias("rec_scores"))


def last_item(events: DataFrame, user_col="userId", item_col="movieId", ts_col="event_timestamp") -> DataFrame:
    return events.groupBy(user_col).agg(F.max_by(item_col, F.struct(ts_col, item_col)).alias("last_item"))


def recent_seen(events: DataFrame, n: int = 10, user_col="userId", item_col="movieId", ts_col="event_timestamp") -> DataFrame:
    """(user, item) of each user's ``n`` latest events by (time, item), the
    list that the serving step leaves out.  The rank filter cuts each task's
    share of a user to ``n`` rows before the shuffle."""
    w = Window.partitionBy(user_col).orderBy(F.desc(ts_col), F.desc(item_col))
    last = events.select(user_col, item_col, ts_col).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return last.select(user_col, item_col).distinct()


def scoring_rows(cands: DataFrame, item_snapshot: DataFrame, user_snapshot: DataFrame, features, user_col="userId", item_col="movieId") -> DataFrame:
    """Candidates with the latest features of item and user from the online
    snapshots (``features`` from either; an unknown item or user has 0)."""
    own = lambda snap, key: snap.select(key, *[c for c in snap.columns if c in features])
    rows = online_lookup(online_lookup(cands, own(item_snapshot, item_col), [item_col]), own(user_snapshot, user_col), [user_col])
    return rows.select(*cands.columns, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])


def candidate_set(users_last: DataFrame, top_pop_ids, nb: DataFrame, seen: DataFrame, cap: int = 100,
                  user_col: str = "userId", item_col: str = "movieId") -> DataFrame:
    """Popular ids (a bounded list) plus neighbours of the user's last
    item, minus seen items, capped at ``cap`` by (source, rank)."""
    pop = users_last.select(user_col, F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("item"),
                                                                    F.lit(r + 1).alias("rank"))
                                                          for r, i in enumerate(top_pop_ids)])).alias("p")) \
        .select(user_col, F.col("p.item").alias(item_col), F.lit(0).alias("src"), F.col("p.rank").alias("rank"))
    sim = users_last.join(nb, users_last.last_item == nb.target_item) \
        .select(user_col, F.col("rec_item").alias(item_col), F.lit(1).alias("src"), "rank")
    u = pop.unionByName(sim).groupBy(user_col, item_col).agg(F.min(F.struct("src", "rank")).alias("o"))
    u = u.join(seen.select(user_col, item_col).distinct(), [user_col, item_col], "left_anti")
    w = Window.partitionBy(user_col).orderBy("o", item_col)
    return u.withColumn("cand_rank", F.row_number().over(w)).where(F.col("cand_rank") <= cap) \
        .select(user_col, item_col, "cand_rank")


def last_known(events: DataFrame, vectors: DataFrame, user_col="userId", item_col="movieId", ts_col="event_timestamp") -> DataFrame:
    """(user, _last): each user's most recent item that has a vector, else null.

    Only ids travel with the events, and one aggregate serves both."""
    known = events.join(vectors.select(F.col("item_id").alias(item_col), F.lit(True).alias("_known")).distinct(), item_col, "left")
    return known.groupBy(user_col).agg(F.max_by(item_col, F.when(F.col("_known"), F.struct(ts_col, item_col))).alias("_last"))


def _zero(vectors: DataFrame):
    dim = vectors.select(F.max(F.size("vector"))).first()[0] or 0
    return F.array_repeat(F.lit(0.0), dim).cast(vectors.schema["vector"].dataType)


def user_vectors(events: DataFrame, vectors: DataFrame, user_col="userId", item_col="movieId",
                 ts_col="event_timestamp") -> DataFrame:
    """One row per user: the vector of their most recent item that has one.  A
    user without such an item gets the zero vector, so that every item scores 0
    and ties go to the smallest ids; no user is lost.

    The vector is joined once, to the one item kept per user."""
    v = vectors.select(F.col("item_id").alias("_last"), "vector")
    users = last_known(events, vectors, user_col, item_col, ts_col).join(v, "_last", "left")
    return users.select(user_col, F.coalesce("vector", _zero(vectors)).alias("vector"))


def user_topk(events: DataFrame, vectors: DataFrame, k: int, user_col="userId", item_col="movieId", ts_col="event_timestamp") -> DataFrame:
    """(user, item, score, rec_ranking): the k best of all items by dot product
    with :func:`user_vectors`.

    Users whose vector is that of one item have one list: a search for each item
    that is some user's last, and one for the users who have none (id null
    there), then a join by that item."""
    users = written(last_known(events, vectors, user_col, item_col, ts_col), "user-last")
    v = vectors.select(F.col("item_id").alias("_last"), "vector")
    asked = users.select("_last").distinct().join(v, "_last", "left").select("_last", F.coalesce("vector", _zero(vectors)).alias("vector"))
    asked = written(asked.withColumn("qid", F.monotonically_increasing_id()), "user-queries")
    top = blocked_topk(asked.select("qid", "vector"), vectors.select(F.col("item_id").alias("cid"), "vector"), k, "dot")
    lists = top.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "cid", "score"))).alias("_list"))  # k of each
    lists = asked.select("qid", F.col("_last").alias("_item")).join(lists, "qid").select("_item", "_list")
    got = users.join(lists, F.col("_last").eqNullSafe(F.col("_item"))).select(user_col, F.explode("_list").alias("_x"))
    return got.select(user_col, F.col("_x.cid").alias(item_col), F.col("_x.score").alias("score"), F.col("_x.rank").alias("rec_ranking"))


def top_k_by_score(scored: DataFrame, k: int, user_col="userId", item_col="movieId") -> DataFrame:
    """Rank 1..k per user by (score desc, item asc)."""
    w = Window.partitionBy(user_col).orderBy(F.col("score").desc(), F.col(item_col))
    return scored.withColumn("rec_ranking", F.row_number().over(w)).where(F.col("rec_ranking") <= k)


def best_run(runs: DataFrame, group: str, metric: str, version: str, mode: str = "max") -> DataFrame:
    """Champion per group: best metric, newer version wins ties."""
    m = F.col(metric) if mode == "max" else -F.col(metric)
    return runs.groupBy(group).agg(F.max_by(F.struct(*[F.col(c) for c in runs.columns if c != group]),
                                            F.struct(m, F.col(version))).alias("_v")).select(group, "_v.*")
