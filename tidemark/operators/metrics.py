"""Evaluation and drift metrics.

Curves and rank statistics are computed from a per-score pre-aggregate
followed by a running sum over range partitions of the scores,
never a global single-partition window over the raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash64
from .quantiles import quantiles
from .scan import prefix

LOG_CLAMP = -100.0      # fixed value: BCE clamps log() at -100
KS_C_ALPHA = 1.358      # fixed value: two-sample KS critical constant at alpha = 0.05
PSI_EPS = 1e-4          # proportion floor inside PSI logs


def score_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score: positives, negatives, and the counts strictly
    below it (``pos_below``, ``neg_below``) via a distributed prefix."""
    g = df.groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("pos"),
                              F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    s = prefix(g, [score], ["pos", "neg"])
    return s.select(score, "pos", "neg", F.col("_cum_pos").alias("pos_below"), F.col("_cum_neg").alias("neg_below"))


def classification_metrics(df: DataFrame, label: str = "label", score: str = "score",
                           pos_weight: float = 1.0) -> DataFrame:
    """Counts, mean prediction, ROC-AUC (average ranks on ties),
    average precision (step sum), precision/recall/F1 at 0.5 (zero division
    -> 0), BCE and weighted BCE (log clamped at -100).  Three aggregate passes
    with O(1) results; the one-row answer is assembled from them."""
    y = F.col(label).cast("double")
    p = F.col(score).cast("double")
    lp = F.greatest(F.log(p), F.lit(LOG_CLAMP))
    lq = F.greatest(F.log(F.lit(1.0) - p), F.lit(LOG_CLAMP))
    bce = -(y * lp + (F.lit(1.0) - y) * lq)
    w = F.when(y == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0))
    pred = p >= 0.5
    b = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("P"),
               F.avg(p).alias("mean_pred"), F.avg(bce).alias("bce"), F.avg(bce * w).alias("wbce"),
               F.count_if(pred & (y == 1)).alias("tp"), F.count_if(pred & (y == 0)).alias("fp")).first()
    n, P = b["n"], b["P"] or 0
    N = n - P
    st = score_table(df, label, score)
    tp = F.lit(P) - F.col("pos_below")
    fp = F.lit(N) - F.col("neg_below")
    t = st.agg(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)).alias("auc_num"),
               F.sum(F.when(F.col("pos") > 0, (F.col("pos") / F.lit(max(P, 1))) * (tp / (tp + fp)))
                     .otherwise(0.0)).alias("ap")).first()
    prec = b["tp"] / (b["tp"] + b["fp"]) if (b["tp"] + b["fp"]) else 0.0
    rec = b["tp"] / P if P else 0.0
    f1 = 2 * prec * rec / max(prec + rec, 1e-12)
    auc = t["auc_num"] / (P * N) if P and N else None
    row = [(n, P, N, b["mean_pred"], auc, t["ap"], float(prec), float(rec), float(f1), b["bce"], b["wbce"])]
    return df.sparkSession.createDataFrame(
        row, "num_pairs long, num_pos long, num_neg long, mean_pred double, roc_auc double, avg_precision double, "
             "precision_at_05 double, recall_at_05 double, f1_at_05 double, bce double, weighted_bce double")


def roc_pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct threshold s (predict positive when
    score >= s): tp, fp, fpr, tpr, precision, recall."""
    tot = df.agg(F.sum(F.col(label).cast("long")).alias("P"), F.count(F.lit(1)).alias("n")).first()
    P, N = tot["P"] or 0, tot["n"] - (tot["P"] or 0)
    st = score_table(df, label, score)
    tp = F.lit(P) - F.col("pos_below")
    fp = F.lit(N) - F.col("neg_below")
    return st.select(F.col(score).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                     (fp / F.lit(max(N, 1))).alias("fpr"), (tp / F.lit(max(P, 1))).alias("tpr"),
                     (tp / (tp + fp)).alias("precision"), (tp / F.lit(max(P, 1))).alias("recall"))


def pr_table(df: DataFrame, id_col: str, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """For the top 1/bins, 2/bins, ... of rows by score (ties by id):
    count, lowest score, tp, fp, precision, recall.  Row ranks come from a
    distributed prefix count; each row is counted in its own bin and the
    bins are accumulated over ``bins`` rows."""
    n = df.count()
    P = df.agg(F.sum(F.col(label).cast("long"))).first()[0] or 0
    base = df.select(id_col, label, score, (-F.col(score)).alias("_ns"), F.lit(1).cast("long").alias("_one"))
    r = prefix(base, ["_ns", id_col], ["_one"]) \
        .withColumn("_rank", F.col("_cum__one") + 1)
    r = r.withColumn("bin", F.ceil(F.col("_rank") * F.lit(bins) / F.lit(n)).cast("int"))
    per = r.groupBy("bin").agg(F.count(F.lit(1)).alias("c"), F.min(score).alias("lo"),
                               F.sum(F.col(label).cast("long")).alias("tp_b"))
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # <= bins rows
    out = per.select("bin", F.sum("c").over(w).alias("count"), F.min("lo").over(w).alias("prob"),
                     F.sum("tp_b").over(w).alias("tp"))
    return out.select("bin", "count", "prob", "tp", (F.col("count") - F.col("tp")).alias("fp"),
                      (F.col("tp") / F.col("count")).alias("precision"),
                      (F.col("tp") / F.lit(max(P, 1))).alias("recall"))


def score_histogram(df: DataFrame, label: str = "label", score: str = "score", bins: int = 50) -> DataFrame:
    """Counts per label in ``bins`` equal bins over [0, 1] (last bin closed)."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(F.col(label).alias("label"), b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def rec_eval_join(recs: DataFrame, labels: DataFrame, user_col="userId", item_col="movieId",
                  rating_col="rating", ts_col="event_timestamp") -> DataFrame:
    """Recommendations left-joined to the first label per (user, item);
    missing -> 0.0."""
    first = labels.groupBy(user_col, item_col).agg(F.min_by(rating_col, F.col(ts_col)).alias(rating_col))
    return recs.join(first, [user_col, item_col], "left").withColumn(
        rating_col, F.coalesce(F.col(rating_col), F.lit(0.0)))


def ranking_metrics(ev: DataFrame, truth: DataFrame, k: int, user_col="userId", item_col="movieId",
                    rank_col="rec_ranking", rel_col="rating", beta: float = 1.0) -> DataFrame:
    """Per user NDCG@k, precision@k, recall@k and F-beta@k with binary
    relevance (rating > 0); the ideal DCG uses min(#relevant, k) hits."""
    rel = (F.col(rel_col) > 0).cast("double")
    g = ev.where(F.col(rank_col) <= k).groupBy(user_col).agg(
        F.sum(rel / F.log2(F.col(rank_col) + 1.0)).alias("dcg"), F.sum(rel).alias("hits"))
    nrel = truth.where(F.col(rel_col) > 0).select(user_col, item_col).distinct().groupBy(user_col) \
        .agg(F.count(F.lit(1)).alias("n_rel"))
    j = g.join(nrel, user_col, "left").withColumn("n_rel", F.coalesce("n_rel", F.lit(0)))
    m = F.least(F.col("n_rel"), F.lit(k))
    idcg = F.aggregate(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), F.lit(0.0),
                       lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1.0))
    prec = F.col("hits") / F.lit(float(k))
    recl = F.when(F.col("n_rel") > 0, F.col("hits") / F.col("n_rel")).otherwise(F.lit(0.0))
    b2 = beta * beta
    return j.select(user_col, F.when(m > 0, F.col("dcg") / idcg).otherwise(F.lit(0.0)).alias("ndcg"),
                    prec.alias("precision"), recl.alias("recall"),
                    F.when(prec + recl > 0, (1 + b2) * prec * recl / (b2 * prec + recl)).otherwise(F.lit(0.0))
                    .alias("fbeta"))


# ------------------------------------------------------------------ drift

def psi(ref: DataFrame, cur: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Population stability index over reference quantile bins
    (edges = exact reference deciles; proportions floored at 1e-4)."""
    qs = [i / bins for i in range(1, bins)]
    edges = quantiles(ref, [col], qs)[col]

    def binned(df):
        x = F.col(col).cast("double")
        b = F.lit(0)
        for e in edges:
            b = b + (x > F.lit(e)).cast("int")
        return df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    nr, nc = ref.where(F.col(col).isNotNull()).count(), cur.where(F.col(col).isNotNull()).count()
    r = binned(ref).select("bin", (F.col("c") / nr).alias("pr"))
    c = binned(cur).select("bin", (F.col("c") / nc).alias("pc"))
    j = r.join(c, "bin", "full").select(F.greatest(F.coalesce("pr", F.lit(0.0)), F.lit(PSI_EPS)).alias("pr"),
                                         F.greatest(F.coalesce("pc", F.lit(0.0)), F.lit(PSI_EPS)).alias("pc"))
    return j.agg(F.sum((F.col("pc") - F.col("pr")) * F.log(F.col("pc") / F.col("pr"))).alias("psi")) \
        .select(F.lit(col).alias("column"), "psi", (F.col("psi") >= 0.1).alias("drifted"))


def ks(ref: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov D over the merged distinct values
    (distributed prefix of per-value counts), drift when D exceeds the
    alpha = 0.05 critical value."""
    x = F.col(col).cast("double")
    u = ref.select(x.alias("x"), F.lit(1).cast("long").alias("a"), F.lit(0).cast("long").alias("b")) \
        .unionByName(cur.select(x.alias("x"), F.lit(0).cast("long").alias("a"), F.lit(1).cast("long").alias("b"))) \
        .where(F.col("x").isNotNull())
    per = u.groupBy("x").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    n = per.agg(F.sum("a").alias("na"), F.sum("b").alias("nb")).first()
    na, nb = n["na"], n["nb"]
    s = prefix(per, ["x"], ["a", "b"])
    d = s.agg(F.max(F.abs((F.col("_cum_a") + F.col("a")) / F.lit(na) - (F.col("_cum_b") + F.col("b")) / F.lit(nb)))
              .alias("ks_d"))
    crit = KS_C_ALPHA * ((na + nb) / (na * nb)) ** 0.5
    return d.select(F.lit(col).alias("column"), "ks_d", F.lit(crit).alias("critical"),
                    (F.col("ks_d") > F.lit(crit)).alias("drifted"))


def jensen_shannon(ref: DataFrame, cur: DataFrame, col: str, threshold: float = 0.1) -> DataFrame:
    """Jensen-Shannon distance (natural log) between category shares."""
    r = ref.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    c = cur.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    nr, nc = ref.count(), cur.count()
    j = r.select("v", (F.col("c") / nr).alias("p")).join(c.select("v", (F.col("c") / nc).alias("q")), "v", "full") \
        .select(F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    kl = lambda a: F.when(F.col(a) > 0, F.col(a) * F.log(F.col(a) / m)).otherwise(F.lit(0.0))
    return j.agg(F.sqrt(F.greatest(F.sum(kl("p") * 0.5 + kl("q") * 0.5), F.lit(0.0))).alias("js")) \
        .select(F.lit(col).alias("column"), "js", (F.col("js") >= threshold).alias("drifted"))


def dataset_drift(columns: DataFrame, share: float = 0.5) -> DataFrame:
    """One row for a table of (column, drifted): the number of columns, of
    drifted ones, their share, and whether that share reaches ``share``.  A
    column without a decision (NULL) counts as not drifted; no columns, no drift."""
    n, d = F.count(F.lit(1)), F.count_if(F.col("drifted"))
    return columns.agg(n.alias("n_columns"), d.alias("n_drifted"), F.coalesce(d / F.nullif(n, F.lit(0)), F.lit(0.0)).alias("drift_share")) \
        .withColumn("dataset_drift", (F.col("n_columns") > 0) & (F.col("drift_share") >= share))


def reference_sample(df: DataFrame, id_cols, n: int = 10000, seed=0) -> DataFrame:
    """E11 (Q18): deterministic sample of n rows, ordered by a keyed hash."""
    h = hash64(F.lit(str(seed)), *[F.col(c) for c in id_cols])
    return df.withColumn("sample_key", h).orderBy("sample_key", *id_cols).limit(n)
