"""Item feature pipelines with fit/transform split.

Fitted state is always a small DataFrame (vocabulary with idf, feature
moments); transforms are joins against it, broadcast or not by measured size.
Features are kept sparse in long form ``(item, feature, value)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

# fixed values: the title vectorizer's token rule (two or more word characters)
TOKEN_PATTERN = r"(?U)\b\w\w+\b"


def title_terms(df: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """Lower-cased unigrams and adjacent bigrams with in-document counts."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    t = df.select(doc_col, toks.alias("_t"))
    bigrams = F.zip_with(F.col("_t"), F.slice(F.col("_t"), 2, 1 << 30),
                         lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    allt = F.concat(F.col("_t"), F.filter(bigrams, lambda x: x.isNotNull()))
    return t.select(doc_col, F.explode(allt).alias("term")).groupBy(doc_col, "term").agg(
        F.count(F.lit(1)).alias("tf"))


def fit_tfidf(df: DataFrame, doc_col: str, text_col: str, min_df: int = 5, max_features: int = 1000) -> DataFrame:
    """M5 fit: vocabulary (terms in >= min_df docs, top ``max_features`` by
    corpus count, ties by term) with smooth idf ln((1+n)/(1+df)) + 1."""
    n = df.select(doc_col).count()
    tf = title_terms(df, doc_col, text_col)
    st = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf")) \
        .where(F.col("df") >= min_df)
    voc = st.orderBy(F.col("ttf").desc(), F.col("term")).limit(max_features)
    return voc.select("term", "df", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


def transform_tfidf(df: DataFrame, vocab: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """M5 transform: L2-normalised tf * idf per document, sparse long form."""
    w = title_terms(df, doc_col, text_col).join(vocab.select("term", "idf"), "term") \
        .select(doc_col, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = w.groupBy(doc_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return w.join(norm, doc_col).select(doc_col, "term", (F.col("w") / F.col("_norm")).alias("tfidf"))


def genre_counts(df: DataFrame, doc_col: str, genres_col: str) -> DataFrame:
    """M6: multi-hot genre counts (lower-cased, '|'-separated), sparse long form."""
    g = F.split(F.lower(F.coalesce(F.col(genres_col), F.lit(""))), r"\|")
    return df.select(doc_col, F.explode(g).alias("genre")).groupBy(doc_col, "genre").agg(
        F.count(F.lit(1)).alias("count"))


def fit_scaler(df: DataFrame, cols, fill=0.0) -> DataFrame:
    """M7/M8 fit: constant imputation, then mean and *population* std per
    column (zero variance -> scale 1).  One row, one pair per column."""
    aggs = []
    for c in cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(float(fill)))
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    return df.agg(*aggs)


def transform_scaler(df: DataFrame, moments: DataFrame, cols, fill=0.0) -> DataFrame:
    m = moments.first()
    out = df
    for c in cols:
        mean, sd = m[f"{c}__mean"] or 0.0, m[f"{c}__std"] or 0.0
        sd = sd if sd and sd > 0 else 1.0
        x = F.coalesce(F.col(c).cast("double"), F.lit(float(fill)))
        out = out.withColumn(c, (x - F.lit(mean)) / F.lit(sd))
    return out


def assemble_sparse(parts) -> DataFrame:
    """M9: union of (item, feature, value) blocks with prefixed feature names."""
    out = None
    for prefix, df, doc, name_col, val_col in parts:
        blk = df.select(F.col(doc).alias("movieId"), F.concat(F.lit(prefix + ":"), F.col(name_col)).alias("feature"),
                        F.col(val_col).cast("double").alias("value"))
        out = blk if out is None else out.unionByName(blk)
    return out


def sparse_moments(feats: DataFrame, n_items: int) -> DataFrame:
    """M9 outer fit: (feature, mean, std) over the (dense) item x feature matrix,
    from the sparse entries: absent entries are zeros, so mean = sum/n and
    var = sumsq/n - mean^2; zero variance -> 1."""
    mom = feats.groupBy("feature").agg((F.sum("value") / n_items).alias("mean"),
                                       (F.sum(F.col("value") * F.col("value")) / n_items).alias("ex2"))
    sd = F.sqrt(F.greatest(F.col("ex2") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    return mom.select("feature", "mean", F.when(sd <= 1e-12, F.lit(1.0)).otherwise(sd).alias("std"))


def apply_moments(feats: DataFrame, moments: DataFrame) -> DataFrame:
    """M9 outer transform: scaled present entries of known features, and each
    feature's value for absent entries (-mean/std)."""
    return feats.join(moments, "feature").select("movieId", "feature", ((F.col("value") - F.col("mean")) / F.col("std")).alias("value"),
                                                 (-F.col("mean") / F.col("std")).alias("absent_value"))


def scale_sparse(feats: DataFrame, n_items: int) -> DataFrame:
    """M9 outer scaler, fitted on what it transforms."""
    return apply_moments(feats, sparse_moments(feats, n_items))


def one_row(rows: DataFrame, key: str = "movieId", ts: str = "event_timestamp", which: str = "first") -> DataFrame:
    """Ledger Q7: the first (the reference's choice) or last row of each item."""
    pick = {"first": F.min_by, "last": F.max_by}[which]
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(pick(F.struct(*rest), F.struct(ts, *[c for c in rest if c != ts])).alias("_v")).select(key, "_v.*")


def end_rows(rows: DataFrame, early: Column, key: str = "movieId", ts: str = "event_timestamp") -> DataFrame:
    """:func:`one_row` of two periods in one pass: each item's first row where
    ``early`` holds and its last row where it doesn't, with ``early``."""
    rest = [c for c in rows.columns if c != key]
    row, at = F.struct(*rest), F.struct(ts, *[c for c in rest if c != ts])
    ends = rows.groupBy(key).agg(F.min_by(row, F.when(early, at)).alias("_first"), F.max_by(row, F.when(~early, at)).alias("_last"))
    both = F.array(F.struct(F.lit(True).alias("early"), F.col("_first").alias("row")), F.struct(F.lit(False).alias("early"), F.col("_last").alias("row")))
    return ends.select(key, F.explode(both).alias("_e")).where("_e.row is not null").select(key, "_e.early", "_e.row.*")


@dataclass(frozen=True)
class ItemPipeline:
    """M8/M9 as fitted tables: title vocabulary with idf, moments of the
    aggregates, moments of all features.  Rows have movieId, title, genres and the
    aggregates; what a fit hasn't seen (terms, genres) is left out."""

    vocab: DataFrame
    inner: DataFrame
    outer: DataFrame
    stats: tuple

    @staticmethod
    def _features(rows: DataFrame, vocab: DataFrame, inner: DataFrame, stats) -> DataFrame:
        scaled = transform_scaler(rows.select("movieId", *stats), inner, stats)
        long = scaled.select("movieId", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("v")) for c in stats])).alias("a")).select("movieId", "a.*")
        return assemble_sparse([("title", transform_tfidf(rows, vocab, "movieId", "title"), "movieId", "term", "tfidf"),
                                ("genre", genre_counts(rows, "movieId", "genres"), "movieId", "genre", "count"), ("agg", long, "movieId", "name", "v")])

    @classmethod
    def fit(cls, rows: DataFrame, stats, min_df: int = 5, max_features: int = 1000) -> ItemPipeline:
        """``rows``: one for each item, see :func:`one_row`."""
        rows, stats = written(rows, "pipeline-rows"), tuple(stats)
        vocab = written(fit_tfidf(rows, "movieId", "title", min_df, max_features), "pipeline-vocab")
        inner = written(fit_scaler(rows, stats), "pipeline-inner")
        return cls(vocab, inner, sparse_moments(cls._features(rows, vocab, inner, stats), rows.count()), stats)

    def save(self, path: str) -> None:
        for name in ("vocab", "inner", "outer"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark, path: str) -> ItemPipeline:
        vocab, inner, outer = (spark.read.parquet(f"{path}/{n}") for n in ("vocab", "inner", "outer"))
        return cls(vocab, inner, outer, tuple(c[:-len("__mean")] for c in inner.columns if c.endswith("__mean")))

    def transform(self, rows: DataFrame) -> DataFrame:
        """(movieId, feature, value, absent_value) of rows, seen or not."""
        return apply_moments(self._features(rows, self.vocab, self.inner, self.stats), self.outer)

    def item_entries(self, items: DataFrame) -> DataFrame:
        """(movieId, feature, value): title and genre features of items with
        movieId, title, genres, scaled but not centred, so that absent entries
        stay 0.  A linear model's intercept takes up the centres."""
        long = assemble_sparse([("title", transform_tfidf(items, self.vocab, "movieId", "title"), "movieId", "term", "tfidf"),
                                ("genre", genre_counts(items, "movieId", "genres"), "movieId", "genre", "count")])
        return long.join(self.outer, "feature").select("movieId", "feature", (F.col("value") / F.col("std")).alias("value"))

    def scaled_stats(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their aggregates scaled as the fit says."""
        std = {r["feature"]: r["std"] for r in self.outer.where(F.col("feature").startswith("agg:")).collect()}
        out = transform_scaler(rows, self.inner, self.stats)
        return out.withColumns({c: F.col(c) / F.lit(std.get(f"agg:{c}", 1.0)) for c in self.stats})


def catalog(id_map: DataFrame, first_meta: DataFrame, item_col: str = "movieId") -> DataFrame:
    """Every index 0..n (n = the padding/unknown row) with first-seen
    metadata, type-aware filled.  The index range comes from the map itself
    plus one padding row, not from a generated range."""
    spark = id_map.sparkSession
    n = id_map.count()
    pad = spark.createDataFrame([(n,)], "idx long")
    idx = id_map.select(F.col("idx"), F.col("raw_id").alias(item_col)).unionByName(pad, allowMissingColumns=True)
    out = idx.join(first_meta, item_col, "left").withColumnRenamed("idx", "item_indice")
    from .prep import typed_fill
    return typed_fill(out)


def align_vectors(id_map: DataFrame, vectors: DataFrame, dim: int, item_col: str = "movieId") -> DataFrame:
    """One vector per catalogue index; items without a vector get the
    zero vector, vectors of unknown items are dropped (padding row excluded)."""
    v = vectors.select(F.col("item_id").alias(item_col), "vector")
    out = id_map.select(F.col("idx").alias("item_indice"), F.col("raw_id").alias(item_col)).join(v, item_col, "left")
    return out.withColumn("vector", F.coalesce(F.col("vector"), F.array_repeat(F.lit(0.0), dim)))
