"""Adapters from the driver's test tables onto the recommender data model.

``L``: orders x lineitem, one row per (userId, movieId, event_timestamp) with
       rating = max(l_quantity); the key is unique and is the tie-breaker.
``E``: events, userId = user_id, movieId = props.k, rating = value.
Items come from ``part``; item vectors from ``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import epoch_seconds
from ..session import written

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan with an optional column list (pruned at the scan)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def interactions_L(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])
    od = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    g = (j.groupBy(F.col("o_custkey").cast("long").alias("userId"),
                   F.col("l_partkey").cast("long").alias("movieId"),
                   F.col("l_shipdate").cast("timestamp_ntz").alias("event_timestamp"))
          .agg(F.max("l_quantity").cast("double").alias("rating")))
    return g.withColumn("timestamp", epoch_seconds("event_timestamp"))


def interactions_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L as a table in the shared folder, for queries that read it more than
    once: the join and the aggregate that make it run once."""
    return written(interactions_L(spark, sf_dir), "interactions")


def interactions_E(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", ["user_id", "props", "value", "ts"])
    return ev.select(
        F.col("user_id").cast("long").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").cast("long").alias("movieId"),
        F.col("value").cast("double").alias("rating"),
        F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
    ).withColumn("timestamp", epoch_seconds("event_timestamp"))


def events_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E with a binary label (purchase) and a score in (0, 1) with ties."""
    ev = table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value", "ts"])
    return ev.select(
        "event_id", F.col("user_id").cast("long").alias("userId"), "ts",
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        F.round(F.lit(1.0) / (F.lit(1.0) + F.exp((F.lit(50.0) - F.col("value")) / F.lit(50.0))), 6).alias("score"),
    )


def items_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_brand"])
    return p.select(F.col("p_partkey").cast("long").alias("movieId"),
                    F.col("p_name").alias("title"),
                    F.concat_ws("|", "p_type", "p_brand").alias("genres"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return e.select(F.col("vec_id").cast("long").alias("item_id"),
                    F.col("embedding").cast("array<double>").alias("vector"))


def tagged_splits(spark: SparkSession, sf_dir: str, days: int = 90):
    """Train/val of L split at max(ts) - days (P5), each tagged with source."""
    from ..operators.prep import temporal_split
    tr, va = temporal_split(interactions_L(spark, sf_dir), "timestamp", days)
    return tr.withColumn("source", F.lit("train")), va.withColumn("source", F.lit("val"))


# DuckDB CTEs that define the same adapters for the oracle SQL.
L_SQL = """L AS (
  SELECT o.o_custkey::BIGINT AS userId, li.l_partkey::BIGINT AS movieId,
         li.l_shipdate AS event_timestamp, max(li.l_quantity)::DOUBLE AS rating,
         ((epoch_us(li.l_shipdate) // 1000) // 1000)::BIGINT AS "timestamp"
  FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey
  GROUP BY 1, 2, 3, 5)"""

E_SQL = """E AS (
  SELECT user_id::BIGINT AS userId, (json_extract_string(props, '$.k'))::INTEGER::BIGINT AS movieId,
         value::DOUBLE AS rating, ts AS event_timestamp,
         ((epoch_us(ts) // 1000) // 1000)::BIGINT AS "timestamp"
  FROM events)"""

EL_SQL = """EL AS (
  SELECT event_id, user_id::BIGINT AS userId, ts,
         (event_type = 'purchase')::INTEGER AS label,
         round(1.0 / (1.0 + exp((50.0 - value) / 50.0)), 6) AS score
  FROM events)"""

ITEMS_SQL = """ITEMS AS (
  SELECT p_partkey::BIGINT AS movieId, p_name AS title, concat_ws('|', p_type, p_brand) AS genres
  FROM part)"""

VEC_SQL = """VEC AS (
  SELECT vec_id::BIGINT AS item_id, embedding::DOUBLE[] AS vector FROM embeddings)"""


def split_sql(days: int = 90) -> str:
    """TRAIN / VAL CTEs over L (val: ts >= max(ts) - days)."""
    return f"""CUT AS (SELECT max("timestamp") - {days} * 86400 AS cut FROM L),
TRAIN AS (SELECT L.*, 'train' AS source FROM L, CUT WHERE L."timestamp" < CUT.cut),
VAL AS (SELECT L.*, 'val' AS source FROM L, CUT WHERE L."timestamp" >= CUT.cut)"""
