"""Source and sink queries: scans and write/read round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ids as I
from ..operators import prep as P
from ..session import scratch_path
from ..sources import files as S
from ..sources.adapters import L_SQL, TABLES, interactions_L, table
from .registry import query, with_ctes

L_SCHEMA = "userId long, movieId long, rating double, event_timestamp timestamp_ntz, timestamp long"
L_COLS = ["userId", "movieId", "rating", "event_timestamp", "timestamp"]


@query("scan_parquet", """
SELECT l_orderkey, l_partkey AS movieId, l_quantity AS rating FROM lineitem WHERE l_quantity >= 25""", "sources")
def scan_parquet(spark, sf_dir):
    """Pruned scan (3 columns), renamed, filter pushed to the reader."""
    li = S.read_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"])
    return li.where(F.col("l_quantity") >= 25).withColumnRenamed("l_partkey", "movieId") \
        .withColumnRenamed("l_quantity", "rating")


@query("scan_csv_roundtrip", with_ctes(L_SQL) + "SELECT * FROM L", "sources")
def scan_csv_roundtrip(spark, sf_dir):
    """Interactions written as TSV and read back with an explicit schema."""
    p = scratch_path(spark, "tsv")
    interactions_L(spark, sf_dir).select(*L_COLS).write.option("header", True).option("sep", "\t").csv(p)
    return S.read_delimited(spark, p, "\t", L_SCHEMA)


@query("scan_jsonl_roundtrip", with_ctes(L_SQL) + "SELECT * FROM L", "sources")
def scan_jsonl_roundtrip(spark, sf_dir):
    """S3: interactions written as JSON lines and read back with a schema."""
    p = scratch_path(spark, "jsonl")
    interactions_L(spark, sf_dir).write.json(p)
    return S.read_jsonl(spark, p, L_SCHEMA)


@query("json_flatten", """
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS "props.k", event_type AS "meta.type",
       user_id AS "meta.user.id" FROM events""", "sources")
def json_flatten(spark, sf_dir):
    """Nested JSON document flattened to dotted column names."""
    ev = table(spark, sf_dir, "events", ["event_id", "props", "event_type", "user_id"])
    doc = ev.select("event_id", F.from_json("props", "k long").alias("props"),
                    F.struct(F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user"))
                    .alias("meta"))
    p = scratch_path(spark, "jsondoc")
    doc.write.json(p)
    return S.read_json_document(spark, p, "event_id long, props struct<k: long>, "
                                          "meta struct<type: string, user: struct<id: long>>", multiline=False)


@query("parquet_roundtrip", with_ctes(L_SQL) + "SELECT *, year(event_timestamp) AS year FROM L", "sources")
def parquet_roundtrip(spark, sf_dir):
    """Partitioned parquet sink read back (partition column restored)."""
    p = scratch_path(spark, "pq")
    S.write_parquet(interactions_L(spark, sf_dir).withColumn("year", F.year("event_timestamp")), p, ["year"])
    return spark.read.parquet(p).withColumn("year", F.col("year").cast("int"))


@query("holdout_export", with_ctes(L_SQL, """HC AS (
  SELECT date_trunc('day', max(event_timestamp) - INTERVAL 30 DAY) AS cut FROM L)""") + """
SELECT L.* FROM L, HC WHERE event_timestamp >= HC.cut""", "sources")
def holdout_export(spark, sf_dir):
    """The holdout written time-sorted as CSV (object-store layout) and read back."""
    _, hold = P.holdout_split(interactions_L(spark, sf_dir), "event_timestamp", 30)
    p = scratch_path(spark, "holdout-csv")
    S.write_sorted_export(hold.select(*L_COLS), p, "event_timestamp")
    return S.read_delimited(spark, p, ",", L_SCHEMA)


@query("idmap_roundtrip", with_ctes(L_SQL) + """
SELECT movieId AS raw_id, (row_number() OVER (ORDER BY movieId) - 1)::BIGINT AS idx FROM (SELECT DISTINCT movieId FROM L)""",
       "sources")
def idmap_roundtrip(spark, sf_dir):
    """Id map saved and loaded back (int keys preserved)."""
    p = scratch_path(spark, "idmap")
    I.fit_id_map(interactions_L(spark, sf_dir), "movieId").write.parquet(p)
    return spark.read.schema("raw_id long, idx long").parquet(p)


@query("max_timestamp", with_ctes(L_SQL) + """
SELECT max(event_timestamp) AS max_ts, min(event_timestamp) AS min_ts, count(*) AS n_rows FROM L""", "sources")
def max_timestamp(spark, sf_dir):
    """Newest and oldest event (aggregate pushed to the scan where the source allows)."""
    return interactions_L(spark, sf_dir).agg(F.max("event_timestamp").alias("max_ts"),
                                             F.min("event_timestamp").alias("min_ts"),
                                             F.count(F.lit(1)).alias("n_rows"))


@query("file_manifest", None, "sources")
def file_manifest(spark, sf_dir):
    """Files of the data folder, largest first (rows-only: sizes depend on the writer)."""
    return S.file_manifest(spark, sf_dir)


@query("load_all_tables", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in TABLES), "sources")
def load_all_tables(spark, sf_dir):
    """Every table under the folder loaded by name; row count per table."""
    tables, _ = S.load_all_tables(spark, sf_dir)
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("table"), "n_rows")
             for k, df in sorted(tables.items())]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out
