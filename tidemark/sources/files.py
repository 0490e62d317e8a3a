"""File sources and sinks.

Every reader takes an explicit schema where the contract is known; schema
inference is used only by the generic discovery loader.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KNOWN_EXT = {".parquet": "parquet", ".csv": "csv", ".tsv": "tsv", ".jsonl": "jsonl", ".ndjson": "jsonl", ".json": "json",
             ".txt": "txt"}                                 # fixed values: extensions the loader knows


def read_parquet(spark: SparkSession, path: str, columns=None, schema=None) -> DataFrame:
    """Parquet scan; a column list is pruned at the scan."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.parquet(path)
    return df.select(*columns) if columns else df


def read_delimited(spark: SparkSession, path: str, sep: str = ",", schema=None, header: bool = True) -> DataFrame:
    """CSV / TSV scan."""
    r = spark.read.option("header", header).option("sep", sep)
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """S3: JSON-lines scan."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.json(path)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields -> top-level columns named with dotted paths."""
    cols = []

    def walk(dt, path):
        for f in dt.fields:
            p = path + [f.name]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, p)
            else:
                cols.append(F.col("`" + "`.`".join(p) + "`").alias(sep.join(p)))
    walk(df.schema, [])
    return df.select(*cols)


def read_json_document(spark: SparkSession, path: str, schema=None, multiline: bool = True) -> DataFrame:
    """A JSON document (list of records or one object; or JSON lines with
    ``multiline=False``), nested fields flattened to dotted names."""
    r = spark.read.option("multiLine", multiline)
    return flatten((r.schema(schema) if schema is not None else r).json(path))


def sniff_delimiter(spark: SparkSession, path: str, sample_lines: int = 20) -> str:
    """Pick the delimiter from a small sample of lines (bounded read)."""
    lines = [r[0] for r in spark.read.text(path).limit(sample_lines).collect()]
    best, score = ",", -1
    for d in [",", "\t", ";", "|"]:
        counts = [ln.count(d) for ln in lines if ln]
        if counts and min(counts) > 0 and len(set(counts)) == 1 and counts[0] > score:
            best, score = d, counts[0]
    return best


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """Text table, delimiter sniffed."""
    return read_delimited(spark, path, sniff_delimiter(spark, path))


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every file under ``root``: relative path, extension, size in bytes
    and MB, largest first.  The binaryFile source lists files in parallel and
    the content column is never read (pruned)."""
    root = root.rstrip("/")
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    rel = F.regexp_replace("path", r"^.*?" + root.replace(".", r"\.") + "/", "")
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return b.select(rel.alias("relative_path"), ext.alias("ext"), F.col("length").alias("size_bytes"),
                    F.round(F.col("length") / (1024 * 1024), 4).alias("size_mb")).orderBy(F.col("size_bytes").desc())


def table_paths(spark: SparkSession, root: str) -> DataFrame:
    """(path, ext): the tables under ``root``.  A table is a file of a known
    kind, or a folder named like one (as Spark writes it) with all its parts;
    other files are themselves, with their own extension."""
    kinds = "|".join(re.escape(e) for e in sorted(KNOWN_EXT))
    man = file_manifest(spark, root).where(~F.col("relative_path").rlike(r"(^|/)[._][^/]*$"))
    top = F.regexp_extract("relative_path", rf"(?i)^(.*?(?:{kinds}))(?:/|$)", 1)
    path = F.when(top != "", top).otherwise(F.col("relative_path"))
    return man.select(path.alias("path")).distinct().withColumn("ext", F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)))


def load_all_tables(spark: SparkSession, root: str) -> tuple[dict, DataFrame]:
    """Every table under ``root``, keyed by its relative path without the
    extension; what cannot be read is listed in a rejected-files table.  The
    driver gets one row per table, however many files it has."""
    readers = {"parquet": read_parquet, "csv": lambda s, p: read_delimited(s, p, ","),
               "tsv": lambda s, p: read_delimited(s, p, "\t"), "jsonl": read_jsonl,
               "json": read_json_document, "txt": read_text_table}
    tables, rejected = {}, []
    for r in table_paths(spark, root).orderBy("path").collect():
        read = readers.get(KNOWN_EXT.get(r["ext"]))
        if read is None:
            rejected.append((r["path"], "unknown extension"))
            continue
        try:
            df = read(spark, f"{root.rstrip('/')}/{r['path']}")
        except Exception as e:  # a table that cannot be read is reported, the others load
            rejected.append((r["path"], type(e).__name__))
            continue
        key = r["path"][:-len(r["ext"])]
        tables[r["path"] if key in tables else key] = df
    return tables, spark.createDataFrame(rejected, "relative_path string, reason string")


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """Parquet sink, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_sorted_export(df: DataFrame, path: str, ts_col: str, fmt: str = "csv") -> None:
    """Holdout export sorted by time within each file (object-store path)."""
    w = df.sortWithinPartitions(ts_col).write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
