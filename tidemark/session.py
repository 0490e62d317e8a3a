"""Session construction and the few runtime settings every operator relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume.  Timestamps are naive UTC everywhere, so the
# session time zone must be UTC for epoch conversions to be exact.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the tidemark defaults.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RUNTIME_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.driver.memory": os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"),
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_runtime(spark: SparkSession) -> SparkSession:
    """Apply the runtime (SQL) settings to a session created elsewhere."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when it is unset *and* Spark runs in local mode (tests, laptops) do we
    create a private folder.  On a cluster an unset value is an error: a
    machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS)")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """A write inside removes its shuffle files when it is done: nothing can read
    them again, as a write has a plan of its own.  Else they stay until the
    driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, partition_by: tuple | list = ()) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: its lineage ends
    there, and its rows (partition numbers included) are the same for all that
    read it."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(df._written_at)
        at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
