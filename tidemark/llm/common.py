"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path, shuffles_removed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage by a compressed table written in the shared folder that
    ``spark.checkpoint.dir`` names.  Unlike a checkpoint its size is known to
    the planner; estimates carried from round to round of a loop would square."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables written by ``stored`` that nothing reads any more."""
    for df in frames:
        jvm, path = df.sparkSession._jvm, df._stored_at
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def fingerprint(text: Column) -> Column:
    """16 bytes that identify a whole text (null texts have none)."""
    return F.unhex(F.md5(text.cast("binary")))




def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
