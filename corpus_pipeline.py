"""A training-corpus pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``:

1. quality: documents scored under 0.3 by the classifier go;
2. neardup: one document of each near-duplicate class stays;
3. decontaminate: documents that hold a benchmark item go;
4. secrets: secret spans are replaced in the texts;
5. mix: documents are drawn, epoch by epoch, to fill the budgets of the
   domain-language-source tree; the columns of documents, with ``domain``,
   ``n_tokens``, ``epoch`` and ``tokens_before``.

Null and empty texts pass stages 2 to 4 and, having no tokens, are not drawn in
stage 5; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, neardup, quality, secrets
from tidemark.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.drawn(spark, docs)


STAGES = [("quality", quality_stage), ("neardup", neardup_stage), ("decontaminate", decontaminate_stage),
          ("secrets", secrets_stage), ("mix", mix_stage)]

# No SQL: the classifier is trained, and classes are connected components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, all stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
