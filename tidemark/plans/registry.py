"""The query catalogue: each entry pairs a Spark callable ``(spark, sf_dir) ->
DataFrame`` with the DuckDB SQL that must give the same rows (or ``None`` for
rows-only checks).  ``__spark_entry__`` exposes this catalogue."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_runtime


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    area: str


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None, area: str):
    """Register a Spark query with its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_runtime(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, run, sql, area)
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


MODULES = ["q_sources", "q_prep", "q_temporal", "q_store", "q_ids", "q_sampling",
           "q_features", "q_retrieval", "q_metrics", "q_streaming", "q_ml", "q_two_stage"]


def load_all() -> dict[str, Query]:
    import importlib
    import importlib.util
    for m in MODULES:
        if importlib.util.find_spec(f"{__package__}.{m}") is not None:
            importlib.import_module(f"{__package__}.{m}")
    return QUERIES
