"""The queries of this subpackage, by name, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Run]:
    from . import q_ops
    return dict(q_ops.QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import q_ops
    return dict(q_ops.SQL)
