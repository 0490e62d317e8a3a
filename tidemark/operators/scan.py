"""Ordered scans that no key and no order can put into one task.

Rows are dealt by *range* over (key, order), so that every task gets about as
many rows, whatever their keys; the partition a row fell into is its segment
(``_seg``).  A scan runs inside each (key, segment) and is completed by what the
segments before leave: one small row for each (key, segment).  What is carried
need not be additive: totals, the last value, or the last ``k`` rows.

Per-key scans deal only the rows of *hot* keys (more than ``SEGMENT_ROWS`` rows)
in this way; all other keys are plain windows in the same plan.  The results are
the same either way.  The dealt table is written once to the shared folder: both
the scan and what is carried must see the same segments.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import written

SEGMENT_ROWS = 1_000_000


def dealt(df: DataFrame, order) -> DataFrame:
    """``df`` in segments of about equal size by ``order``, with ``_seg`` (ascending
    along ``order``) and ``_pos`` (ascending within everything)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    seq = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_pos", F.monotonically_increasing_id())
    return written(seq.withColumn("_seg", F.shiftright("_pos", 33)), "dealt")


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame | None:
    """(_hot): the keys with more than ``rows`` rows, None if there are none.  A
    null key is a key like any other."""
    hot = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select("_hot")
    return None if hot.isEmpty() else written(hot, "hot-keys")


def spread(spark, keys: int) -> int:
    """A number of hash partitions over which the long keys 0 .. ``keys`` - 1 lie as
    evenly as can be found, so that a few large groups do not share a task."""
    h = np.array([r[0] for r in spark.range(keys).select(F.hash("id")).collect()], np.int64)
    most = max(4 * keys, min(32 * keys, 400))
    return min(range(keys, most + 1, max(1, (most - keys) // 400)), key=lambda n: (int(np.bincount(h % n).max()), n))


COUNTED = "count"  # let the scan count its own keys


def split_hot(df: DataFrame, key: str, rows: int, hot=COUNTED) -> tuple[DataFrame, DataFrame | None]:
    """(rows of other keys, rows of hot keys or None).  ``hot``: what
    :func:`hot_keys` gave for the same keys, where that is known."""
    if isinstance(hot, str):
        hot = hot_keys(df, key, rows)
    if hot is None:
        return df, None
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def by_segment(seq: DataFrame, key: str | None, carry: list[Column], window: Callable[[str], Column], out: str) -> DataFrame:
    """``out`` for each (key, segment): ``window`` of the ``carry`` aggregates of the
    key's earlier segments, at most one row for each range partition."""
    keys = [key] if key else []
    per = seq.groupBy(*keys, "_seg").agg(*carry)
    return per.select(*[F.col(k).alias("_key") for k in keys], F.col("_seg").alias("_s"), window("_seg").alias(out))


def with_carried(seq: DataFrame, carried: DataFrame, key: str | None) -> DataFrame:
    on = F.col("_seg") == F.col("_s")
    if key:
        on = on & F.col(key).eqNullSafe(F.col("_key"))
    return seq.join(carried, on, "left").drop("_s", "_key")


def _before(key: str | None) -> WindowSpec:
    w = Window.partitionBy(key) if key else Window.partitionBy()
    return w.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)


def prefix(df: DataFrame, order, values, key: str | None = None) -> DataFrame:
    """Adds ``_cum_<v>``: the total of ``v`` over the rows strictly before (of the
    same key, if given) in ``order``, which must put rows in one order."""
    seq = dealt(df, ([key] if key else []) + list(order))
    keys = [key] if key else []
    inside = Window.partitionBy(*keys, "_seg").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    local = seq.select("*", *[F.coalesce(F.sum(v).over(inside), zero).alias(f"_loc_{v}") for v in values])
    before = _before(key)
    carried = by_segment(seq, key, [F.sum(v).alias(f"_tot_{v}") for v in values],
                         lambda _: F.struct(*[F.coalesce(F.sum(f"_tot_{v}").over(before), zero).alias(v) for v in values]), "_off")
    got = with_carried(local, carried, key)
    return got.select(*df.columns, *[(F.col(f"_loc_{v}") + F.col(f"_off.{v}")).alias(f"_cum_{v}") for v in values])


def last_before(df: DataFrame, key: str, order, value: str, out: str, rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """Adds ``out``: the last ``value`` that isn't null at or before each row of the
    same key in ``order``."""
    upto = lambda *keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cold, hot = split_hot(df, key, rows, hot)
    done = cold.withColumn(out, F.last(value, ignorenulls=True).over(upto(key)))
    if hot is None:
        return done
    seq = dealt(hot, [key, *order])
    inside = Window.partitionBy(key, "_seg").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = seq.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    carried = by_segment(seq, key, [F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_pos"))).alias("_v")],
                         lambda _: F.last("_v", ignorenulls=True).over(_before(key)), "_carried")
    got = with_carried(local, carried, key)
    return done.unionByName(got.select(*df.columns, F.coalesce(out, "_carried").alias(out)))


def last_rows(df: DataFrame, key: str, order, item: Column, k: int, out: str, rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """Adds ``out``: ``item`` of the ``k`` rows before each row of the same key in
    ``order``, oldest first."""
    frame = lambda w: w.rowsBetween(-k, -1)
    cold, hot = split_hot(df, key, rows, hot)
    done = cold.withColumn(out, F.collect_list(item).over(frame(Window.partitionBy(key).orderBy(*order))))
    if hot is None:
        return done
    seq = dealt(hot, [key, *order])
    inside = Window.partitionBy(key, "_seg")
    local = seq.withColumn(out, F.collect_list(item).over(frame(inside.orderBy("_pos"))))
    # the last k rows of each segment; k segments before always hold k rows, if there are as many
    tails = (seq.withColumn("_nth", F.row_number().over(inside.orderBy(F.col("_pos").desc()))).where(F.col("_nth") <= k))
    carried = by_segment(tails, key, [F.sort_array(F.collect_list(F.struct("_pos", item.alias("_item")))).alias("_tail")],
                         lambda _: F.flatten(F.collect_list("_tail").over(Window.partitionBy(key).orderBy("_seg").rowsBetween(-k, -1))), "_carried")
    got = with_carried(local, carried, key)
    before = F.transform(F.coalesce("_carried", F.array()), lambda x: x["_item"])
    every = F.concat(before, F.col(out))
    return done.unionByName(got.select(*df.columns, F.when(F.size(every) > k, F.slice(every, -k, k)).otherwise(every).alias(out)))


def totals_between(df: DataFrame, key: str, at: str, values: dict[str, str], widths: dict[str, int]) -> DataFrame:
    """Adds ``<name>_<width's name>``: the total of the column ``values[name]``
    over the rows of the same key with ``at`` in [at - width, at), an integer, as
    the running total before ``at`` less the one before ``at - width``.  Each is a
    growing frame of one and the same sort by key: linear, and no row is copied."""
    def before(v, past: int):
        w = Window.partitionBy(key).orderBy(at).rangeBetween(Window.unboundedPreceding, -1 - past)
        return F.coalesce(F.sum(v).over(w), F.lit(0))

    kind = {n: df.select(F.sum(v).alias("x")).schema["x"].dataType for n, v in values.items()}
    return df.select("*", *[(before(v, 0) - before(v, size)).cast(kind[n]).alias(f"{n}_{w}") for n, v in values.items() for w, size in widths.items()])


def trailing_totals(df: DataFrame, key: str, at: str, deltas: dict[str, Column], widths: dict[str, int],
                    rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """Adds ``<name>_<width's name>`` for every delta and width: the delta's total
    over the rows of the same key with ``at`` in [at - width, at), an integer.

    Differences of running totals (:func:`totals_between`).  Rows of hot keys
    enter a running total at their time and leave it after their time plus the
    width, as rows of their own that are first added up by (key, time), so that
    a time lies in one segment."""
    names = [(n, w) for n in deltas for w in widths]
    base = df.select("*", *[c.alias(f"_delta_{n}") for n, c in deltas.items()])

    def stream(rows_: DataFrame) -> DataFrame:
        amount = {n: F.col(f"_delta_{n}") for n in deltas}
        enter = F.struct(F.col(at).alias("_t"), *[amount[n].alias(f"_{n}_{w}") for n, w in names])
        leave = [F.struct((F.col(at) + size).alias("_t"),
                          *[(-amount[n] if w == out else amount[n] * 0).cast(rows_.schema[f"_delta_{n}"].dataType).alias(f"_{n}_{w}") for n, w in names])
                 for out, size in widths.items()]
        enter = enter.cast(rows_.select(leave[0].alias("x")).schema["x"].dataType)
        return rows_.select(F.col(key).alias("_k"), F.explode(F.array(enter, *leave)).alias("_e")).select("_k", "_e.*")

    cold, hot = split_hot(base, key, rows, hot)
    done = totals_between(cold, key, at, {n: f"_delta_{n}" for n in deltas}, widths).select(*df.columns, *[f"{n}_{w}" for n, w in names])
    if hot is None:
        return done
    moments = stream(hot).groupBy("_k", "_t").agg(*[F.sum(f"_{n}_{w}").alias(f"_{n}_{w}") for n, w in names])
    run = prefix(moments, ["_t"], [f"_{n}_{w}" for n, w in names], key="_k")
    run = run.select(F.col("_k"), F.col("_t"), *[F.col(f"_cum__{n}_{w}").cast(done.schema[f"{n}_{w}"].dataType).alias(f"{n}_{w}") for n, w in names])
    got = hot.select(*df.columns).join(run, F.col(key).eqNullSafe(F.col("_k")) & (F.col(at) == F.col("_t")), "left")
    return done.unionByName(got.select(*df.columns, *[f"{n}_{w}" for n, w in names]))


def running(df: DataFrame, key: str, order, values, rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """``prefix`` by key: plain windows, and segments for hot keys."""
    cold, hot = split_hot(df, key, rows, hot)
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    done = cold.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_cum_{v}") for v in values])
    return done if hot is None else done.unionByName(prefix(hot, order, values, key))
