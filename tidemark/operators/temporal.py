"""Leak-aware trailing-window statistics and recent-item sequences.

Window semantics: the trailing window of an event at instant t is [t - w, t):
lower bound inclusive, the event itself and every event of the same instant
excluded.  An empty window gives count 0 and average 0.0.

Counts and averages are differences of running totals
(:func:`.scan.totals_between`): growing frames of one sort by key, linear however
many events a window holds.  Hot keys are split over many tasks, by totals that
events enter at their time and leave after the window (``scan``) or by totals
probed at the bounds (``prefix``); both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.columns import (PAD, bucket_list, epoch_millis, iso_micros,
                                 pad_left)
from .scan import COUNTED, SEGMENT_ROWS, hot_keys, last_before, last_rows, split_hot, totals_between, trailing_totals

DAY_MS = 86_400_000


def dedup_last_per_instant(df: DataFrame, key: str, ts: str, tie: str, cols) -> DataFrame:
    """Q1: one row per (key, ts); the row with the greatest ``tie`` wins.
    Hash aggregate with ``max_by`` (partial aggregation map-side); one column is
    kept as it is, as a struct would be sorted instead."""
    if len(cols) == 1:
        return df.groupBy(key, ts).agg(F.max_by(cols[0], tie).alias(cols[0]))
    packed = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(tie)).alias("_v")
    return df.groupBy(key, ts).agg(packed).select(key, ts, "_v.*")


def _exact(df: DataFrame, value: str) -> str:
    """The decimal type in which sums of ``value`` are exact (18 places for
    floating columns, else the column's own type)."""
    kind = df.schema[value].dataType
    return "decimal(38,18)" if isinstance(kind, (FloatType, DoubleType)) else kind.simpleString()


def _deltas(df: DataFrame, value: str) -> dict[str, Column]:
    return {"c": F.col(value).isNotNull().cast("long"), "s": F.coalesce(F.col(value), F.lit(0)).cast(_exact(df, value))}


def _named(got: DataFrame, columns, windows, name) -> DataFrame:
    """Counts and averages from the totals ``c_<d>d`` and ``s_<d>d``."""
    cols = []
    for d in windows:
        c, total = F.col(f"c_{d}d"), F.col(f"s_{d}d").cast("double")
        cols += [c.cast("long").alias(name("cnt", d)), F.when(c > 0, total / c).otherwise(F.lit(0.0)).alias(name("avg", d))]
    return got.select(*columns, *cols)


def _scan_stats(df: DataFrame, key: str, ms: str, value: str, windows, name, rows: int, hot) -> DataFrame:
    got = trailing_totals(df, key, ms, _deltas(df, value), {f"{d}d": d * DAY_MS for d in windows}, rows, hot)
    return _named(got, df.columns, windows, name)


def segmented_prefix(df: DataFrame, key: str, order_cols, values, chunk_width: int = DAY_MS) -> DataFrame:
    """Exclusive running totals of ``values`` per ``key`` in ``order_cols`` order.

    Skew-safe segmented scan.  Rows are cut into deterministic segments
    (key, floor(t / chunk_width)) where t = ``order_cols[0]`` (numeric time), so
    a hot key is spread over many segments and tasks:
    (1) running sums inside each segment (one hash exchange on (key, chunk)),
    (2) one total per segment (same partitioning: no new exchange),
    (3) offsets = totals of earlier segments of the key (a window over the
        small per-segment table),
    (4) offsets joined back on (key, chunk).
    Segment ids depend only on the data, so a recomputed task after executor
    loss yields identical ids.  Adds ``_cum_<v>`` = total over strictly
    earlier rows of the same key.
    """
    ordered = [F.col(c) for c in order_cols]
    chunked = df.withColumn("_chunk", F.floor(F.col(order_cols[0]) / F.lit(chunk_width)).cast("long"))
    wg = Window.partitionBy(key, "_chunk")
    wl = wg.orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    local = chunked.select("*", *[F.coalesce(F.sum(v).over(wl), F.lit(0)).alias(f"_loc_{v}") for v in values])
    tot = chunked.groupBy(key, "_chunk").agg(*[F.sum(v).alias(f"_tot_{v}") for v in values])
    wo = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(key, "_chunk", *[F.coalesce(F.sum(f"_tot_{v}").over(wo), F.lit(0)).alias(f"_off_{v}")
                                       for v in values])
    out = local.join(offs, [key, "_chunk"])
    return out.select(*[c for c in df.columns],
                      *[(F.col(f"_loc_{v}") + F.col(f"_off_{v}")).alias(f"_cum_{v}") for v in values])


def _prefix_stats(df: DataFrame, key: str, ms: str, value: str, windows, name, uniq, rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """Trailing count/sum as C(<t) - C(<t-w): both read off one sort by key, and
    for hot keys (more than ``rows`` rows) from a merged probe stream."""
    cold, hot = split_hot(df, key, rows, hot)
    deltas = _deltas(df, value)
    got = totals_between(cold.select("*", *[c.alias(f"_delta_{n}") for n, c in deltas.items()]), key, ms,
                         {n: f"_delta_{n}" for n in deltas}, {f"{d}d": d * DAY_MS for d in windows})
    done = _named(got, df.columns, windows, name)
    return done if hot is None else done.unionByName(_probed_stats(hot, key, ms, value, windows, name, uniq))


def _probed_stats(df: DataFrame, key: str, ms: str, value: str, windows, name, uniq) -> DataFrame:
    """Trailing count/sum with a merged probe stream, for keys of any size.

    Each event emits one *real* row (count 1, value v) and one *probe* per
    bound (t and t-w for every window), identified by the event's unique key
    columns ``uniq`` (deterministic, so recomputation after a lost executor
    gives the same ids).  Probes sort before real rows of the same instant, so
    a probe's exclusive running total counts real rows strictly earlier than
    its instant.  Values are summed as exact decimals (18 places for floating
    columns, else the column's own type) so differences are exact; rows without
    a value count for nothing, as in the range strategy.
    """
    bounds = [("b0", F.col(ms))] + [(f"b{d}", F.col(ms) - F.lit(d * DAY_MS)) for d in windows]
    rid = F.struct(*[F.col(c) for c in uniq])
    exact = _exact(df, value)
    val = F.coalesce(F.col(value), F.lit(0)).cast(exact)
    real = df.select(F.col(key), F.col(ms).alias("_t"), F.lit(1).alias("_kind"),
                     F.lit(None).cast(df.select(rid.alias("x")).schema[0].dataType).alias("_id"),
                     F.lit(None).cast("string").alias("_b"), F.col(value).isNotNull().cast("long").alias("c"), val.alias("s"))
    probes = df.select(F.col(key), rid.alias("_id"),
                       F.explode(F.array(*[F.struct(F.lit(b).alias("b"), e.alias("t")) for b, e in bounds])).alias("_p")) \
        .select(F.col(key), F.col("_p.t").alias("_t"), F.lit(0).alias("_kind"), "_id", F.col("_p.b").alias("_b"),
                F.lit(0).cast("long").alias("c"), F.lit(0).cast(exact).alias("s"))
    scan = segmented_prefix(real.unionByName(probes), key, ["_t", "_kind"], ["c", "s"])
    got = scan.filter(F.col("_kind") == 0).groupBy("_id").pivot("_b", [b for b, _ in bounds]) \
        .agg(F.first("_cum_c").alias("c"), F.first("_cum_s").alias("s"))
    cols = []
    for d in windows:
        c = (F.col("b0_c") - F.col(f"b{d}_c"))
        s = (F.col("b0_s") - F.col(f"b{d}_s")).cast("double")
        cols += [c.cast("long").alias(name("cnt", d)),
                 F.when(c > 0, s / c).otherwise(F.lit(0.0)).alias(name("avg", d))]
    stats = got.select(*[F.col(f"_id.{c}").alias(c) for c in uniq], *cols)
    return df.join(stats, list(uniq))


def trailing_stats(df: DataFrame, key: str, ts: str, value: str, windows, name,
                   strategy: str = "scan", uniq=None, rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """Add trailing count/avg columns for each window (days) to ``df``.
    ``uniq``: columns unique per row (needed by the prefix strategy); ``rows``:
    keys with more are scanned in segments."""
    base = df.withColumn("_ms", epoch_millis(ts))
    if strategy in ("scan", "range"):  # range: the former name
        out = _scan_stats(base, key, "_ms", value, windows, name, rows, hot)
    elif strategy == "prefix":
        out = _prefix_stats(base, key, "_ms", value, windows, name, uniq or [key, ts], rows, hot)
    else:
        raise ValueError(strategy)
    return out.drop("_ms")


def movie_rating_stats(events: DataFrame, items: DataFrame | None = None, item_col: str = "movieId",
                       user_col: str = "userId", ts_col: str = "event_timestamp", rating_col: str = "rating",
                       windows=(90, 30, 7), strategy: str = "scan", rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """Per (item, instant) trailing counts/averages over 90/30/7 days.

    Dedups to one row per (item, instant) first (greatest user wins, Q1), so
    counts are of distinct instants.  Hot items are counted in ``events``, which
    have at least as many rows, so that the dedup is made once.  Item metadata is
    left-joined last, on the reduced table."""
    if isinstance(hot, str):
        hot = hot_keys(events, item_col, rows)
    # Dealt by item alone, rows stay where they are for the dedup and the windows.
    cold, many = split_hot(events.select(item_col, ts_col, user_col, rating_col), item_col, rows, hot)
    base = dedup_last_per_instant(cold.repartition(item_col), item_col, ts_col, user_col, [rating_col])
    if many is not None:
        base = base.unionByName(dedup_last_per_instant(many, item_col, ts_col, user_col, [rating_col]))
    name = lambda kind, d: (f"movie_rating_cnt_{d}d" if kind == "cnt" else f"movie_rating_avg_prev_rating_{d}d")
    stats = trailing_stats(base, item_col, ts_col, rating_col, windows, name, strategy, rows=rows, hot=hot).drop(rating_col)
    if items is not None:
        stats = stats.join(items.select(item_col, "title", "genres"), item_col, "left")
    order = [item_col, ts_col] + (["title", "genres"] if items is not None else [])
    return stats.select(*order, *[name(k, d) for d in windows for k in ("cnt", "avg")])


def user_rating_stats(events: DataFrame, user_col: str = "userId", item_col: str = "movieId",
                      ts_col: str = "event_timestamp", rating_col: str = "rating", seq_len: int = 10,
                      window_days: int = 90, strategy: str = "scan", rows: int = SEGMENT_ROWS, keep=()) -> DataFrame:
    """One row per event with the 90-day trailing count/avg (peers
    excluded) and the previous ``seq_len`` events (positional, so same-instant
    predecessors are included; order pinned to (time, item)).  ``keep``: columns
    of the event that come along."""
    name = lambda kind, d: (f"user_rating_cnt_{d}d" if kind == "cnt" else f"user_rating_avg_prev_rating_{d}d")
    hot = hot_keys(events, user_col, rows)  # counted once, for both scans
    st = trailing_stats(events.select(user_col, item_col, ts_col, rating_col, *[c for c in keep if c != rating_col]), user_col, ts_col, rating_col,
                        [window_days], name, strategy, uniq=[user_col, item_col, ts_col], rows=rows, hot=hot) \
        .withColumn("_ms", epoch_millis(ts_col))
    item = F.struct(F.col("_ms").alias("ms"), F.col(item_col).alias("item"), F.col(ts_col).alias("ts"))
    st = last_rows(st, user_col, ["_ms", item_col], item, seq_len, "_prev", rows, hot)
    secs = F.transform("_prev", lambda x: F.floor(x["ms"] / 1000).cast("long"))
    seq_ts = pad_left(secs, seq_len)
    return st.select(
        user_col, ts_col, item_col,
        F.col(name("cnt", window_days)), F.col(name("avg", window_days)),
        F.array_join(F.transform("_prev", lambda x: x["item"].cast("string")), ",")
         .alias("user_rating_list_10_recent_movie"),
        F.array_join(F.transform("_prev", lambda x: iso_micros(x["ts"])), ",")
         .alias("user_rating_list_10_recent_movie_timestamp"),
        seq_ts.alias("item_sequence_ts"),
        bucket_list(seq_ts, F.floor(F.col("_ms") / 1000)).alias("item_sequence_ts_bucket"),
        *keep,
    )


def first_event_per_item(events: DataFrame, item_col: str = "movieId", ts_col: str = "event_timestamp",
                         tie_col: str = "userId") -> DataFrame:
    """The first event of every item (earliest time, then smallest tie).
    ``min_by`` hash aggregate instead of a sort-based row_number."""
    cols = [c for c in events.columns if c != item_col]
    packed = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(ts_col), F.col(tie_col)))
    return events.groupBy(item_col).agg(packed.alias("_v")).select(item_col, "_v.*")


# ---------------------------------------------------------------- as-of joins

def asof_backward(left: DataFrame, right: DataFrame, by: str, on: str, right_on: str | None = None,
                  keep_right_ts: str | None = None, rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """For every left row, the latest right row with the same ``by`` and
    right time <= left time (ties inclusive).  Left rows are kept (left join).

    Union of both sides with a side flag (right sorts first at equal time) and
    the last right row carried forward: one exchange by key, no range join, no
    pairs; keys with more than ``rows`` rows are scanned in segments (``hot``: what
    :func:`.scan.hot_keys` gave for rows that hold those of both sides; else both
    sides are computed once more to be counted).  Right columns must not clash
    with left columns.
    """
    right_on = right_on or on
    rcols = [c for c in right.columns if c not in (by, right_on)]
    lcols = [c for c in left.columns if c not in (by, on)]
    clash = set(rcols) & set(lcols)
    if clash:
        raise ValueError(f"column clash: {sorted(clash)}")
    if isinstance(hot, str):
        hot = hot_keys(right.select(F.col(by)).unionByName(left.select(F.col(by))), by, rows)
    if hot is None:  # both sides are dealt by key alone, so that their union needs no exchange
        left, right = left.repartition(by), right.repartition(by)
    payload = F.struct(*[F.col(c) for c in rcols], F.col(right_on).alias("__rts"))
    r = right.select(F.col(by), F.col(right_on).alias("__t"), F.lit(0).alias("__side"),
                     payload.alias("__r"), F.lit(None).cast(left.select(F.struct(*lcols).alias("x")).schema[0].dataType).alias("__l"))
    lft = left.select(F.col(by), F.col(on).alias("__t"), F.lit(1).alias("__side"),
                      F.lit(None).cast(r.schema["__r"].dataType).alias("__r"), F.struct(*lcols).alias("__l"))
    u = last_before(r.unionByName(lft), by, ["__t", "__side"], "__r", "__m", rows, hot)
    out = u.filter(F.col("__side") == 1).select(F.col(by), F.col("__t").alias(on), "__l.*", "__m")
    sel = [F.col(f"__m.{c}").alias(c) for c in rcols]
    if keep_right_ts:
        sel.append(F.col("__m.__rts").alias(keep_right_ts))
    return out.select(by, on, *lcols, *sel)


def point_in_time_join(left: DataFrame, right: DataFrame, by: str, on: str, ttl_days: float,
                       right_on: str | None = None, hot=COUNTED) -> DataFrame:
    """As-of join whose match must also be no older than ``ttl`` (else all
    right features are NULL)."""
    rcols = [c for c in right.columns if c not in (by, right_on or on)]
    j = asof_backward(left, right, by, on, right_on, keep_right_ts="__rts", hot=hot)
    fresh = (F.col("__rts").isNotNull() &
             (F.col(on).cast("timestamp").cast("double") - F.col("__rts").cast("timestamp").cast("double")
              <= F.lit(ttl_days * 86400.0)))
    return j.select(*[c for c in j.columns if c not in rcols and c != "__rts"],
                    *[F.when(fresh, F.col(c)).alias(c) for c in rcols])


def collapse_user_stats(user_stats: DataFrame, user_col: str = "userId", ts_col: str = "event_timestamp",
                        item_col: str = "movieId", mode: str = "compat") -> DataFrame:
    """Q5: one user-stats row per (user, instant).  ``compat`` keeps the last
    event of the instant (its recent list holds same-instant peers: the
    reference behaviour); ``strict`` keeps the first (leak-free)."""
    rest = [c for c in user_stats.columns if c not in (user_col, ts_col)]
    pick = F.max_by if mode == "compat" else F.min_by
    packed = pick(F.struct(*[F.col(c) for c in rest]), F.col(item_col))
    return user_stats.groupBy(user_col, ts_col).agg(packed.alias("_v")).select(user_col, ts_col, "_v.*")


def instant_join(left: DataFrame, right: DataFrame, by: str, on: str, rows: int = SEGMENT_ROWS, hot=COUNTED) -> DataFrame:
    """The left join on (by, on) to a right side that is unique there, as an as-of
    join whose match must be of the same instant: a right side that already lies
    by ``by`` is not shuffled, however wide it is.  Null keys match nothing."""
    rcols = [c for c in right.columns if c not in (by, on)]
    j = asof_backward(left, right, by, on, keep_right_ts="__rts", rows=rows, hot=hot)
    same = F.col(by).isNotNull() & (F.col("__rts") == F.col(on))
    return j.select(*left.columns, *[F.when(same, F.col(c)).alias(c) for c in rcols])


def feature_join(events: DataFrame, movie_stats: DataFrame, user_stats: DataFrame,
                 user_col: str = "userId", item_col: str = "movieId", ts_col: str = "event_timestamp",
                 mode: str = "compat", rows: int = SEGMENT_ROWS) -> DataFrame:
    """Exact point-in-time m:1 joins on (item, instant) and (user, instant).
    Both right sides are unique on their keys (J3 holds by construction) and have
    no more rows of a key than the events, so that hot keys are counted there."""
    us = collapse_user_stats(user_stats, user_col, ts_col, item_col, mode).drop(item_col)
    hot = {k: hot_keys(events, k, rows // 2) for k in (item_col, user_col)}
    got = instant_join(events, movie_stats, item_col, ts_col, rows, hot[item_col])
    return instant_join(got, us, user_col, ts_col, rows, hot[user_col])


def asof_dedup_fill(probes: DataFrame, right: DataFrame, by: str, on: str, fill_cols, hot=COUNTED) -> DataFrame:
    """As-of on the distinct probe keys only, join the result back to every
    probe row (m:1) and fill unmatched numeric features with 0."""
    keys = probes.select(by, on).dropDuplicates()
    got = asof_backward(keys, right, by, on, hot=hot)
    return probes.join(got, [by, on], "left").na.fill(0, subset=list(fill_cols))
