"""Cleaning, typing, splitting, dedup, k-core and profiling (P*, A4-A10, A14, J1-J5).

Global scalars (a split cut-off, a max timestamp) are computed with one
aggregate action returning a single value and then used as a literal, so the
filter that follows is pushed into the parquet scan.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_millis, from_epoch_seconds, hash64, integral, safe_double, safe_long
from ..session import discard, written
from .quantiles import quantiles

TS_NAME_CANDIDATES = ["timestamp", "time", "ts", "created_at", "created", "date", "datetime"]  # fixed values


def scalar(df: DataFrame, expr: Column):
    """One global aggregate value (an O(1) driver result)."""
    return df.agg(expr.alias("v")).first()["v"]


# ------------------------------------------------------------------ typing

def typed_interactions(df: DataFrame, user="userId", item="movieId", rating="rating",
                       ts_seconds="timestamp") -> DataFrame:
    """Cast ids to long and rating to double; derive the naive UTC
    ``event_timestamp`` and epoch-ms ``timestamp_unix`` from epoch seconds."""
    return df.select(
        F.col(user).cast("long").alias(user), F.col(item).cast("long").alias(item),
        F.col(rating).cast("double").alias(rating), F.col(ts_seconds).cast("long").alias(ts_seconds),
        from_epoch_seconds(F.col(ts_seconds)).alias("event_timestamp"),
        (F.col(ts_seconds).cast("long") * 1000).alias("timestamp_unix"))


def epoch_units(df: DataFrame, cols) -> dict[str, str]:
    """How each column holds time: ``ms`` or ``s`` since the epoch, or ``text``.
    All columns are decided by one aggregate: the greatest number in a column
    tells milliseconds (beyond 1e12) from seconds; without any number it is text."""
    if not cols:
        return {}
    top = df.agg(*[F.max(F.col(c).try_cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return {c: "text" if v is None else "ms" if v > 1e12 else "s" for c, v in zip(cols, top)}


def read_time(c: str, unit: str) -> Column:
    """Column ``c`` as a naive UTC timestamp; what does not parse is NULL."""
    if unit == "text":
        return F.try_to_timestamp(F.col(c).cast("string")).cast("timestamp_ntz")
    ticks = F.col(c).try_cast("double").try_cast("long")
    return (F.timestamp_millis(ticks) if unit == "ms" else F.timestamp_seconds(ticks)).cast("timestamp_ntz")


def parse_dt(df: DataFrame, cols=None) -> DataFrame:
    """timestamp columns parsed by their detected unit.  Default: the first
    column with a usual timestamp name; columns that do not exist are ignored."""
    named = [c for c in df.columns if c.lower() in TS_NAME_CANDIDATES][:1]
    units = epoch_units(df, [c for c in (named if cols is None else cols) if c in df.columns])
    return df.withColumns({c: read_time(c, u) for c, u in units.items()}) if units else df


def standardize_dtypes(df: DataFrame, user="userId", item="movieId", rating="rating", ts="timestamp") -> DataFrame:
    """Coerce the four interaction columns (missing -> NULL): ids held as
    numbers count where they are whole, ids held as text where they are integer
    literals; numeric timestamps are epoch seconds, text is parsed; rows with
    any NULL dropped."""
    for c in (user, item, rating, ts):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    tsf = df.schema[ts].dataType
    if isinstance(tsf, (T.IntegerType, T.LongType, T.DoubleType, T.FloatType)):
        tcol = F.timestamp_seconds(F.col(ts).cast("long")).cast("timestamp_ntz")
    elif isinstance(tsf, (T.TimestampType, T.TimestampNTZType)):
        tcol = F.col(ts).cast("timestamp_ntz")
    else:
        tcol = F.expr(f"try_to_timestamp(cast(`{ts}` as string))").cast("timestamp_ntz")
    number = (T.NumericType,)
    whole = lambda c: (integral if isinstance(df.schema[c].dataType, number) else safe_long)(c).alias(c)
    value = (F.col(rating).cast("double").alias(rating) if isinstance(df.schema[rating].dataType, number)
             else safe_double(rating).alias(rating))
    out = df.select(whole(user), whole(item), value, tcol.alias(ts))
    return out.na.drop(subset=[user, item, rating, ts])


def typed_fill(df: DataFrame, text_default: str = "", number_default: float = 0.0, cols=None) -> DataFrame:
    """P10: type-aware null fill (strings -> "", numbers -> 0)."""
    cols = cols or df.columns
    texts = [c for c, t in df.dtypes if c in cols and t == "string"]
    nums = [c for c, t in df.dtypes if c in cols and t in ("int", "bigint", "double", "float", "smallint", "tinyint")]
    out = df.na.fill(text_default, subset=texts) if texts else df
    return out.na.fill(number_default, subset=nums) if nums else out


def required_columns(df: DataFrame, cols, default=0.0) -> DataFrame:
    """Add missing required columns with a constant default."""
    missing = {c: F.lit(default) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def label_weight(df: DataFrame, rating="rating", ratio: float = 1.0) -> DataFrame:
    """Binary label (rating > 0) and class weight (``ratio`` for positives)."""
    lab = (F.col(rating) > 0).cast("int")
    return df.withColumn("label", lab).withColumn(
        "weight", F.when(F.col("label") == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


# ------------------------------------------------------------------ unions

def union_tagged(frames: dict) -> DataFrame:
    """Union-all of named frames with a constant ``source`` tag."""
    return reduce(lambda a, b: a.unionByName(b),
                  [df.withColumn("source", F.lit(name)) for name, df in frames.items()])


def union_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union-all; columns absent on one side become NULL."""
    return a.unionByName(b, allowMissingColumns=True)


# ------------------------------------------------------------------ splits

def temporal_split(df: DataFrame, ts_seconds="timestamp", days: int = 90, ts: str | None = None):
    """cut = max(ts) - days (exact instant); ts >= cut -> validation.
    ``ts`` names the timestamp column from which the whole seconds are derived:
    the filter is then on that column, with a literal that reaches the scan."""
    mx = scalar(df, F.max(ts_seconds))
    cut = None if mx is None else mx - days * 86400
    if ts is None or cut is None:
        at, lit = F.col(ts_seconds), F.lit(cut)
    else:
        at, lit = F.col(ts), F.lit(str(datetime(1970, 1, 1) + timedelta(seconds=int(cut)))).cast("timestamp_ntz")
    return df.filter(at < lit), df.filter(at >= lit)


def holdout_split(df: DataFrame, ts="event_timestamp", days: int = 30):
    """cut = midnight of (max(ts) - days); ts >= cut -> holdout."""
    cut = scalar(df, F.date_trunc("day", F.max(ts) - F.expr(f"INTERVAL {int(days)} DAYS")).cast("timestamp_ntz"))
    lit = F.lit(cut).cast("timestamp_ntz")
    return df.filter(F.col(ts) < lit), df.filter(F.col(ts) >= lit)


def resplit(full: DataFrame, val: DataFrame, ts="event_timestamp"):
    """Re-split a combined frame at min(val ts); counts must match."""
    cut = scalar(val, F.min(ts))
    return full.filter(F.col(ts) < F.lit(cut)), full.filter(F.col(ts) >= F.lit(cut))


def cold_start_filter(val: DataFrame, train: DataFrame, user="userId", item="movieId") -> DataFrame:
    """Keep validation rows whose user and item both appear in train."""
    return (val.join(train.select(user).distinct(), user, "left_semi")
               .join(train.select(item).distinct(), item, "left_semi"))


def cold_start_violations(val: DataFrame, train: DataFrame, user="userId", item="movieId") -> DataFrame:
    """Entities of ``val`` absent from ``train`` as (kind, id)."""
    u = val.select(user).distinct().join(train.select(user).distinct(), user, "left_anti") \
        .select(F.lit("user").alias("kind"), F.col(user).alias("id"))
    i = val.select(item).distinct().join(train.select(item).distinct(), item, "left_anti") \
        .select(F.lit("item").alias("kind"), F.col(item).alias("id"))
    return u.unionByName(i)


# ------------------------------------------------------------------ dedup / k-core

def dedup(df: DataFrame, keys, order, keep: str = "first") -> DataFrame:
    """A10: one row per key, the first/last under ``order`` (a list of column
    names forming a total order).  Hash aggregate with min_by/max_by."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    packed = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(packed.alias("_v")).select(*keys, "_v.*")


BROADCAST_KEYS = 500_000  # keys of a list that is sent to all tasks
COMPACT_SHARE = 0.1       # share of removed rows from which the fact table is written again


def kcore(df: DataFrame, user="userId", item="movieId", min_user: int = 5, min_item: int = 5,
          max_rounds: int | None = None) -> DataFrame:
    """Iterated k-core.  Each round keeps rows whose user has >= min_user
    rows and whose item has >= min_item rows, both counted on the same
    snapshot, until a round removes nothing.  ``max_rounds`` bounds the rounds;
    a run that has not converged by then raises.

    The rows are written once and counted once.  A round marks the keys that
    fall below their minimum, finds the rows that go with them, and takes these
    off the counts: what it writes are the counts and the rows it removes.  Lists
    of marked keys of up to ``BROADCAST_KEYS`` are broadcast, so that a round only
    scans the rows.  Once a share of the rows is gone, the table is written
    again without them.  Rows with a null user or item go in the first round."""
    keys = {user: min_user, item: min_item}

    def joined(rows: DataFrame, state: dict, how: str) -> DataFrame:
        for i, k in enumerate(keys):
            gone = state[k].where("_round is not null").select(F.col("_key").alias(f"_key{i}"), F.col("_round").alias(f"_round{i}"))
            gone = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone
            rows = rows.join(gone, F.col(k) == F.col(f"_key{i}"), how)
        return rows

    def left(facts: DataFrame, state: dict) -> DataFrame:
        return joined(facts.where(F.col(user).isNotNull() & F.col(item).isNotNull()), state, "left_anti")

    def counted(rows: DataFrame, k: str) -> DataFrame:
        return rows.where(F.col(k).isNotNull()).groupBy(F.col(k).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))

    facts = written(df, "kcore-rows")
    size, gone_rows, rounds = facts.count(), 0, 0
    below = lambda k: F.when(F.col("_n") < keys[k], F.lit(rounds + 1))
    state = {k: written(counted(facts, k).withColumn("_round", below(k)), "kcore-counts") for k in keys}
    while True:
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"k-core: no fixpoint after {max_rounds} rounds")
        when = [F.when(F.col(k).isNull(), F.lit(1)).otherwise(F.col(f"_round{i}")) for i, k in enumerate(keys)]
        removed = joined(facts.select(user, item), state, "left").where(F.least(*when) == rounds).select(user, item)
        removed = written(removed, "kcore-removed")
        many = removed.count()
        if not many:
            discard(removed)
            return left(facts, state)
        gone_rows += many
        old = dict(state)
        for k in keys:
            lost = counted(removed, k).select(F.col("_key").alias("_lost_key"), F.col("_n").alias("_lost"))
            now = old[k].join(lost, F.col("_key") == F.col("_lost_key"), "left").select("_key", (F.col("_n") - F.coalesce("_lost", F.lit(0))).alias("_n"), "_round")
            state[k] = written(now.withColumn("_round", F.coalesce("_round", below(k))), "kcore-counts")
        discard(removed, *old.values())
        if gone_rows > COMPACT_SHARE * size:
            # Keys marked for the next round stay; those of earlier rounds have no rows any more.
            before, old = facts, dict(state)
            upto = {k: state[k].where(F.col("_round") <= rounds) for k in keys}
            facts = written(left(facts, upto), "kcore-rows")
            state = {k: written(old[k].where(F.col("_round").isNull() | (F.col("_round") > rounds)), "kcore-counts") for k in keys}
            discard(before, *old.values())
            size, gone_rows = size - gone_rows, 0


# ------------------------------------------------------------------ profiling

def dataset_stats(df: DataFrame, user="userId", item="movieId") -> DataFrame:
    """Rows, distinct users/items, sparsity 1 - n/(U*I) (NULL if empty)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(user).alias("n_users"),
                  F.countDistinct(item).alias("n_items")) \
        .withColumn("sparsity", F.when((F.col("n_users") > 0) & (F.col("n_items") > 0),
                                       F.lit(1.0) - F.col("n_rows") / (F.col("n_users") * F.col("n_items"))))


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, nulls, % null, distinct non-null values, sample
    (smallest value as text).  One aggregate pass, unpivoted with ``stack``."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_z{i}"), F.countDistinct(c).alias(f"_u{i}"),
                 F.min(F.col(c).cast("string")).alias(f"_s{i}")]
    wide = df.agg(*aggs)
    parts = []
    for i, (c, t) in enumerate(df.dtypes):
        parts.append(F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"_z{i}").alias("n_null"),
                              F.round(F.col(f"_z{i}") * 100.0 / F.col("_n"), 2).alias("pct_null"),
                              F.col(f"_u{i}").alias("n_unique"), F.coalesce(F.col(f"_s{i}"), F.lit(""))
                              .alias("sample")))
    return wide.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def describe_numeric(df: DataFrame, cols, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation),
    max per numeric column.  Of integer columns the mean and the std come from
    exact sums of the distances from the least value.  ``approx=True`` uses
    percentile_approx for the quartiles."""
    kinds = dict(df.dtypes)
    whole = [c for c in cols if kinds[c] in ("tinyint", "smallint", "int", "bigint")]
    x = {c: F.col(c).cast("double") for c in cols}
    one = df.agg(*[f(x[c]).alias(f"{k}_{c}") for c in cols for k, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_samp), ("lo", F.min), ("hi", F.max))],
                 *[F.min(c).alias(f"least_{c}") for c in whole]).first()
    away = {c: (F.col(c).cast("decimal(20,0)") - F.lit(one[f"least_{c}"])).cast("decimal(18,0)") for c in whole if one[f"n_{c}"]}
    sums = df.agg(F.lit(0).alias("_"), *[f(d).alias(f"{k}_{c}") for c, d in away.items() for k, f in (("a", F.try_sum), ("b", lambda d: F.try_sum(d * d)))]).first()
    qs = [0.25, 0.5, 0.75]
    if approx:
        got = df.agg(*[F.percentile_approx(x[c], qs, accuracy).alias(c) for c in cols]).first()
        parts = {c: got[c] or [None] * 3 for c in cols}
    else:
        parts = quantiles(df, cols, qs)
    rows = []
    for c in cols:
        n, mean, std = one[f"n_{c}"], one[f"m_{c}"], one[f"s_{c}"]
        if c in away and sums[f"b_{c}"] is not None:  # None: beyond 38 digits
            a, b = int(sums[f"a_{c}"]), int(sums[f"b_{c}"])
            mean = float(one[f"least_{c}"] + Fraction(a, n))
            std = math.sqrt(Fraction(n * b - a * a, n * (n - 1))) if n > 1 else None
        rows.append((c, n, mean, std, one[f"lo_{c}"], *parts[c], one[f"hi_{c}"]))
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double")


def key_duplicates(df: DataFrame, keys) -> DataFrame:
    """J3/S9 PK check: keys that occur more than once, with their count."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1).withColumnRenamed("count", "n")


def contract_checks(df: DataFrame, rules: dict) -> DataFrame:
    """One row with the number of violating rows per named rule
    (``rules``: name -> boolean Column that is TRUE for a violation)."""
    return df.agg(*[F.count_if(F.coalesce(cond, F.lit(True))).alias(name) for name, cond in rules.items()])


# ------------------------------------------------------------------ seeded order / sample

def hash_shuffle(df: DataFrame, seed, keys, once: bool = False) -> DataFrame:
    """A seeded, partition-independent permutation: rows ordered by a
    keyed hash (ties by the keys).  Adds the permutation key ``shuffle_key``.

    The sort reads its rows twice, for the ranges and to deal them.  ``once``
    writes them with their keys first, for rows that are dear to make."""
    keyed = df.withColumn("shuffle_key", hash64(F.lit(str(seed)), *keys))
    return (written(keyed, "shuffle-keys") if once else keyed).orderBy("shuffle_key", *keys)


def hash_sample(df: DataFrame, entity: str, n: int, seed) -> DataFrame:
    """A seeded sample of ``n`` distinct entities (smallest keyed hash);
    ``limit`` on a sorted distinct set is a distributed top-n."""
    ents = df.select(entity).distinct().withColumn("sample_key", hash64(F.lit(str(seed)), F.col(entity)))
    return ents.orderBy("sample_key", entity).limit(n)


def join_metadata(events: DataFrame, items: DataFrame, item="movieId", cols=("title", "genres")) -> DataFrame:
    """M:1 left join to the item dimension (AQE broadcasts it when small)."""
    return events.join(items.select(item, *cols), item, "left")
