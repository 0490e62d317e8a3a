"""Scalar Column helpers (F1-F18).  All are built-in expressions, so they stay
inside whole-stage codegen and are shared by the batch and streaming paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: lag-bucket thresholds in seconds (strict "<"), buckets 0..9 ---
# 10 minutes, 1 hour, 1 day, 7 days, 30 days, 365 days, 3 years, 5 years, 10 years
SEC_MIN = 60
SEC_HOUR = 60 * 60
SEC_DAY = 24 * SEC_HOUR
SEC_WEEK = 7 * SEC_DAY
SEC_MONTH = 30 * SEC_DAY
SEC_YEAR = 365 * SEC_DAY
BUCKET_EDGES = [10 * SEC_MIN, SEC_HOUR, SEC_DAY, SEC_WEEK, SEC_MONTH,
                SEC_YEAR, 3 * SEC_YEAR, 5 * SEC_YEAR, 10 * SEC_YEAR]

# --- fixed values: text formats ---
ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"     # strftime %Y-%m-%dT%H:%M:%S.%fZ
PAD = -1                                              # sequence padding value
UNKNOWN_ITEM = "unknown_item"                         # reverse-lookup sentinel


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Naive (UTC) timestamp -> epoch seconds.  Needs session tz UTC."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def epoch_millis(ts) -> Column:
    return F.unix_millis(_c(ts).cast("timestamp"))


def from_epoch_seconds(s) -> Column:
    """Epoch seconds -> naive UTC timestamp (TIMESTAMP_NTZ)."""
    return F.timestamp_seconds(_c(s)).cast("timestamp_ntz")


def lag_bucket(seconds) -> Column:
    """lag in seconds -> bucket 0..9 (strict upper edges)."""
    s = _c(seconds)
    expr = F.lit(len(BUCKET_EDGES))
    for i in range(len(BUCKET_EDGES) - 1, -1, -1):
        expr = F.when(s < BUCKET_EDGES[i], F.lit(i)).otherwise(expr)
    return expr


def bucket_list(seq, ref_seconds) -> Column:
    """Bucket each element of a padded epoch-second list against a
    reference second; padding stays -1."""
    ref = _c(ref_seconds)
    return F.transform(_c(seq), lambda x: F.when(x == PAD, F.lit(PAD))
                       .otherwise(lag_bucket(ref - x)))


def pad_left(arr, n: int, fill=PAD) -> Column:
    """keep the last ``n`` elements, left-pad with ``fill`` to length n."""
    a = _c(arr)
    kept = F.when(F.size(a) > n, F.slice(a, -n, n)).otherwise(a)
    return F.concat(F.array_repeat(F.lit(fill).cast("long"), F.greatest(F.lit(n) - F.size(kept), F.lit(0))),
                    kept.cast("array<long>"))


def safe_long(c, default=None) -> Column:
    """tolerant integer parse of text.  NULL, "None", blanks, anything
    that is not an integer literal (e.g. "4.5") and integers beyond a long
    give ``default``.  For numeric input see :func:`integral`."""
    t = F.trim(_c(c).cast("string"))
    v = F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))
    return v if default is None else F.coalesce(v, F.lit(default).cast("long"))


def integral(c) -> Column:
    """F12 for a numeric column: its value as a long where it is a whole number
    within a long, else NULL."""
    x = _c(c)
    return F.when(x == F.floor(x), x.try_cast("long"))


def safe_double(c, default=None) -> Column:
    """tolerant float parse of text ("None", junk -> ``default``)."""
    t = F.trim(_c(c).cast("string"))
    v = F.when(t.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), t.cast("double"))
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def mask_secret(c) -> Column:
    """F16: first two characters + '***'; up to two characters -> '***';
    empty or NULL -> '(empty)'."""
    s = _c(c)
    return (F.when(s.isNull() | (F.length(s) == 0), F.lit("(empty)"))
             .when(F.length(s) > 2, F.concat(F.substring(s, 1, 2), F.lit("***")))
             .otherwise(F.lit("***")))


def hash64(*parts) -> Column:
    """Deterministic 60-bit keyed hash as BIGINT: first 15 hex digits of
    md5('p1|p2|..').  Partition-independent and reproducible in SQL."""
    text = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_uniform(*parts) -> Column:
    """u in (0, 1) from :func:`hash64`."""
    return (hash64(*parts).cast("double") + F.lit(0.5)) / F.lit(float(1 << 60))


def iso_micros(ts) -> Column:
    return F.date_format(_c(ts), ISO_MICROS_Z)


def dot(a, b) -> Column:
    """dot product of two numeric arrays (computed in double)."""
    z = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(z, F.lit(0.0), lambda acc, v: acc + v)


def l2norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))


def cosine(a, b, eps: float = 1e-12) -> Column:
    return dot(a, b) / F.greatest(l2norm(a) * l2norm(b), F.lit(eps))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def csv_tokens(c) -> Column:
    """F8: split a comma list, dropping blank tokens."""
    return F.filter(F.split(F.coalesce(_c(c), F.lit("")), ","), lambda x: F.trim(x) != "")


def r6(c) -> Column:
    """Round to 6 decimals (the precision all float results are compared at)."""
    return F.round(_c(c).cast("double"), 6)
