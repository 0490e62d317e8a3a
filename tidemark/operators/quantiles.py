"""Exact order statistics without sorting a column or holding it in one task.

For every wanted rank an interval is known that holds its value.  A round counts
the values of each interval in ``BUCKETS`` equal buckets, with the least and the
greatest value of each, and keeps the rank's bucket; at least one value leaves an
interval in every round, usually all but a thousandth of its width.  A round is
one partially aggregated pass for all columns; the driver gets at most
``BUCKETS`` rows for each wanted rank.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

BUCKETS = 1024


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], bounds: dict[str, tuple[float, float]]) -> dict[tuple[str, int], float]:
    """The value of each rank (from 0) of each column of doubles, of which
    ``bounds`` gives the least and the greatest."""
    open_ = {(c, r): (*bounds[c], 0) for c, rs in ranks.items() for r in rs}
    found = {}
    while True:
        found |= {k: lo for k, (lo, hi, _) in open_.items() if lo == hi}
        open_ = {k: v for k, v in open_.items() if k not in found}
        if not open_:
            return found
        spans = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in open_.items()})
        hits = []
        for i, (c, lo, hi) in enumerate(spans):
            half = F.col(c) / 2 - F.lit(lo) / 2  # halves: the width may exceed the greatest double
            bucket = F.least(F.floor(half / F.lit(hi / 2 - lo / 2) * BUCKETS), F.lit(BUCKETS - 1)) if hi / 2 > lo / 2 else (F.col(c) > lo).cast("long")
            hits.append(F.when(F.col(c).between(lo, hi), F.struct(F.lit(i).alias("i"), bucket.cast("int").alias("b"), F.col(c).alias("x"))))
        rows = df.select(F.explode(F.array_compact(F.array(*hits))).alias("h")).groupBy("h.i", "h.b").agg(
            F.count(F.lit(1)).alias("n"), F.min("h.x").alias("lo"), F.max("h.x").alias("hi")).collect()
        for key, (lo, hi, below) in list(open_.items()):
            i = spans.index((key[0], lo, hi))
            for r in sorted((r for r in rows if r["i"] == i), key=lambda r: r["b"]):
                if key[1] < below + r["n"]:
                    open_[key] = (r["lo"], r["hi"], below)
                    break
                below += r["n"]


def quantiles(df: DataFrame, cols, qs) -> dict[str, list[float | None]]:
    """Quantiles ``qs`` of numeric columns by linear interpolation between ranks.
    Nulls and values that aren't finite take no part; a column without others
    gives None."""
    x = [F.col(c).cast("double") for c in cols]
    names = [f"c{i}" for i in range(len(cols))]
    finite = [F.when(~F.isnan(v) & (F.abs(v) < math.inf), v) for v in x]
    base = written(df.select(*[v.alias(n) for v, n in zip(finite, names)]), "quantiles")
    one = base.agg(*[f(n).alias(f"{k}_{n}") for n in names for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    at = {n: [q * (one[f"n_{n}"] - 1) for q in qs] for n in names if one[f"n_{n}"]}
    ranks = {n: sorted({f(p) for p in ps for f in (math.floor, math.ceil)}) for n, ps in at.items()}
    got = order_statistics(base, ranks, {n: (one[f"lo_{n}"], one[f"hi_{n}"]) for n in at})
    out = {}
    for c, n in zip(cols, names):
        out[c] = [None] * len(qs)
        for i, p in enumerate(at.get(n, [])):
            lo, hi = got[n, math.floor(p)], got[n, math.ceil(p)]
            out[c][i] = lo if lo == hi else lo + (hi - lo) * (p - math.floor(p))
    return out
