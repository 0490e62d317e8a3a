"""Benchmark the headline queries.

Runs each query fully (``write.format("noop")`` forces every row to be
computed, nothing is collected) on ``local[$BENCH_CPUS]`` over
``$BENCH_SF_DIR`` and prints one JSON line.  A warm-up run of the first query
absorbs JVM start-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "movie_rating_stats", "movie_rating_stats_prefix", "user_rating_stats", "asof_backward",
    "kcore", "negative_samples", "item_sequences", "skipgram_pairs", "title_tfidf",
    "cosine_topk", "recommend_all_items", "two_stage_recommend", "classification_metrics",
    "stream_user_sequence",
]


def main():
    from tidemark.plans.registry import load_all
    from tidemark.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    spark = build_session(f"local[{cpus}]", app="tidemark-bench",
                          shuffle_partitions=max(8, 2 * int(cpus)))
    qs = load_all()
    names = only or HEADLINE
    if unknown := [n for n in names if n not in qs]:
        raise SystemExit(f"unknown queries: {unknown}")

    def run(name):
        t0 = time.time()
        qs[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - t0

    run(names[0])  # warm-up
    times = {}
    for n in names:
        try:
            times[n] = round(run(n), 3)
        except Exception as e:  # keep the line parseable
            times[n] = None
            print(f"# {n} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    ok = [v for v in times.values() if v is not None]
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(ok), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
