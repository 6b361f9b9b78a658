"""Wall seconds of the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` (default the sf0.1 tables) on ``local[BENCH_CPUS]``.
"""

from __future__ import annotations

import json
import os
import time

from catalogue.queries import QUERIES
from murmura.session import local_session

HEADLINE = [
    "clean_rows",
    "clean_and_dedupe",
    "incremental_new_posts",
    "widening_lookback",
    "term_counts",
    "vocabulary",
    "score_posts",
    "bootstrap_ci",
    "hourly_signals",
    "summary",
    "write_partitioned_parquet",
    "stream_dedupe",
    "posts_to_hourly_signals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    QUERIES["clean_rows"](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
