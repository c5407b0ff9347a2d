"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is written to the noop sink, so the whole result is computed and nothing is collected. ``queries`` are the
seconds of the second run, ``cold`` those of the first, which also compiles code and fills the file cache; ``value`` is
the sum of the warm ones. The order table that several queries read is written first; its time stands on its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelwise.plans.queries import QUERIES  # noqa: E402
from parcelwise.plans.stored import stored_order_table  # noqa: E402
from parcelwise.session import local_session  # noqa: E402

HEADLINE = [
    "order_level",
    "item_level",
    "order_clean",
    "geo_agg",
    "validate_summary",
    "quarantine",
    "profile_tables",
    "describe_numeric",
    "time_split",
    "group_split",
    "baseline_median_mae",
    "drift_report",
    "drift_verdict",
    "request_metrics",
    "mae_streak",
    "score_batch",
    "model_compare",
    "stream_request_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    started = time.perf_counter()
    stored_order_table(spark, folder)
    prepared = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        for run in (cold, times):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            run[name] = round(time.perf_counter() - started, 3)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "order_table_written": prepared,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
