"""Benchmark of the headline queries.

Runs each query on the tables at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] (default 8), materialises the full result with the
``noop`` sink (every column computed, nothing collected), and prints one JSON
line with, per query, the median of $BENCH_REPEAT runs (default 3), the first
run (cold: code is compiled, file listings and footers are read) and the median
of the others (warm), and the cores used and present. With $BENCH_EVENTLOG_DIR set, Spark's event log (stage and task times) is written
there for offline reading.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caldim.plans import catalog  # noqa: E402
from caldim.session import build_session  # noqa: E402

HEADLINE = [
    "orders_period_to_date",
    "orders_by_fin_period",
    "lineitem_calendar_rollup",
    "lineitem_date_attributes",
    "events_time_of_day",
    "events_daypart",
    "events_interval_profile",
    "time_of_day_event_counts",
    "date_dim",
    "merge_upsert",
    "roll_dim",
    "dim_quality_checks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    extra = {}
    if os.environ.get("BENCH_EVENTLOG_DIR"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENTLOG_DIR"]}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app="caldim-bench", extra_conf=extra)
    times: dict[str, float | None] = {}
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in HEADLINE:
        fn = catalog.QUERIES[name]
        runs = []
        try:
            for _ in range(repeat):
                t = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t)
            times[name] = round(statistics.median(runs), 3)
            cold[name] = round(runs[0], 3)
            warm[name] = round(statistics.median(runs[1:] or runs), 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not lose the others' timings
            times[name] = None
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(v for v in times.values() if v is not None), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cold": cold,
                "warm": warm,
                "sum_warm": round(sum(warm.values()), 3),
                "cpus": cpus,
                "cpus_present": os.cpu_count(),
                "repeat": repeat,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
