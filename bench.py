"""Benchmark of the headline marts.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8): one warm-up pass over all queries, then ``$BENCH_RUNS``
(default 5) timed rounds, each starting with another query so that none always
runs first or after the same one. Every run is on a freshly built plan and
forced by a ``noop`` write (every column computed, nothing collected). Prints
one JSON line with the median seconds per query; ``value`` is their sum, and
``minimum`` and ``spread`` show how much of a change is noise.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from agora.plans.pipeline import from_testdata  # noqa: E402
from agora.session import build_session  # noqa: E402

HEADLINE = {
    "int_orders_enriched": lambda p: p.int_orders_enriched,
    "mart_revenue_monthly": lambda p: p.mart_revenue_monthly,
    "mart_delivery_performance": lambda p: p.mart_delivery_performance,
    "mart_seller_health": lambda p: p.mart_seller_health,
    "rfm_segmentation": lambda p: p.rfm_segmentation,
}


def _run(spark, sf_dir: str, build) -> float:
    t0 = time.perf_counter()
    df = build(from_testdata(spark, sf_dir))  # plan construction is part of the time
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = build_session(f"local[{cpus}]", app_name="agora-bench",
                          shuffle_partitions=partitions,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    for build in HEADLINE.values():  # warm-up pass over every query (JIT, caches)
        _run(spark, sf_dir, build)
    names = list(HEADLINE)
    times: dict[str, list[float]] = {name: [] for name in names}
    for turn in range(runs):
        first = turn % len(names)
        for name in names[first:] + names[:first]:
            times[name].append(_run(spark, sf_dir, HEADLINE[name]))
    medians = {name: round(statistics.median(t), 3) for name, t in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_marts_median_sum",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "minimum": {name: round(min(t), 3) for name, t in times.items()},
        "spread": {name: round(max(t) - min(t), 3) for name, t in times.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "config": {"master": f"local[{cpus}]", "shuffle_partitions": partitions,
                   "spark": spark.version, "runs": runs, "aqe": True},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
