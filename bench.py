"""Time the headline queries and print one JSON line.

Each query is built and run in full (every row and column goes to a sink that discards
it).  ``queries`` has the median of the warm runs, ``cold`` the first run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "dedup_latest",
    "dim_item",
    "dim_phase",
    "fact_key",
    "fact_unpivot",
    "item_enrich",
    "schema_align",
    "silver_e2e",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    warm_runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", master=f"local[{cores}]", partitions=cores, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = round(run(name), 3)
        warm[name] = round(statistics.median(run(name) for _ in range(warm_runs)), 3)

    print(
        json.dumps({
            "metric": "headline_queries_total",
            "value": round(sum(warm.values()), 3),
            "unit": "sec",
            "queries": warm,
            "cold": cold,
            "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            "cores": cores,
            "spark": spark.version,
        })
    )


if __name__ == "__main__":
    main()
