"""Times every warehouse query and prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local threads. Each
query runs twice after a warm-up and the faster run counts; results go to a sink that
reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import time

from tallyward.plans.warehouse import QUERIES
from tallyward.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "screening_funnel_monthly")
    times = {name: round(min(run(spark, name) for _ in range(RUNS)), 3) for name in QUERIES}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
