"""Time all queries and print one JSON line.

Every query runs over its whole tables and is written to Spark's ``noop`` sink, which computes all
rows and columns and keeps nothing. After one warm-up run, the median of up to two is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinfold.plans.catalogue import QUERIES  # noqa: E402
from kinfold.plans.session import session  # noqa: E402
from kinfold.sources.scratch import clean  # noqa: E402

#: Each query runs once to warm up and then this often; slow ones, and those that write tables, once.
RUNS = 2
#: Seconds after which a query is not repeated any more.
ENOUGH = 10


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH", os.path.abspath("spark-warehouse/bench")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in QUERIES:
        seconds = []
        while len(seconds) <= RUNS and sum(seconds) < ENOUGH:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
            clean(spark)
        times[name] = round(statistics.median(seconds[1:] or seconds), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
