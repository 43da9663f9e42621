"""Times the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Every query runs whole into a sink that discards its rows.
A few queries warm the JVM first; the figure is the median of $BENCH_RUNS rounds (1).
$BENCH_QUERIES picks queries by name (comma separated).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomledger.catalog.queries import QUERIES
from roomledger.session import local_session


WARM_UP = ("gold_revenue_by_hotel_year", "bronze_rows", "q4_quarterly_cancellations")


def timed(spark, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)

    seconds = {}
    with tempfile.TemporaryDirectory(prefix="roomledger-bench-") as shared:
        settings = {"spark.sql.shuffle.partitions": cpus, "spark.checkpoint.dir": shared}
        spark = local_session(cpus, **settings)
        try:
            for name in WARM_UP:
                timed(spark, QUERIES[name], sf_dir)
            for name in names:
                rounds = [timed(spark, QUERIES[name], sf_dir) for _ in range(runs)]
                seconds[name] = round(statistics.median(rounds), 3)
        finally:
            spark.stop()
    result = {
        "metric": "total seconds of all registered queries, warm",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
