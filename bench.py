"""Times every bound query and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores; arguments name single queries. Each query is built and its rows
fully produced (no-op sink): once to warm the JVM, then twice, of which the
faster run counts.
"""

import json
import os
import re
import sys
import time

from checks.bindings import QUERIES
from checks.compare import local_session


def produce(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def main(keys: list[str]) -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for key in keys or QUERIES:
        warm, *runs = [timed(lambda: produce(QUERIES[key](spark, directory))) for _ in range(3)]  # noqa: B023
        seconds[key] = min(runs)
    scale = re.search(r"sf([\d.]+)", directory)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
