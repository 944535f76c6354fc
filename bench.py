"""Time all relational queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Every query runs to its last row.
"""

from __future__ import annotations

import json
import os
import sys
import time

from granary.queries import queries
from granary.session import local_session

def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    run(registered["refined_erp_location"], spark, sf_dir)  # start-up cost belongs to no query
    seconds = {}
    for name in registered:
        seconds[name] = run(registered[name], spark, sf_dir)
        print(name, seconds[name], file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
