"""Time the registered queries over one folder of tables and print one JSON line.

BENCH_SF_DIR  folder of parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    threads (default 8)
BENCH_ONLY    comma-separated query names (default: all)

Every query runs to its end: all rows of all columns are computed and dropped (noop sink).
"""

from __future__ import annotations

import json
import os
import time

from sitewell.plans import registered
from sitewell.session import session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        registered.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("source_counts")  # starts executors and loads classes; not a result
    seconds = {name: round(run(name), 3) for name in only or registered.QUERIES}
    print(json.dumps({"metric": "total_wall_clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
