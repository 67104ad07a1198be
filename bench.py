"""Wall time of the registered queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS timed runs per query (default 1; with more, the first only warms up and
the median of the others counts), BENCH_ONLY a comma-separated list of query names.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import querybook  # noqa: E402
from derrick.session import get_session  # noqa: E402
from derrick.sources.scratch import scratch_scope  # noqa: E402


def run_once(fn, spark, sf_dir: str) -> float:
    with scratch_scope(spark):
        start = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The engine itself is warmed up once: session, codegen, Python workers.
    for name in ("daily_totals", "mart_production", "iforest_flags"):
        run_once(querybook.queries()[name], spark, "/root/testdata/sf0.001")
    times: dict[str, float] = {}
    for name, fn in querybook.queries().items():
        if only and name not in only:
            continue
        taken = [run_once(fn, spark, sf_dir) for _ in range(runs)]
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
