"""Time the named queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), and
BENCH_ONLY (comma-separated name prefixes; all names by default) choose what runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerlog.catalog import QUERIES
from ledgerlog.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = tuple(p for p in os.environ.get("BENCH_ONLY", "").split(",") if p) or ("",)
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    names = [n for n in QUERIES if n.startswith(only)]
    for warm in [n for n in ("l04_cpu_trend_yesterday", "b05_agent_performance", "l11_slowest_queries") if n in QUERIES]:
        run(warm)
    seconds = {}
    for name in names:
        seconds[name] = round(run(name), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds over all named queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
