"""Headline benchmark: wall time of the main plans at one scale factor.

Runs each query fully (``noop`` sink, every row and column computed), once
to warm up and then ``BENCH_REPEAT`` times, and prints one JSON line with the
best time per query and their sum.  Deriving the cohort inputs from the driver
tables is timed on its own.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 3).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardline.plans.registry import REGISTRY  # noqa: E402
from wardline.session import get_session  # noqa: E402

HEADLINE = ("master_trailing", "master_cumulative", "note_asof_text", "tfidf", "roc_auc", "median_impute")


def _sf(path: str) -> float | str:
    base = os.path.basename(os.path.normpath(path))
    try:
        return float(base.replace("sf", ""))
    except ValueError:
        return base


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="wardline-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    def run(name):
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    from wardline.sources import fixtures
    t0 = time.perf_counter()
    fixtures.cohort_tables(spark, sf_dir)       # the cohort inputs are derived and written once
    derived = round(time.perf_counter() - t0, 3)
    for name in names:          # warm-up pass: JIT, generated code, file cache
        run(name)
    times = {name: float("inf") for name in names}
    for _ in range(repeat):
        for name in names:
            times[name] = min(times[name], run(name))
    times = {k: round(v, 3) for k, v in times.items()}
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "inputs_derived_sec": derived, "sf": _sf(sf_dir), "cpus": cpus,
                      "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
