"""Benchmark: every headline slice, load and reclassification job at $BENCH_SF_DIR on local[$BENCH_CPUS].

Input relations are derived from the TPC-H-style tables and staged as Parquet once
(untimed, reported as ``stage_sec``); one untimed warm-up run of the flagship slice, then each job is
planned and fully executed into a no-op sink ($BENCH_REPEATS times, default 1; the
fastest run is reported).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from slicewright.registry import HEADLINE, JOBS  # noqa: E402
from slicewright.session import build_session  # noqa: E402
from slicewright.sources.staging import stage_fixtures  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    only = [k for k in os.environ.get("BENCH_ONLY", "").split(",") if k]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    t0 = time.time()
    tables = stage_fixtures(spark, sf_dir)
    stage = time.time() - t0
    # warm-up (untimed): the flagship slice once, so JIT compilation is not charged to the
    # first timed job
    JOBS["sales_order_slice_split"](spark, tables).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for key in HEADLINE:
        if only and key not in only:
            continue
        job = JOBS[key]
        best = None
        for _ in range(repeats):
            s = time.time()
            job(spark, tables).write.format("noop").mode("overwrite").save()
            d = time.time() - s
            best = d if best is None else min(best, d)
        times[key] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_job_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "stage_sec": round(stage, 3),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
