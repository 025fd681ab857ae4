"""Benchmark: time every catalogue query at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Set ``BENCH_EVENT_LOG_DIR`` (an existing folder) to also write Spark's event log there.

Each query runs to completion through the ``noop`` sink (all rows computed, nothing
collected); the catalogue is run ``BENCH_REPEATS`` times (default 2) and each query's
best time is reported. The fixture topic log and registry are derived from the tables once per
scale factor before timing (``prepare_sec``, not part of ``value``). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topiclake.plans.catalog import QUERIES  # noqa: E402
from topiclake.session import get_spark  # noqa: E402
from topiclake.sources import fixtures  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage / task timings without the UI
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = get_spark(f"local[{cpus}]", app="topiclake-bench", shuffle_partitions=int(cpus) * 2, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    t0 = time.time()
    fixtures.fixture(spark, sf_dir)
    prepare = time.time() - t0

    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for _ in range(repeats):  # best of ``repeats`` passes over the whole catalogue
        for name, fn in QUERIES.items():
            if (only and name not in only) or name in failed:
                continue
            t = time.time()
            try:
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                took = round(time.time() - t, 3)
                times[name] = min(times.get(name, took), took)
            except Exception as e:  # noqa: BLE001 - report and continue
                failed[name] = str(e)[:200]
                times.pop(name, None)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "catalogue_total_runtime", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
           "cpus": int(cpus), "prepare_sec": round(prepare, 3), "repeats": repeats, "timing": "best of repeats",
           "spark": spark.version}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
