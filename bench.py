"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Every query is forced to full evaluation with the ``noop`` sink (all columns
computed, nothing collected to the driver).  Each query is timed from a
fresh plan, including its fit jobs (vocabulary, quantiles, size checks).
Set ``BENCH_EVENTLOG`` to a scratch folder to keep Spark's event log.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "encode_timeseries",
    "encode_two_sources",
    "encode_flat",
    "encode_codes",
    "training_rows",
    "split_by_entity",
    "regression_report",
    "classification_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from hourglass.plans import catalog

    # "training_rows" times the rows as a model reads them (arrays per hour); the registered query of that
    # name explodes the same frame into cells for the row comparison
    QUERIES = {**catalog.QUERIES, "training_rows": lambda s, d: catalog.training_frame(s, d)[0]}
    from hourglass.session import local_session

    # optional Spark event log (stage and task times) into a scratch folder
    log_dir = os.environ.get("BENCH_EVENTLOG")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else {}
    extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bench-checkpoints-")  # one machine, one process
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")),
                          extra_conf=extra)
    names = [n for n in HEADLINE if n in QUERIES]
    # warm-up: JVM class loading and code generation of every headline query on
    # the smallest input, so the timed runs measure steady-state execution
    small = "/root/testdata/sf0.001"
    if os.path.isdir(small):
        for name in names:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
