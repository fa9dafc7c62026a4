"""Benchmark: the full pipeline and the headline queries at one scale factor.

Prints ONE JSON line:
  {"metric": "pipeline_wall", "value": <sec>, "unit": "sec", "queries": {...}, "sf": ...}

``value`` is the wall time of one full run (raw tables -> cleaning -> SDTM ->
conformance -> ADaM -> seven safety tables -> every output written), the
reference's "full pipeline wall time". ``queries`` times each headline query
on its own, executed through the ``noop`` sink (full computation, no collect).
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trialguard.plans import catalog, pipeline  # noqa: E402
from trialguard.session import local_session  # noqa: E402
from trialguard.sources import fixtures  # noqa: E402

HEADLINE = (
    "dm_findings", "ae_clean", "lb_clean", "sdtm_ae", "sdtm_lb", "adsl", "adae", "adlb", "conformance",
    "demographics", "teae_overview", "teae_soc_pt", "risk_differences", "lab_shift", "hys_law", "lab_mean_change",
    "findings", "dashboard_kpis",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="trialguard-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=cpus, memory="16g", **{"spark.local.dir": scratch})

    # warm-up (JVM, codegen caches): one small query, not timed
    catalog.QUERIES["safety_n"](spark, sf_dir).collect()

    t0 = time.time()
    raw = fixtures.raw_bundle(spark, sf_dir)
    result = pipeline.run(spark, raw, out_dir=f"{scratch}/out")
    pipeline_sec = time.time() - t0

    times = {}
    for name in HEADLINE:
        t = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    print(
        json.dumps(
            {
                "metric": "pipeline_wall",
                "value": round(pipeline_sec, 3),
                "unit": "sec",
                "queries": times,
                "queries_total": round(sum(times.values()), 3),
                "sf": sf,
                "cpus": cpus,
                "status": result.status,
                "records": result.manifest.get("records", {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
