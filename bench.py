"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of sample tables, BENCH_CPUS the local cores.
Reports are timed over the given Parquet files with a sink that discards rows;
the landing zone made from them is written beforehand and timed on its own.
"""

from __future__ import annotations

import json
import os
import pathlib
import re
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from floodmark.samples import documents, queries
from floodmark.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

REPORTS = [
    "v_alert",
    "v_alert_mitigations",
    "v_alert_types__of_alerts",
    "v_directions__of_alerts",
    "v_managed_object_names__of_alerts",
    "v_security_levels__of_alerts",
    "v_mitigation_subtypes__of_alerts",
    "drop_totals",
    "alert_duration",
    "series_sum",
    "latest_per_key",
    "scan_alerts_window",
    "flatten_alerts",
    "flatten_mitigations",
    "rates_flowspec",
]
# These write tables as they are built.
WRITES = [
    "upsert_alerts",
    "upsert_mitigations",
    "initial_load",
    "incremental_load",
    "refresh_ongoing",
    "stream_upsert",
]
REPORT_RUNS = 3


def timed(spark, build) -> float:
    start = time.perf_counter()
    build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The report itself, without the plain column types results are compared in.
    builds = {**queries.all_queries(), "v_alert": queries.report}
    start = time.perf_counter()
    documents.landing_of(spark, SF_DIR, *documents.DOCUMENTS_OF)
    landing_seconds = time.perf_counter() - start
    seconds = {}
    for name in REPORTS:
        # The first run compiles the plan; of the others the quickest counts.
        seconds[name] = min(timed(spark, builds[name]) for _ in range(REPORT_RUNS))
    for name in WRITES:
        seconds[name] = timed(spark, builds[name])
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": float(scale.group(1)) if scale else None,
                "landing_seconds": round(landing_seconds, 3),
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
