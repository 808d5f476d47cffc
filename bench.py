"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Names given as arguments
replace the headline list; ``all`` times every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadweave.plans import catalog  # noqa: E402
from loadweave.session import build_session  # noqa: E402

HEADLINE = [
    "canonical_reads", "normalize_reads", "hourly_rollup", "daily_rollup", "monthly_rollup", "unpivot_channels",
    "wide_view", "channel_hourly", "channel_daily", "tou_tagged", "charge_line", "billing_consumption",
    "billing_recon", "sla_metrics", "dq_metrics", "obs_dashboard", "feeder_load", "feeder_anomalies",
    "meter_anomalies", "xfm_attribution", "worst_feeders", "edge_kpi", "duplicate_audit", "premise_mismatch",
    "metric_by_territory", "charge_components", "gap_fill", "late_upsert", "incremental_refresh",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(catalog.CATALOG)
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        },
    )
    # One untimed query, so that the first timed one does not pay for starting and warming the JVM.
    catalog.run("lww_dedup", spark, root).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        catalog.run(name, spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    sf = os.path.basename(root.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "meter_analytics_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
