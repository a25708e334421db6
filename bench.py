"""Time the headline queries and print one JSON line.

Every query runs twice in one session and the second run counts (warm JVM, warm
file cache); results go to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from txnwatch.plans import catalog
from txnwatch.session import build_session, local_cpus

HEADLINE = (
    "decode_quarantine",
    "txn_validity",
    "high_value_alerts",
    "foreign_country_alerts",
    "high_frequency_alerts",
    "multi_country_alerts",
    "all_alerts",
    "alert_records",
    "dynamic_rule_matches",
    "flatten_history",
    "history_violations",
    "history_search_page",
    "history_page_meta",
    "history_append",
    "recent_alerts",
    "severity_sorted",
    "status_fold",
    "status_events",
    "case_state",
    "apply_status_changes",
    "new_alerts_only",
    "hourly_counts",
    "rule_stats",
    "period_rollup_day",
    "tps_series",
    "alert_rate_series",
    "alert_warnings",
    "latency_stats",
    "latency_histogram",
    "service_status",
    "metrics_snapshot",
    "stream_detect",
    "stream_detect_late",
    "stream_cases_late",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = local_cpus()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = catalog.registry()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": rows,
                "cpus": cpus,
                "spark": pyspark.__version__,
            }
        )
    )


if __name__ == "__main__":
    main()
