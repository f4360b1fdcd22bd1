"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores,
``BENCH_QUERIES`` a comma-separated choice, or ``all``.  Each query runs once
to warm up and is then timed with a full write to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "rule_result",
    "rule_suite_by_table",
    "c_001",
    "u_002",
    "u_005",
    "r_002",
    "cs_007",
    "br_002",
    "violations_cs_007",
    "violations_u_005",
    "u_002_pairs",
    "x_parts",
    "x_assignment_contradictions",
    "dq_score_summary_row",
    "dedup_flag",
    "dedup_rank_email",
    "dedup_keep_latest",
    "stage_customers",
    "stage_work_orders",
    "stage_technicians",
    "stage_invoices",
    "quarantine_log",
    "dim_customer",
    "fact_work_orders",
    "fact_invoices",
    "scd2_merge",
    "before_after_report",
    "pipeline_run_log",
)


def main() -> None:
    from sluice.queries import QUERIES
    from sluice.session import configure

    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"))
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-shared-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
