"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (subset).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockweave.plans.queries import queries  # noqa: E402
from stockweave.session import get_session  # noqa: E402

HEADLINE = (
    "clean_orders",
    "cleaning_report",
    "customer_summary",
    "monthly_sales",
    "product_performance",
    "warehouse_performance",
    "executive_overview",
    "inventory_status",
    "inventory_rebalancing",
    "warehouse_scoring",
    "rfm_segmentation",
    "churn_features",
    "demand_features",
    "forecast_report",
    "dq_report",
    "order_stream_clean",
    "demand_forecast",
    "churn_scores",
    "anomaly_orders",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    for name in ("customer_summary", "clean_orders"):  # start the JVM's compilers
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
