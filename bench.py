"""Time the registered queries; prints one JSON line.

Each query runs to a sink that discards rows, once to warm up and then three
times; its figure is the median. BENCH_SF_DIR and BENCH_CPUS choose the tables
and the cores, BENCH_QUERIES a comma-separated choice of keys.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from entries.queries import REGISTRY

HEADLINE = [
    "weekly_collection",
    "weekly_collection_one",
    "monthly_by_unit_year",
    "monthly_by_unit_year_one",
    "monthly_by_unit_month_one",
    "collection_by_source",
    "collection_by_source_one",
    "top_expense_months",
    "top_expense_months_one",
    "top_income_months",
    "top_income_months_one",
    "top_debtors",
    "top_debtors_one",
    "top_debtors_min",
    "payment_gaps",
    "payment_gaps_one",
    "category_expense",
    "category_chart_row",
    "category_chart_row_one",
    "join_owner_or_tenant",
    "payments_by_unit",
    "category_share_total",
    "derive_extra_expenses",
    "prorate_month",
    "financial_state",
    "layout_weekly",
    "xml_roundtrip_units",
    "import_csv_valid",
    "import_payments",
    "import_log",
    "import_json_expenses",
]
RUNS = 3


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begun = time.perf_counter()
        REGISTRY[name](spark, path).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(path.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
