"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is run three times into a sink that discards rows, after a few that warm the engine up. ``queries`` has the
median, ``cold`` the first run, which also pays for planning and code generation. ``batch`` are jobs of many passes, such as
fitting a model; they are run once and are not part of the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.plans import all_queries  # noqa: E402
from orderlens.session import build_session  # noqa: E402

HEADLINE = [
    "service_headline_kpis", "service_kpis_by_state", "kpi_revenue_by_month", "kpi_revenue_by_state",
    "kpi_revenue_by_category", "kpi_on_time_rate", "kpi_delivery_days_by_month", "kpi_review_scores",
    "kpi_repeat_rate", "kpi_reviews_by_punctuality", "kpi_top_categories", "kpi_delivery_distribution",
    "kpi_payment_types", "kpi_repeat_vs_one_time_revenue", "kpi_worst_states", "kpi_worst_categories",
    "kpi_monthly_experience", "explore_category_extremes", "explore_findings", "evidence_states_worst_first",
    "report_item_view", "report_kpi_cards", "report_buyer_types", "quality_check_suite", "etl_fact_orders",
    "etl_reviews", "risk_features", "corpus_chunks", "retrieval_top_k", "routing_route", "audit_acceptance",
    "risk_split", "files_warehouse_load", "corpus_build", "evidence_packs",
]
BATCH = ["risk_logistic_mean"]
WARM_UP = ["kpi_payment_types", "etl_customers", "report_top_states", "kpi_repeat_rate", "routing_scope"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
    spark = build_session("bench", f"local[{cpus}]", int(cpus),
                          {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
                           "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()

    def seconds(name: str) -> float:
        start = time.perf_counter()
        all_queries()[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in WARM_UP * 2:
        seconds(name)
    runs = {name: [seconds(name) for _ in range(3)] for name in HEADLINE}
    queries, cold = {n: statistics.median(r) for n, r in runs.items()}, {n: r[0] for n, r in runs.items()}
    batch = {name: seconds(name) for name in BATCH}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(queries.values()), 3), "unit": "sec",
                      "queries": queries, "cold": cold, "batch": batch, "sf": os.path.basename(os.path.normpath(folder)),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
