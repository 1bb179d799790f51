"""Wall seconds of the headline queries; prints one JSON line.

Results go to Spark's no-op sink, so the numbers hold the whole plan of a query and
no transfer of rows to Python.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ordertide.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "orders_tumbling_kpi",
    "orders_hopping_kpi",
    "zone_health",
    "anomaly_zones",
    "order_kpis",
    "orders_over_time",
    "on_time_trend",
    "delivery_percentiles",
    "stage_times",
    "at_risk_orders",
    "zone_rankings",
    "zone_demand_supply",
    "courier_kpis",
    "courier_activity",
    "courier_sessions",
    "gmv",
    "gmv_actual",
    "late_events",
    "duplicate_events",
    "out_of_order",
    "missing_steps",
    "unassigned_orders",
    "prep_sla",
    "route_lookup",
    "promo_match",
    "match_day_tag",
    "backfill_category",
    "finalise_events",
    "decode_json",
    "decode_avro",
    "interleave_feeds",
    "orders_tumbling_kpi_stream",
    "zone_health_stream",
]


def main(names):
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ordertide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["feed_counts"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
