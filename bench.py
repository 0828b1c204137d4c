"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_QUERIES (comma-separated names; default the headline list).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from lakeops.queries import QUERIES
from lakeops.session import get_spark

HEADLINE = [
    "ag1_group_totals", "ag2_distinct_counts", "wn1_latest_per_key", "wn6_rolling_week", "wn8_repeat_purchase",
    "wn10_surrogate_key", "jn3_left_star", "jn7_asof_join", "jn9_event_transitions", "str7_sessions", "tf1_store_sales_ranking",
    "c1_lifetime_value", "c2_rfm_measures", "c7_rfm_segments", "c10_gold_users", "c14_gold_order_lines",
    "c15_gold_orders", "fc1_daily_series", "fc3_forecast", "fc5_forecast_errors", "fc8_stock_mart",
    "rc7_preference_rerank", "rc9_packed_lists", "ml1_transfer_features", "ml4_ratio_features", "tx1_prompts",
    "tx2_text_model", "tx8_topics_to_rows", "up1_merge_with_map",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    shared = tempfile.TemporaryDirectory(prefix="lakeops-bench-")
    spark = get_spark("lakeops-bench", f"local[{cpus}]", **{
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR", f"file://{shared.name}"),
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["ag1_group_totals"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
