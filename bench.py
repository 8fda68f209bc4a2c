"""Time the headline queries: one JSON line on stdout.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]`` (default 8). Every query is run once to
warm up and then timed to completion by writing its full result to the ``noop`` sink, so nothing is pruned away by a
count and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mercato.plans import catalog  # noqa: E402
from mercato.session import build_session  # noqa: E402

HEADLINE = [
    "top1_categories_by_revenue",
    "jn5_five_table_star",
    "agg3_revenue_metrics",
    "agg4_rfm",
    "agg5_product_performance",
    "agg7_seller_performance",
    "agg8_order_analytics",
    "agg10_payment_pivot",
    "agg18_delivery_metrics",
    "win1_top_products_per_category",
    "win3_month_over_month",
    "win5_running_spend",
    "win5_running_revenue_hot_keys",
    "snk3_bucketed_join",
    "aug1_inflate",
    "dq1_null_report",
    "dq2_duplicate_report",
    "dq4_outlier_report",
    "doc7_bulk_upsert",
    "cdc2_deletes_ignored",
    "str1_tumbling_batch",
    "str2_sliding_batch",
    "str3_sessions_batch",
    "str1_tumbling",
    "udf4_sentiment",
    "grf2_pagerank",
    "grf7_co_purchase",
    "ts3_weekly_decomposition",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="mercato-bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
