"""Headline queries, timed: one warm-up, then the median of three runs each. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemill.plans.catalog import REGISTRY  # noqa: E402
from tidemill.session import build_session  # noqa: E402

HEADLINE = [
    "revenue_trends", "kpis", "top_products", "orders_enriched", "mart_sales", "mart_customers", "mart_logistics",
    "product_performance", "seller_performance", "stg_trades_market", "daily_ohlcv", "crypto_daily_analytics",
    "golden_death_cross", "economic_indicators_fct", "crypto_macro_mart", "correlation_matrix", "event_impact",
    "quality_report", "stream_hourly_bars",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in wanted:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries (median of 3 warm runs each)",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf).name,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
