"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice, building the plan and writing every row to the no-op sink; the second
time is reported, the first one is listed as cold.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from handbill.session import tuned  # noqa: E402

HEADLINE = [
    "full_run", "apply_filters", "merge_fill", "lineitem_dedup", "cap_orders", "rank_orders",
    "budget_admission", "state_upsert", "text_norm", "parse_dates", "parse_price", "html_rows",
    "html_cards", "jsonld_walk", "pack_lines", "digest", "stream_drop_report", "stream_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        tuned(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(2):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name].append(round(time.perf_counter() - start, 3))
    warm = {name: t[-1] for name, t in times.items()}
    print(json.dumps({
        "metric": "total warm wall time of the headline queries",
        "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": {name: t[0] for name, t in times.items()},
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
