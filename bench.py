"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8),
``BENCH_REPEAT`` timed runs after one warm-up run each (default 1; the median counts).
``BENCH_QUERIES`` is a comma separated list, or ``all``.

The sample tables have one row group each, which a single task would read. They are first laid out in as many
files as there are CPUs, as larger tables are; that is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

HEADLINE = [
    "log_topics", "visitor_flag_repair", "rule_route_facts", "cart_add_detail",
    "order_detail_wide", "order_detail_text", "order_cancel_wide", "pay_detail_wide", "order_refund_wide",
    "refund_pay_wide", "keyword_tokens", "keyword_window", "channel_pv_window", "page_uv_window",
    "login_back_window", "order_user_window", "retract_changelog", "sku_order_window",
    "province_order_window", "refund_distinct_window", "snowflake_enrich",
]


def main() -> None:
    from rillmart.checks.queries import QUERIES
    from rillmart.session import build

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": "16m",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    there = tempfile.mkdtemp(prefix="bench-")
    for path in sorted(Path(sf).glob("*.parquet")):
        spark.read.parquet(str(path)).repartition(int(cpus)).write.parquet(f"{there}/{path.name}")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, there).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    print(json.dumps({"metric": "total seconds, warm", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
