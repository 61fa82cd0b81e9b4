"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then `BENCH_RUNS` times (best counts), its rows written to the no-op sink. Streams
start from an empty state each time and run once; `batches` has the seconds of their micro-batches (median, longest, and
how many had rows), to hold against the 3 and 5 second intervals.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwatch import catalog  # noqa: E402
from tillwatch.session import build_session  # noqa: E402
from tillwatch.streaming.run import last_batches  # noqa: E402

HEADLINE = (
    "log_route", "event_parse", "cdc_route", "dau_rows", "dau_hourly", "new_devices", "seen_anti", "hourly_compare",
    "gmv_daily", "gmv_by_order_date", "amount_compare", "kpi_list", "orders_by_province", "sale_full_outer", "sale_wide",
    "sale_interval_join", "terms_gender", "terms_age", "gender_ratio", "age_ratio", "sale_page", "sale_report_summary",
    "sale_report_page", "match_and", "match_or", "bm25_rank", "alert_windows_all", "alert_throttled", "alert_documents",
    "upsert_last_wins", "match_han", "match_terms", "sale_report", "kpi_day", "folded_stream", "alert_store_stream", "coverage_stream",
    "dau_stream", "gmv_stream", "log_router_stream", "change_router_stream", "sale_stream", "sale_waiting_stream", "alert_stream", "sale_live_stream",
    "sale_report_kept", "search_pages",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINE
    seconds, batches = {}, {}
    for name in names:
        best = None
        first = 0 if name.endswith("_stream") else 1
        for attempt in range(first + runs):
            begun = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begun
            if attempt >= first:
                best = took if best is None else min(best, took)
        if last_batches:
            took = sorted(seconds for rows, seconds in last_batches if rows)
            if took:
                batches[name] = {"batches": len(took), "median": round(median(took), 3), "longest": round(took[-1], 3)}
            last_batches.clear()
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "batches": batches,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
