"""Time the headline queries. BENCH_SF_DIR and BENCH_CPUS choose data and cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "inflow", "productivity", "open_hearings", "funnel", "report_detail", "headline_kpis", "daily_base",
    "weekly_by_day", "bi_counts", "mtd_ytd", "dense_ranks", "fact_tickets", "dim_time", "norm_text",
    "dedup_latest", "ticket_subjects", "transform_tickets", "order_status", "enrich_missing", "match_scored",
    "link_candidates", "link_tickets", "upsert", "scd2",
)


def main() -> None:
    from ticketlake.catalog import QUERIES
    from ticketlake.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf}/orders.parquet").count()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
