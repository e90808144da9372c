"""Time the headline queries and print one JSON line.

Every query runs over its whole tables and its whole result is produced, into Spark's noop sink.
BENCH_SF_DIR names the data, BENCH_CPUS the local threads; arguments choose other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sensorloom.catalog import QUERIES, proxies
from sensorloom.session import local_session

STORED = {
    "stored_daily": proxies.stored_daily,
    "stored_star": proxies.star_tables,
    "stored_denormalised": proxies.denormalised,
}

HEADLINE = [
    "daily_completeness",
    "daily_fact",
    "segment_daily",
    "keep_first",
    "priority_dedup",
    "wide_file_hourly",
    "wide_file_daily",
    "utc_to_local_day",
    "star_facts",
    "star_yearly_mean",
    "monthly_share_above",
    "category_side_by_side",
    "worst_days_context",
    "episode_day_before",
    "denormalised_daily",
    "pruned_month",
    "class_left_closed",
    "daily_dataset",
    "rolling7_min5",
    "lag_lead_calendar",
    "correlations",
    "group_compare",
    "fk_checks",
    "dense_ids",
    "deep_page",
    "station_document",
    "measurement_document",
    "page_tables",
    "report_rows",
    "scraped_episodes",
    "line_rebuild",
    "feature_matrix",
    "threshold_curve",
    "linear_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # The first job of a session pays for starting it.
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()
    seconds: dict[str, float] = {}
    # Tables that several queries read are written first, under names of their own.
    for name, build in STORED.items():
        start = time.perf_counter()
        build(spark, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
