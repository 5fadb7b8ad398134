"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

Each query is built and run into a no-op sink: one warm-up, then the median of
BENCH_REPEATS runs. The value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tributary.plans.catalogue import QUERIES  # noqa: E402
from tributary.session import local_session  # noqa: E402

HEADLINE = [
    "star_join_extract",
    "csv_header_scan",
    "paged_json_scan",
    "source_tag_union",
    "column_compare_report",
    "normalize_text",
    "canonical_unknown",
    "recode_map",
    "code_name_reconcile",
    "safe_numeric",
    "safe_date_mixed",
    "completed_years",
    "group_sum_null_zero",
    "consolidate",
    "mode_per_group",
    "value_share_topk",
    "duplicate_count",
    "column_describe",
    "histogram",
    "label_encode",
    "surrogate_dim_ranges",
    "fact_build",
    "validate_rules",
    "report_year_group",
    "scored_records",
    "flagship",
    "flow_star",
    "record_star",
    "star_load",
    "extend_dimension",
]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, sf_dir)
        runs = [timed(QUERIES[name], spark, sf_dir) for _ in range(repeats)]
        seconds[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
