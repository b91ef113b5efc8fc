"""Headline queries on the bench tables; prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query runs once to the end of its plan with results thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from weftwork.plans import catalog
from weftwork.session import local_session

HEADLINES = [
    "host_top10", "url_canonical", "url_dedup", "url_build_id", "url_templates_top15", "page_text", "page_links", "page_corruption",
    "page_error_labels", "page_block_report", "page_pagination", "page_builds", "page_mods", "doc_emails_urls", "doc_redact", "http_metrics",
    "metrics_snapshot", "progress_stats", "source_summary", "error_histogram", "completeness_score", "record_validation", "mods_profile",
    "mods_bag_union", "quality_report", "stage_gate", "source_audit", "extraction_audit", "distinct_on", "row_number_rank", "consecutive_runs",
    "session_buckets", "hot_group_windows", "reconcile_ids", "relation_names", "graph_edges_or", "graph_build", "state_upsert",
    "keyword_join", "word_overlap", "category_cascade", "stream_status_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", "16g")
    queries = catalog.queries()
    queries["host_top10"](spark, folder).count()  # start-up is not part of any query
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
