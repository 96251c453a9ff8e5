"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads (default: all)
"""

from __future__ import annotations

import json
import os
import re
import time

from mediacat.plans.registry import registered
from mediacat.session import build_session

HEADLINE = (
    "batch_transform", "batch_write", "status_profile", "latency_quantiles",
    "list_objects", "objects_since", "select_keys", "attach_tags", "derive_ids", "validate_valid", "validate_summary",
    "retention_bytes", "manifest_stats",
    "dedupe_latest", "upsert_replace", "upsert_guarded", "upsert_merge", "delete_rows", "get_video", "list_videos_page",
    "list_indexes", "pending_embedding", "apply_embedding", "catalog_commits",
    "task_status", "task_deadline", "stage_latency", "batch_progress", "batch_summary", "batch_results",
    "search_topk", "search_multi", "search_by_video", "search_filtered", "search_next_page", "parse_hits",
    "embed_text", "generate_text", "write_vector_table",
    "deep_page", "search_approx", "stream_upsert", "ingestion_run", "embedding_run",
)
RUNS = 2


def seconds(run, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    seconds(queries["batch_transform"].run, spark, sf_dir)  # start-up is not part of the first query
    times = {}
    for name in HEADLINE:
        times[name] = round(min(seconds(queries[name].run, spark, sf_dir) for _ in range(RUNS)), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
