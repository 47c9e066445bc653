"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` optionally a
comma-separated list of names (``all`` runs every query).  Results go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "routed_daily_counts", "regex_filter_email", "project_json_props", "issue_mapping", "chat_lines",
    "flatten_json", "json_paths", "json_delete", "json_explode", "csv_lines_to_json", "csv_to_record",
    "redact_order", "redact_json", "redact_functions", "mask_emails",
    "ts_to_unix_ms", "ts_to_string", "string_to_ts", "frame_roundtrip", "schema_lookup",
    "compact_partition", "latest_by_key", "compact_min_lag", "cdc_current", "history_intervals", "cycle_time", "poll_dedupe",
    "reconcile_topics", "lag_by_topic", "failover_union", "lead_time", "sla_compliance", "throughput_daily",
    "newest_n", "replay_reversed", "html_to_text", "chunk_fixed", "chunk_recursive",
    "vector_topk", "vector_lsh", "context_rows", "stream_transform", "stream_latest", "stream_silent_keys",
    "land_typed", "decode_by_schema", "attach_embeddings", "stream_dedupe", "json_rejects", "vector_threshold",
    "land_nested", "land_compacted", "framed_messages", "nested_compatibility", "vector_knn", "vector_range", "stream_silence_timers",
]


def main() -> None:
    from tidemill import local_session
    from tidemill.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, cpus, **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # load classes and start the Python workers before the clock runs
    spark.range(1000).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    for name in ("throughput_daily", "project_json_props", "null_defaults"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
