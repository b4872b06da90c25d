"""Time the headline queries: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` set data and cores."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.queries import QUERIES  # noqa: E402
from tools.session import local_session  # noqa: E402

HEADLINE = [
    "deterministic_report",
    "deterministic_report_repeated_ids",
    "check_status",
    "route_prefix_all_versions",
    "route_hash_sample",
    "row_quality",
    "score_every_input_row",
    "score_unscored_only",
    "score_batch_pandas",
    "gate_decision",
    "review_queue",
    "release_closed_versions",
    "metrics_roundtrip",
    "drift_by_version",
    "drift_trend",
    "latency_p50_p95",
    "confusion_counts",
    "loop_metrics",
    "drift_manifest",
    "export_manifest_roundtrip",
    "stream_scored",
    "full_loop",
    "score_batch_throttled",
    "gate_with_rejects",
]


def run(spark, name, folder):
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    small = Path(folder).parent / "sf0.001"
    warm = str(small) if small.exists() else folder
    for name in HEADLINE:
        run(spark, name, warm)
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        run(spark, name, folder)
        times[name] = round(time.perf_counter() - began, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name}))


if __name__ == "__main__":
    main()
