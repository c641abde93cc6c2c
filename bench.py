"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   table folder  (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)
    BENCH_QUERIES  comma-separated query names (default: the headline list)

Each query runs once to warm up and three times for its time, which is the median; all
rows are produced and thrown away by the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry  # noqa: E402
from marginalia.session import build_session  # noqa: E402

HEADLINE = (
    "prepare_reviews", "preparation_stats", "dataset_profile", "duplicate_stats",
    "curate_conflicting", "curate_three_class", "curation_audit", "curation_report", "dedup_first",
    "grouped_split", "stratified_sample", "binary_metrics", "macro_f1_by_split",
    "quantile_edges", "psi_shifted", "psi_by_day", "quality_gate", "history_audit",
    "latest_metrics", "best_epoch", "dataset_fingerprint", "vocabulary_topk", "tfidf_weights",
    "score_batch", "request_rate", "confidence_histogram", "latency_p95",
)


def run(spark, query, sf_dir) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [n for n in HEADLINE if n in registry.QUERIES]
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        query = registry.QUERIES[name][0]
        run(spark, query, sf_dir)
        times[name] = round(statistics.median(run(spark, query, sf_dir) for _ in range(repeats)), 4)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
