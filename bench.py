"""Benchmark the headline queries.

Runs each query once as warm-up, then ``BENCH_REPEAT`` times (default 3), and
reports the median seconds per query. Execution is forced with the ``noop``
sink, so the timing covers the whole plan without collecting to the driver.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3), BENCH_QUERIES (comma list, default the headline set).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_dedupe_documents",
    "build_training_set",
    "top_up",
    "stratified_split",
    "seeded_shuffle_rank",
    "classification_report",
    "template_validation",
    "review_gate",
    "render_sites",
    "effect_validation",
    "code_blocks",
    "chunks_500",
    "batch_parse",
    "route_batch",
    "danger_tags",
    "rate_minute",
    "fallback_pick",
    "topk_vectors",
    "top1_threshold",
    "ingest_generated",
    "index_build",
    "tfidf_vectors",
    "stream_dedupe",
    "train_head",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from tessera.plans.registry import QUERIES, load_all
    from tessera.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="tessera-bench")
    load_all()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    per_query: dict[str, float] = {}
    for n in names:
        run(n)  # warm-up: JIT, file listing, Python workers
        per_query[n] = round(statistics.median(run(n) for _ in range(repeat)), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(per_query.values()), 3),
                "unit": "sec",
                "queries": per_query,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
