"""Headline queries, median of three runs in one warm session; one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "staging_select", "features_select", "load_upsert", "load_sync", "merge_classify",
    "contract_report", "row_rules", "describe_numeric", "value_counts", "iqr_outliers",
    "gap_distribution", "place_match", "page_chain", "regression_metrics", "best_per_group",
    "ml_linear",
)


def main() -> None:
    from cadastre.plans.registered import QUERIES
    from cadastre.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "bench", int(cpus) if cpus.isdigit() else 8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-warehouse-")})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        # the noop sink computes every row and column without collecting them
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
        return time.perf_counter() - started

    seconds = {}
    run("staging_select")  # starts the session and its Python side
    for name in names:
        seconds[name] = round(statistics.median(run(name) for _ in range(3)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total of medians of three",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus, "driver_memory": "16g"}))
    spark.stop()


if __name__ == "__main__":
    main()
