"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution,
nothing collected to the driver).  Model training is timed on its own
(``train_model``); the scoring queries then reuse the fitted model, as a
deployment would.  Each query is the median of BENCH_REPEATS (default 3)
runs, after an untimed warm-up (one report, one model fit on the smallest
given tables).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tonalyze.operators import classifier as clf  # noqa: E402
from tonalyze.plans import catalog  # noqa: E402
from tonalyze.session import build_session  # noqa: E402

HEADLINE = [
    "scored_class_stats", "score_corpus", "score_examples", "store_predictions",
    "stream_score", "csv_corpus_scan", "term_counts", "tokens_no_stop",
    "class_stats", "class_summary", "latest_predictions", "format_predictions",
    "overview", "migrate_predictions", "migration_counts", "unified_predictions",
    "class_over_time", "strip_special", "idf_weights", "nb_model_params",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", app="tonalyze-bench", shuffle_partitions=int(cpus),
                          extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
                                 # the given tables are one row group each
                                 "tonalyze.text.partitions": cpus})

    # Warm-up, not timed: JVM start, class loading and JIT of the MLlib
    # stages.  The model is fitted on the smallest given tables (a different
    # input, so nothing the timed runs use is cached by it).
    run(catalog.class_stats(spark, sf_dir))
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        catalog.trained_model(spark, warm_dir, reuse=False)
        catalog.clear_model_cache()

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    catalog.trained_model(spark, sf_dir, reuse=False)
    times["train_model"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    catalog.trained_model(spark, sf_dir, clf.ClassifierParams(hashed=True), reuse=False)
    times["train_model_hashed"] = time.perf_counter() - t0

    for name in HEADLINE:
        samples = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run(catalog.QUERIES[name](spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = statistics.median(samples)

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
