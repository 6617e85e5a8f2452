"""Time the headline queries; one JSON line on stdout.

Every query is planned and run in full (its rows go to a no-op sink) after one
warm-up query; the figure is the median of RUNS runs. Studies that take longer
than LONG seconds run once. Each time is also printed to stderr as it ends. A run
is stopped after LIMIT seconds, and no query starts after TOTAL; such queries are
listed as ``stopped`` and are not part of the sum.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time
from statistics import median

from gridpanel import catalog
from gridpanel.session import local_session

RUNS = 3
LONG = 10
LIMIT = 400
TOTAL = 1300

HEADLINE = [
    "prev_period_position",
    "prev_season_position",
    "rolling_gain",
    "session_pivot",
    "feature_panel_exact",
    "feature_panel_points",
    "feature_panel_podium",
    "snowflake_join_chain",
    "insert_if_absent",
    "insert_if_absent_pair",
    "fill_if_null",
    "merge_circuits",
    "mint_meetings",
    "external_id_lookup",
    "missing_seasons",
    "quarantine_split",
    "json_extract_events",
    "last_value_per_key",
    "final_positions",
    "conditional_row_expansion",
    "nested_documents",
    "session_documents",
    "expanding_window_folds",
    "standard_scaling",
    "rule_accuracy",
    "classification_report",
    "fit_to_box",
    "segment_midpoints",
    "range_slice",
    "arff_lines",
    "feature_panel_text",
    "geometry_round_trip",
    "race_folds",
    "svm_linear",
    "points_folds",
    "model_compare",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=8, memory="12g")
    run(spark, folder, "prev_period_position")
    started, seconds, stopped = time.time(), {}, []
    for name in chosen:
        found = timed(spark, folder, name) if time.time() - started < TOTAL else None
        if found is None:
            stopped.append(name)
        else:
            seconds[name] = round(found, 3)
        print(name, "stopped" if found is None else seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "stopped": stopped,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


def timed(spark, folder: str, name: str) -> float | None:
    """Median of the runs; None if one had to be stopped."""
    context = spark.sparkContext
    runs = []
    while not runs or (len(runs) < RUNS and runs[0] < LONG):
        context.setJobGroup(name, name, interruptOnCancel=True)
        over = threading.Event()

        def stop() -> None:
            # a study starts new jobs after one is cancelled, so this goes on until the run has ended
            while not over.wait(1):
                if time.time() - began > LIMIT:
                    context.cancelJobGroup(name)

        began = time.time()
        watch = threading.Thread(target=stop, daemon=True)
        watch.start()
        try:
            runs.append(run(spark, folder, name))
        except Exception as error:  # noqa: BLE001 - a stopped or failed query must not take the other figures with it
            print(name, type(error).__name__, str(error)[:200], file=sys.stderr, flush=True)
            return None
        finally:
            over.set()
            watch.join()
    return median(runs)


def run(spark, folder: str, name: str) -> float:
    started = time.time()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.time() - started


if __name__ == "__main__":
    main()
