"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.  The session is
warmed up with one query; each query is then timed once, into a sink that takes all
rows and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from stayledger.session import build_session  # noqa: E402
from workload import landing, mutations, projections, relations, runs, scans  # noqa: E402,F401
from workload.registry import QUERIES  # noqa: E402

HEADLINE = (
    "agg_pace_report",
    "agg_pace_report_strict",
    "agg_pace_actual",
    "agg_pace_actual_strict",
    "agg_count_by_day",
    "agg_freshness",
    "agg_latest_snapshot",
    "join_window_clamped",
    "join_window_clamped_range",
    "join_window_clamped_lookup",
    "join_changed_keys",
    "join_gap_history",
    "prj_canonical_smile",
    "set_union_properties",
    "sink_replace_keys",
    "sink_replace_keys_stored",
    "src_tsv",
    "src_excel",
    "pipe_detail_full",
    "pipe_detail_incremental",
    "pipe_report_full",
    "pipe_report_incremental",
    "pipe_restore_history",
    "pipe_run_full",
    "pipe_run_incremental",
    "pipe_run_incremental_stored",
    "pipe_audit",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_dir = os.environ.get("BENCH_WARM_DIR", sf_dir)
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "agg_pace_report", warm_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
