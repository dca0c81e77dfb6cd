"""Time the headline queries; prints one JSON line.

Tables come from ``$BENCH_SF_DIR``, threads from ``$BENCH_CPUS``, runs per query from
``$BENCH_RUNS``. Every query is run once to warm up, then the median is taken.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orebelt.session import build_session  # noqa: E402
from suite import QUERIES  # noqa: E402

HEADLINE = (
    "cln_rule_counts",
    "cln_clean_rows",
    "flagship_clean_star",
    "prf_columns",
    "prf_merge_year",
    "dq_scores",
    "can_trips",
    "star_fact",
    "star_join_report",
    "star_key_check",
    "inc_equals_full",
    "str_contribution_refresh",
    "sch_drift",
    "win_lag_features",
    "aud_pipeline_runs",
    "aud_stage_runs",
)


def run(spark, function, sf_dir: str) -> float:
    begin = time.perf_counter()
    function(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, QUERIES[name], sf_dir)
        seconds[name] = round(statistics.median(run(spark, QUERIES[name], sf_dir) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
