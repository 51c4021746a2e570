"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local threads, BENCH_MEMORY the
heap. Every query runs once untimed, so that none pays for compiling its code, and then BENCH_RUNS
times (3); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from leaguelake.catalog import QUERIES  # noqa: E402
from leaguelake.session import build_session  # noqa: E402

HEADLINE = [
    "dash_win_rate_by_team",
    "team_metrics",
    "match_metrics",
    "entering_rates",
    "team_form_split",
    "customer_orders_before",
    "schedule_simple_next5",
    "schedule_strength_next5",
    "schedule_strength_next10",
    "opponent_form_asof",
    "sos_rank",
    "consolidate_runs",
    "src_json_all_runs",
    "sink_parquet_roundtrip",
    "sink_bulk_ndjson",
    "doc_batches",
    "dash_team_ranking",
    "dash_prob_histogram",
    "dash_calibration",
    "imputed_features",
    "auc_rank",
    "rf_predictions",
    "stream_incremental",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        spark = build_session("bench", {**settings, "spark.checkpoint.dir": shared})
        spark.sparkContext.setLogLevel("ERROR")
        seconds = {}
        for name in names:
            taken = []
            for _ in range(1 + int(os.environ.get("BENCH_RUNS", "3"))):
                start = time.perf_counter()
                run(spark, name, sf_dir)
                taken.append(time.perf_counter() - start)
            seconds[name] = round(statistics.median(taken[1:]), 3)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cpus": int(cpus),
                "memory": settings["spark.driver.memory"],
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
