"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores. Each query is run to the end
with every result column computed, into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import QUERIES  # noqa: E402
from tripflow import build_session  # noqa: E402

HEADLINE = (
    "k3_flagship_daily",
    "p4_adapt",
    "p13_reject_reason",
    "s6_decode_wire",
    "a1_window_zone_5min",
    "w1_late_events",
    "w2_first_copy",
    "a12_pair_median",
    "a5_evaluate_daily",
    "s13_merge_changed",
    "t6_monthly_sample",
    "q1_hot_windows",
    "q2_hot_top_zones",
    "q3_cold_daily",
    "q4_reconciliation",
    "q6_live_predictions",
    "q7_prediction_windows",
    "l5_all_rules",
    "r3_final_windows",
    "k4_hot_path",
    "k1_bulk_load",
    "k3_aggregate_daily",
    "k7_evaluate",
    "q5_daily_eval",
    "q8_prediction_range",
    "q9_prediction_freshness",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tripflow-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").agg({"l_quantity": "sum"}).collect()
    # Start-up and the first compilation belong to no query: the flagship plan is run once before the clock.
    QUERIES[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
