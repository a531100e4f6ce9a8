"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnwright.plans import QUERIES  # noqa: E402
from churnwright.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_churn_by_split",
    "p12_median_fill",
    "p16_cap_iqr",
    "f4_frequency_encode",
    "f9_quantile_bins",
    "c3_previous_lengths",
    "c7_past_churns",
    "c8_topup_lookback",
    "c10_as_of_attributes",
    "j1b_salted_lookup",
    "a6_schema_profile",
    "a11_box_stats",
    "a12_correlations",
    "a15_association_ranking",
    "a18_moments",
    "l7_time_split",
    "l9_stratified_split",
    "l12_expanding_blocks",
    "e1_threshold_curve",
    "e7_full_evaluation",
    "e13_cohort_metrics",
    "e15_promotion",
    "v_all_checks",
    "m5_violations",
    "m8_drift_table",
    "m11_drift_by_day",
    "m13_fairness",
    "m15_windowed_monitor",
    "x1_ordered_scan",
    "t1_boosted_trees",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the executors
    seconds, failed = {}, {}
    for key in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        try:
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[key] = round(time.perf_counter() - start, 3)
        except Exception as e:  # noqa: BLE001  the other figures are still wanted
            failed[key] = str(e).splitlines()[0][:200]
    sf = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else folder,
                **({"failed": failed} if failed else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
