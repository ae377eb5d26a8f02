"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs to completion into a sink that discards the rows. The value is the sum of the
times; a first untimed query starts the session's threads and classes.
"""

from __future__ import annotations

import json
import os
import time

from tidewell import session
from tidewell.plans import ALL

HEADLINE = """
    enriched_orders daily_revenue country_revenue top_products customer_360 payment_metrics executive_summary
    latest_lines rule_summary quarantined_orders merge_hard_delete scd1_state scd2_history snapshot_changes
    sliding_windows tumbling_windows sliding_stream incremental_state salted_join hot_keys skew_diagnosis
    feature_table roc_auc monitoring_metrics zorder_rewrite compact_small_files compact_partitions
    scd2_history_split top_products_in_slots customer_percentiles merge_first_load
    changes_since_version customer_360_incremental first_copies grid_join sketched_distinct
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    ALL.queries["counts_by_status"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        ALL.queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
