"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores, BENCH_RUNS the
timed runs per query (the median counts). Every query runs once before it is timed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from lakeops.queries import QUERIES
from lakeops.session import build_session

HEADLINE = [
    "pip01_enrich_silver", "pip02_period_kpi", "pip02_period_kpi_merge", "pip03_star_kpi", "pip07_skewed_segments",
    "pip08_daily_revenue", "pip08_top_customers", "agg03_kpi", "agg04_daily_kpi", "agg07_rollup", "agg08_cube",
    "agg10_pivot", "agg15_salted_totals", "agg17_skew_profile", "agg20_one_exchange", "agg21_numeric_profile",
    "jon04_broadcast", "jon07_sort_merge", "jon08_shuffled_hash", "jon11_star", "jon16_salted", "jon19_hot_keys_found",
    "jon20_adaptive_skew_join", "win01_row_number", "win03_dense_rank", "win04_latest_per_key", "win06_top_n_per_group",
    "win07_lag_lead", "set06_minus", "dq02_metrics", "snk10_dynamic_overwrite", "inc01_late_data_merge",
    "str07_silver_upsert",
]

# Rewritten tables and drained streams take seconds, so they are timed once.
ONCE = {"snk10_dynamic_overwrite", "inc01_late_data_merge", "str07_silver_upsert"}


def run(spark, name: str, directory: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "lakeops-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {}
    for name in HEADLINE:
        if name in ONCE:
            timed[name] = round(run(spark, name, directory), 3)
            continue
        run(spark, name, directory)
        timed[name] = round(statistics.median(run(spark, name, directory) for _ in range(runs)), 3)
    rows = spark.read.parquet(f"{directory}/lineitem.parquet").count()
    line = {
        "metric": "headline_total",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
        "kpi_rows_per_sec": round(rows / timed["agg03_kpi"]),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
