"""Times headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every query runs to a full result (no-op sink). The city layers are built once before timing, as the layered
build does; each time is the median of $BENCH_RUNS runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "c03_star",
    "c04_interval_join",
    "c05_spatial_join",
    "d05_exact_avg",
    "d08_two_level",
    "d13_hourly_resample",
    "d14_local_day_rollup",
    "d15_correlation",
    "d16_quantiles",
    "e01_latest_wins",
    "e03_forward_fill",
    "e05_version_numbers",
    "e06_validity_intervals",
    "e11_time_gaps",
    "i01_delete_insert",
    "i08_dense_fill_orders",
    "i10_measured_hours",
    "i11_fact_bike",
    "i12_fact_air",
    "i13_fact_weather",
    "i14_mart",
    "j14_report",
    "l03_district_correlations",
    "l06_hourly_pollutant_wind",
    "l08_bike_daily",
    "l13_bike_growth",
)


def main() -> None:
    from citylake.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    from catalog import QUERIES

    times: dict[str, float] = {}
    for name in names:
        measured = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - began)
        times[name] = round(statistics.median(measured[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
