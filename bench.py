"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs and dimension tables are written first (reported as `prepare_sec`), as the
jobs find them in production. Every query then runs once to warm up and is timed
on the next run, from building the plan to the last row of a full write.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import queries as q
from checks.registry import QUERIES
from shipflux.session import build_session

HEADLINE = (
    "emission_report",
    "point_emission",
    "monthly_vessel_co2",
    "top_routes",
    "fact_voyage_join",
    "voyage_type",
    "interval_join",
    "point_dedup",
    "cell_join",
    "kring_nearest_join",
    "vessel_dim",
    "mode_impute",
    "ef_nox",
    "scd2",
    "variables_asof",
    "complete_months",
    "job_stats",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    q.lookups(spark, sf_dir)
    q.report_inputs(spark, sf_dir)
    prepare = time.perf_counter() - start

    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "prepare_sec": round(prepare, 3),
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
