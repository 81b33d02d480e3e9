"""Headline queries on one machine.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[BENCH_CPUS]`` and prints one
JSON line. ``pipeline`` is the flagship query from the raw table to the factor summary, every stage
included, after one warm-up run of the same query (``warm_up``, with JVM start-up effects). The
``stage_*`` times are those of one more run, stage by stage. The remaining queries read the stored
stages of that run, the way marts are used once they are built; those on raw tables read them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from factorspark.sources.staging import release
from workload.inputs import Inputs
from workload.queries import QUERIES, callables, comparable

FLAGSHIP = "mart_factor_summary"
# attributes of a run that write a stored stage
STAGES = ["returns", "market", "month_end", "mart_scores_monthly"]
HEADLINE = [
    "price_panel",
    "consensus_prices",
    "contract_normalize",
    "contract_violations",
    "contract_dedup",
    "daily_returns",
    "market_proxy",
    "signals",
    "rebalance_dates",
    "scores",
    "forward_returns",
    "mart_factor_returns",
    "mart_ic",
    "mart_factor_summary",
    "checks_damaged_run",
    "parity_rows",
    "factor_measures",
    "cumulative_spread_spine",
    "pipeline_build",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("factorspark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        # small shuffles are not merged below the core count
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="factorspark-bench-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="factorspark-bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session()

    def seconds(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def flagship() -> None:
        drain(callables()[FLAGSHIP](spark, sf_dir))

    warm_up = seconds(flagship)
    times = {"pipeline": seconds(flagship)}
    inputs = Inputs(spark, sf_dir)
    for stage in STAGES:
        times[f"stage_{stage.strip('_')}"] = seconds(lambda: getattr(inputs.run, stage))
    for name in sys.argv[1:] or HEADLINE:
        times[name] = seconds(lambda: drain(comparable(QUERIES[name](inputs))))
    print(
        json.dumps(
            {
                "metric": "pipeline_seconds",
                "value": times["pipeline"],
                "unit": "sec",
                "queries": times,
                "warm_up": warm_up,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
