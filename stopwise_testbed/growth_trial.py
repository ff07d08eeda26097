"""How the heavier reports grow with the schedule.

    python -m stopwise_testbed.growth_trial FOLDER [millions ...]

Writes the events of a test folder, repeated to so many million rows and a third of them moved to
one stop, into FOLDER, and times each query over it to the last row: a first run and four more,
all of them listed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stopwise.scratch import release_scratch
from stopwise_testbed.compare import local_session
from stopwise_testbed.queries import REGISTRY

QUERIES = (
    "route_summary",
    "borough_summary",
    "hourly_trend",
    "top_stops",
    "hour_kpi",
    "hour_kpi_all",
    "stored_digest",
)
RUNS = 5


def write_events(spark: SparkSession, sf: str, folder: str, rows: int) -> None:
    events = spark.read.parquet(f"{sf}/events.parquet")
    copies = max(1, round(rows / events.count()))
    grown = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    hot = F.when(F.rand(seed=1) < 1 / 3, F.lit(1).cast(events.schema["user_id"].dataType))
    grown = grown.withColumn("user_id", hot.otherwise(F.col("user_id")))
    grown.write.mode("overwrite").parquet(f"{folder}/events.parquet")
    for name in ("customer", "nation", "region", "supplier"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def main() -> None:
    root, sizes = sys.argv[1], [int(x) for x in sys.argv[2:]] or [20, 100]
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    for millions in sizes:
        folder = f"{root}/{millions}m"
        write_events(spark, sf, folder, millions * 1_000_000)
        for name in QUERIES:
            seconds = []
            for _ in range(RUNS):
                started = time.perf_counter()
                REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
                seconds.append(round(time.perf_counter() - started, 2))
            release_scratch(spark)
            print(json.dumps({"query": name, "million_rows": millions, "cpus": cpus, "seconds": seconds}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
