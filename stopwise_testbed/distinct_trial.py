"""Time exact distinct counts three ways over the same arrivals; every run is printed.

    python -m stopwise_testbed.distinct_trial FOLDER [arrivals] [runs]

Once with few stops that come again and again, once with stops spread over a hundred times as
many ids. The day's figures come from the arrivals, from the stored digest (both count with
``Expand``) and from the stored bitmaps; building digest and bitmaps is timed too.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.plans.dashboards import route_dashboard
from stopwise_testbed.compare import local_session


def made(spark, n: int, stops: int) -> DataFrame:
    def pick(seed: int, size: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(size))

    route = F.concat(F.lit("r"), pick(1, 300))
    return spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("trip_id"),
        F.concat(F.lit("s"), pick(2, stops)).alias("stop_id"),
        route.alias("route_id"),
        pick(3, 2).cast("int").alias("direction_id"),
        F.concat(F.lit("#"), route).alias("route_color"),
        pick(4, 24).cast("int").alias("hour"),
    )


def timed(label: str, action):
    started = time.perf_counter()
    result = action()
    print(f"  {label:<28} {time.perf_counter() - started:7.2f} s", flush=True)
    return result


def main() -> None:
    folder = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 4_000_000
    runs = int(sys.argv[3]) if len(sys.argv) > 3 else 3
    spark = local_session()
    for name, stops in (("repeated", 2_000), ("spread", 200_000)):
        print(f"{name} keys: {n} arrivals, {stops} stops")
        made(spark, n, stops).write.parquet(f"{folder}/{name}")
        rows = route_dashboard(spark.range(0), spark.read.parquet(f"{folder}/{name}"))
        digest = timed("build digest", lambda: rows.stored(f"{folder}/{name}_digest"))
        index = timed("build bitmaps", lambda: digest.indexed(f"{folder}/{name}_index"))
        wanted = None
        for run in range(runs):
            for label, board in (("arrivals", rows), ("digest", digest), ("bitmaps", index)):
                day = timed(f"run {run + 1}: day, {label}", lambda b=board: sorted(b.kpi_day().collect()))
                wanted = wanted or day
                if day != wanted:
                    raise SystemExit(f"{label} gives other figures")
            for label, board in (("digest", digest), ("bitmaps", index)):
                timed(f"run {run + 1}: summary, {label}", lambda b=board: b.summary().collect())
    spark.stop()


if __name__ == "__main__":
    main()
