"""A feed of a city's size, loaded and reported on.

    python -m stopwise_testbed.feed_trial FOLDER [copies] [sf_dir]

Writes the feed into FOLDER (events repeated ``copies`` times as stop times, customers as
stops), then times the whole work of a route dashboard on it: read the text files, join,
take the hour, and bring the rows of every report to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise_testbed import roles
from stopwise_testbed.compare import local_session
from stopwise.plans.dashboards import route_dashboard
from stopwise.sources.feeds import load_feed

HOUR = 8


def write_feed(spark: SparkSession, sf: str, folder: str, copies: int) -> dict[str, str]:
    repeat = spark.range(copies).select(F.col("id").alias("copy"))
    arrivals = roles.arrivals(spark, sf)
    times = arrivals.join(repeat).select(
        F.format_string("TRIP-%08d-%04d", (F.col("trip_id") / 20).cast("bigint"), F.col("copy"))
        .alias("trip_id"),
        F.format_string("ST%06d", "stop_id").alias("stop_id"),
        "arrival_time",
        F.col("arrival_time").alias("departure_time"),
        "route_id",
        "direction_id",
    )
    trips = times.groupBy("trip_id").agg(
        F.min("route_id").alias("route_id"), F.max("direction_id").alias("direction_id")
    )
    trips = trips.withColumn("shape_id", F.concat("route_id", F.lit("..N"), "direction_id"))
    routes = roles.routes(spark, sf).select(
        "route_id",
        F.substring("route_color", 2, 6).alias("route_color"),
        F.col("route_id").alias("route_short_name"),
    )
    stops = roles.stops(spark, sf).select(
        F.format_string("ST%06d", "stop_id").alias("stop_id"),
        "stop_name",
        "stop_lat",
        "stop_lon",
        F.lit(None).cast("string").alias("parent_station"),
    )
    tables = {
        "stop_times": times.drop("route_id", "direction_id"),
        "trips": trips,
        "routes": routes,
        "stops": stops,
    }
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}.txt"
        df.coalesce(1).write.mode("overwrite").option("header", "true").csv(paths[name])
    return paths


def reports(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    feed = load_feed(spark, paths)
    dashboard = route_dashboard(feed.stops, feed.arrivals)
    dashboard = replace(dashboard, arrivals=dashboard.digest().persist())
    return {
        "summary": dashboard.summary(),
        "trend": dashboard.trend(),
        "density": dashboard.density(HOUR),
        "top_stops": dashboard.top_stops(HOUR),
        "kpi": dashboard.kpi(HOUR),
    }


def main() -> None:
    folder = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    sf = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    paths = write_feed(spark, sf, folder, copies)
    seconds = []
    for _ in range(5):
        spark.catalog.clearCache()
        started = time.perf_counter()
        for report in reports(spark, paths).values():
            report.collect()
        seconds.append(round(time.perf_counter() - started, 2))
    parts = [part for part in os.scandir(paths["stop_times"]) if part.name.endswith(".csv")]
    size = sum(part.stat().st_size for part in parts)
    print(json.dumps({"stop_times_bytes": size, "seconds": seconds, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
