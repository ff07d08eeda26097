"""The test tables in the roles of a schedule.

events are arrivals (event type = route, user = stop), customers are the stops and the
region of a customer's nation is the borough. Suppliers are a second, shorter stop list:
they name some of the same ids in other boroughs and leave many ids out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.functions.text import hex_colour
from stopwise.operators.activity import tally
from stopwise.operators.joins import attach_routes, attach_stops

# Regions of the test tables, in the place of boroughs.
BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


# Declared, so that opening a table takes no job to look into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    clock = F.substring(F.col("ts").cast("string"), 12, 8)
    return read(spark, sf, "events").select(
        F.col("event_id").alias("trip_id"),
        F.col("user_id").alias("stop_id"),
        clock.alias("arrival_time"),
        F.col("event_type").alias("route_id"),
        F.when(F.col("value") >= 50, 1).otherwise(0).alias("direction_id"),
        F.hour("ts").alias("hour"),
    )


def routes(spark: SparkSession, sf: str) -> DataFrame:
    """All event types but errors: arrivals of that route find no colour."""
    kinds = read(spark, sf, "events").select(F.col("event_type").alias("route_id"))
    colour = hex_colour(F.upper(F.substring("route_id", 1, 6)))
    return kinds.filter(F.col("route_id") != "error").distinct().withColumn("route_color", colour)


def _placed(people: DataFrame, spark: SparkSession, sf: str, prefix: str) -> DataFrame:
    nations = read(spark, sf, "nation")
    regions = read(spark, sf, "region")
    return (
        people.join(nations, F.col(f"{prefix}_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("stop_id"),
            F.col(f"{prefix}_name").alias("stop_name"),
            F.col(f"{prefix}_acctbal").alias("stop_lat"),
            F.col(f"{prefix}_nationkey").cast("double").alias("stop_lon"),
            F.col("r_name").alias("borough"),
        )
    )


def stops(spark: SparkSession, sf: str) -> DataFrame:
    people = read(spark, sf, "customer").withColumnRenamed("c_custkey", "stop_id")
    return _placed(people, spark, sf, "c")


def depots(spark: SparkSession, sf: str) -> DataFrame:
    people = read(spark, sf, "supplier").withColumnRenamed("s_suppkey", "stop_id")
    return _placed(people, spark, sf, "s")


def coloured_tally(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    return attach_routes(tally(arrivals(spark, sf), *keys), routes(spark, sf))


def borough_tally(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """Counted before the join, so a hot stop meets the stop list as a few rows."""
    return attach_stops(tally(arrivals(spark, sf), *keys), stops(spark, sf), ["borough"])


def draft_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as trips; pending ones are not published, so their stop times are orphans."""
    orders = read(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return orders.select("o_orderkey", "o_orderstatus")
