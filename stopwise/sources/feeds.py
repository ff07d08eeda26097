"""Schedule feeds: read, enrich and, for several networks, tag and union."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stopwise import storage
from stopwise.functions.schedule import hour_of
from stopwise.functions.text import hex_colour
from stopwise.operators.joins import attach_routes, attach_trips, union_by_name
from stopwise.sources import gtfs
from stopwise.sources.delimited import read_delimited

log = logging.getLogger(__name__)

# A feed is a folder holding <table>.txt files, or a URI for each table.
Feed = str | Mapping[str, str]

TAG = "borough"


class RouteFeed(NamedTuple):
    stops: DataFrame
    arrivals: DataFrame
    routes: DataFrame


class TaggedFeeds(NamedTuple):
    stops: DataFrame
    arrivals: DataFrame
    tags: tuple[str, ...] = ()


def _uri(feed: Feed, table: str) -> str:
    return f"{feed.rstrip('/')}/{table}.txt" if isinstance(feed, str) else feed[table]


def _available(spark: SparkSession, feed: Feed) -> bool:
    locations = [feed] if isinstance(feed, str) else feed.values()
    return any(storage.exists(spark, location) for location in locations)


def load_feed(
    spark: SparkSession,
    feed: Feed,
    wrap_hours: bool = False,
    lenient_hours: bool = False,
    options: Mapping[str, str] | None = None,
) -> RouteFeed:
    """One network: its stops, its arrivals with route, colour and hour, its routes.

    Routes are joined to the trips rather than to the stop times: the result is the same and
    only one join is as large as the schedule. Nothing is cached; a caller who asks several
    questions stores ``arrivals`` with ``write_table``, or a dashboard's digest of them.
    ``options`` go to the CSV reader.
    """

    def scan(table: str, schema: StructType) -> DataFrame:
        return read_delimited(spark, _uri(feed, table), schema, options)

    routes = scan("routes", gtfs.ROUTES).withColumn(
        "route_color", hex_colour(F.col("route_color"))
    )
    trips = attach_routes(scan("trips", gtfs.TRIPS), routes)
    stop_times = scan("stop_times", gtfs.STOP_TIMES)
    arrivals = attach_trips(stop_times, trips, "left").select(
        *gtfs.STOP_TIMES.names,
        *gtfs.TRIPS.names[1:],
        "route_color",
        hour_of(F.col("arrival_time"), wrap_hours, lenient_hours).alias("hour"),
    )
    return RouteFeed(scan("stops", gtfs.STOPS), arrivals, routes)


def load_feeds(
    spark: SparkSession,
    feeds: Mapping[str, Feed],
    tag: str = TAG,
    wrap_hours: bool = False,
    lenient_hours: bool = False,
    options: Mapping[str, str] | None = None,
) -> TaggedFeeds:
    """Several networks in one pair of frames, each row tagged with its network.

    Feeds that do not exist are left out; with none left this raises. Trips are matched
    after the union on tag and trip id, so equal ids of two networks never meet and the plan
    holds one join however many feeds there are. A filter on the tag still skips the stop
    times of the other feeds. ``tags`` are those of all feeds in the order given, the missing
    ones too: what a selector offers, at no cost.
    """
    tables: dict[str, list[DataFrame]] = {"stops": [], "stop_times": [], "trips": []}
    schemas = {
        "stops": gtfs.TAGGED_STOPS,
        "stop_times": gtfs.STOP_TIMES,
        "trips": gtfs.TAGGED_TRIPS,
    }
    for name, feed in feeds.items():
        if not _available(spark, feed):
            log.warning("feed %s is not there, skipped", name)
            continue
        for table, frames in tables.items():
            scan = read_delimited(spark, _uri(feed, table), schemas[table], options)
            frames.append(scan.withColumn(tag, F.lit(name)))
    stops, stop_times, trips = (union_by_name(frames) for frames in tables.values())
    arrivals = attach_trips(stop_times, trips, "inner", on=(tag, "trip_id")).select(
        *gtfs.STOP_TIMES.names,
        *gtfs.TAGGED_TRIPS.names[1:],
        tag,
        hour_of(F.col("arrival_time"), wrap_hours, lenient_hours).alias("hour"),
    )
    return TaggedFeeds(stops, arrivals, tuple(feeds))
