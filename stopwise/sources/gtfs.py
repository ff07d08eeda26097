"""Declared schemas of the schedule tables. Ids are always text."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "stop_lat": DoubleType(),
    "stop_lon": DoubleType(),
    "direction_id": IntegerType(),
}


def _schema(*names: str) -> StructType:
    return StructType([StructField(name, _TYPES.get(name, StringType())) for name in names])


# The columns each file has, by which it is read.
# One network, coloured by route.
STOPS = _schema("stop_id", "stop_name", "stop_lat", "stop_lon", "parent_station")
STOP_TIMES = _schema("trip_id", "stop_id", "arrival_time")
TRIPS = _schema("trip_id", "route_id", "direction_id", "shape_id")
ROUTES = _schema("route_id", "route_color", "route_short_name")

# One of several tagged networks; stop_times are the same.
TAGGED_STOPS = _schema("stop_id", "stop_name", "stop_lat", "stop_lon")
TAGGED_TRIPS = _schema("trip_id", "route_id")
