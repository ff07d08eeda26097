"""Equi-joins of the schedule tables.

No side is broadcast by hint: Spark broadcasts what is below its own size threshold, from
file sizes when planning and from shuffle sizes at run time, and sort-merges the rest. A hot
key on the big side is cut up by AQE's skew-join handling; every join here keeps that side
on the left, where both inner and left joins may be split.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame


def attach_trips(
    stop_times: DataFrame, trips: DataFrame, how: str = "left", on: Sequence[str] = ("trip_id",)
) -> DataFrame:
    """``left`` keeps stop times without a trip (their route is NULL), ``inner`` drops them."""
    return stop_times.join(trips, list(on), how)


def attach_routes(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Add ``route_color``, NULL where the route is unknown."""
    return trips.join(routes.select("route_id", "route_color"), "route_id", "left")


def attach_stops(
    counts: DataFrame,
    stops: DataFrame,
    columns: Sequence[str] = ("stop_name",),
    how: str = "left",
    on: Sequence[str] = ("stop_id",),
) -> DataFrame:
    """Name the stops of an aggregate.

    Joined on ``stop_id`` alone, a stop that several networks list repeats the count once
    per listing; add the tag to ``on`` to match within a network.
    """
    return counts.join(stops.select(*on, *columns), list(on), how)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL matching columns by name; missing ones become NULL."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    return functools.reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), frames
    )
