"""Grouped schedule metrics.

Every function takes single arrivals or a tally of them (``operators.activity``). ``by`` is
the selector column: the route of one network, or the tag of several.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.operators.activity import arrival_count, at_hour, chosen, present, trip_count


def summary(
    arrivals: DataFrame,
    by: str,
    distinct: Mapping[str, str],
    selected: Sequence | None = None,
) -> DataFrame:
    """``total_arrivals`` per ``by``, and for each output name the distinct values of a column."""
    picked = chosen(arrivals, by, selected)
    return picked.groupBy(by).agg(
        trip_count(picked).alias("total_arrivals"),
        *[F.countDistinct(column).alias(name) for name, column in distinct.items()],
    )


def route_summary(arrivals: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    distinct = {"unique_stops": "stop_id", "directions": "direction_id"}
    return summary(arrivals, "route_id", distinct, selected)


def borough_summary(arrivals: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    distinct = {"unique_routes": "route_id", "unique_stops": "stop_id"}
    return summary(arrivals, "borough", distinct, selected)


def hourly_trend(
    arrivals: DataFrame, by: str = "route_id", selected: Sequence[str] | None = None
) -> DataFrame:
    """Arrivals per hour and selector value, hours past 23 included."""
    picked = present(chosen(arrivals, by, selected), "hour")
    return picked.groupBy("hour", by).agg(arrival_count(picked).alias("arrivals"))


def stop_counts(
    arrivals: DataFrame,
    keys: Sequence[str],
    name: str,
    hour: int,
    by: str = "route_id",
    selected: Sequence[str] | None = None,
) -> DataFrame:
    """Arrivals of one hour per ``keys``, counted into ``name``."""
    picked = present(chosen(at_hour(arrivals, hour), by, selected), *keys)
    return picked.groupBy(*keys).agg(arrival_count(picked).alias(name))
