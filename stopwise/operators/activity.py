"""Counting arrivals, singly or from a tally of them.

The metrics take single arrivals and aggregate them in one go: Spark combines on the map
side and shuffles distinct keys, so a hot route or stop is a few rows by the time it moves.
A ``tally`` holds the same arrivals counted per key. Stored once, it answers every report
from far fewer rows; made before a join, it collapses hot keys before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "n_rows"
TRIPS = "n_trips"


# Marks the counts of a tally in the schema, where joins, selections and stored tables keep it.
# A column that only has the name of one is a column like any other.
TALLY = "stopwise.tally"


def _counted(df: DataFrame, name: str) -> bool:
    return any(f.name == name and f.metadata.get(TALLY) for f in df.schema.fields)


def arrival_count(df: DataFrame) -> Column:
    """Number of arrivals, whether ``df`` has one row for each or is a tally."""
    return F.sum(ROWS) if _counted(df, ROWS) else F.count(F.lit(1))


def trip_count(df: DataFrame) -> Column:
    """Number of arrivals that have a trip id."""
    return F.sum(TRIPS) if _counted(df, TRIPS) else F.count("trip_id")


def arrivals_of(df: DataFrame) -> Column:
    """How many arrivals a row stands for."""
    return F.col(ROWS) if _counted(df, ROWS) else F.lit(1).cast("long")


def trips_of(df: DataFrame) -> Column:
    """How many arrivals with a trip id a row stands for."""
    return F.col(TRIPS) if _counted(df, TRIPS) else F.col("trip_id").isNotNull().cast("long")


def tally(df: DataFrame, *keys: str) -> DataFrame:
    """Per key: ``n_rows`` arrivals, ``n_trips`` of them with a trip id."""
    marked = {TALLY: True}
    return df.groupBy(*keys).agg(
        arrival_count(df).alias(ROWS, metadata=marked),
        trip_count(df).alias(TRIPS, metadata=marked),
    )


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with no NULL in ``columns``; a group key that is NULL forms no group."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def chosen(df: DataFrame, column: str, selected: Sequence | None) -> DataFrame:
    """Rows whose ``column`` is selected. None selects every value, an empty list none."""
    if selected is None:
        return present(df, column)
    return df.filter(F.col(column).isin(list(selected)))


def at_hour(df: DataFrame, *hours: int) -> DataFrame:
    return df.filter(F.col("hour").isin(list(hours)))


def total(condition: Column, value: Column) -> Column:
    """Sum of ``value`` where ``condition`` holds; 0 if nowhere."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))
