"""Current hour against the hour before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions.rates import change_rate, trend
from stopwise.functions.schedule import HOURS_PER_DAY, hour_after, hour_before
from stopwise.functions.text import signed_percent, thousands
from stopwise.operators.activity import arrival_count, at_hour, chosen, total

MEASURES = ("arrivals", "routes", "stops")

# Label of each figure, whether it is written with thousands separators,
# and what follows the percentage in its caption.
FIGURES = {
    "arrivals": ("Total Arrivals", True, " vs last hour"),
    "routes": ("Active Routes", False, ""),
    "stops": ("Active Stops", True, ""),
}


def hourly_activity(
    arrivals: DataFrame, by: str = "route_id", selected: Sequence[str] | None = None
) -> DataFrame:
    """Arrivals, distinct routes and distinct stops per hour of the selection."""
    picked = chosen(arrivals, by, selected)
    return picked.groupBy("hour").agg(
        arrival_count(picked).alias("arrivals"),
        F.countDistinct("route_id").alias("routes"),
        F.countDistinct("stop_id").alias("stops"),
    )


def _compare(current: Column, previous: Column, measure: str, short: str) -> list[Column]:
    now, before = total(current, F.col(measure)), total(previous, F.col(measure))
    return [
        now.alias(f"curr_{measure}"),
        before.alias(f"prev_{measure}"),
        change_rate(now, before).alias(f"{short}_rate"),
    ]


def _comparisons(current: Column, previous: Column) -> list[Column]:
    return [
        column
        for measure in MEASURES
        for column in _compare(current, previous, measure, measure.removesuffix("s"))
    ]


def hour_kpi(
    arrivals: DataFrame,
    hour: int,
    by: str = "route_id",
    selected: Sequence[str] | None = None,
) -> DataFrame:
    """One row: each measure at ``hour``, the hour before (23 before 0), and its change.

    One scan reads both hours. The counts are always there, 0 where an hour is empty.
    """
    return compared(hourly_activity(at_hour(arrivals, hour, hour_before(hour)), by, selected), hour)


def compared(hours: DataFrame, hour: int) -> DataFrame:
    """``hour_kpi`` from the figures of ``hourly_activity``, those of other hours among them."""
    return hours.agg(*_comparisons(F.col("hour") == hour, F.col("hour") == hour_before(hour)))


def hour_kpi_all(
    arrivals: DataFrame, by: str = "route_id", selected: Sequence[str] | None = None
) -> DataFrame:
    """``hour_kpi`` for each of the 24 hours, still in one pass over the arrivals.

    The hourly figures, a row per hour, count once as current for their own hour and once as
    previous for the next. Hours past 23 belong to neither.
    """
    return compared_all(hourly_activity(arrivals, by, selected))


def compared_all(hours: DataFrame) -> DataFrame:
    """``hour_kpi_all`` from the figures of ``hourly_activity``."""
    hour = F.col("hour")
    following = F.when(hour < HOURS_PER_DAY, hour_after(hour))
    roles = F.array(
        F.struct(hour.alias("slot"), F.lit(True).alias("is_current")),
        F.struct(following.alias("slot"), F.lit(False).alias("is_current")),
    )
    placed = hours.select(*MEASURES, F.inline(roles))
    day = hours.sparkSession.range(HOURS_PER_DAY).select(F.col("id").cast("int").alias("hour"))
    return (
        day.join(placed, F.col("hour") == F.col("slot"), "left")
        .groupBy("hour")
        .agg(*_comparisons(F.col("is_current"), ~F.col("is_current")))
    )


def kpi_table(kpi: DataFrame) -> DataFrame:
    """The row of ``hour_kpi`` as one line per figure, with its display texts."""
    lines = []
    for measure, (label, grouped, suffix) in FIGURES.items():
        now = F.col(f"curr_{measure}")
        rate = F.col(f"{measure.removesuffix('s')}_rate")
        lines.append(
            F.struct(
                F.lit(label).alias("metric"),
                now.alias("current_value"),
                F.col(f"prev_{measure}").alias("previous_value"),
                rate.alias("rate"),
                trend(rate).alias("direction"),
                (thousands(now) if grouped else now.cast("string")).alias("value_text"),
                F.concat(signed_percent(rate), F.lit(suffix)).alias("caption"),
            )
        )
    return kpi.select(F.inline(F.array(*lines)))
