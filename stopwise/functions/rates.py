"""Change between two periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def change_rate(current: Column, previous: Column) -> Column:
    """Relative change; 0 where there was nothing before."""
    return F.when(previous == 0, F.lit(0.0)).otherwise((current - previous) / previous)


def trend(rate: Column) -> Column:
    return F.when(rate >= 0, "increase").otherwise("decrease")
