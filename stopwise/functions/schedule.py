"""Hours of the schedule day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS_PER_DAY = 24

# Fixed value: the hour a report shows unless told otherwise.
DEFAULT_HOUR = 8


def hour_of(arrival_time: Column, wrap: bool = False, lenient: bool = False) -> Column:
    """Hour of an ``HH:MM:SS`` text.

    Service after midnight counts on as 24, 25, ...; ``wrap`` folds it into 0-23. Text that
    is no number raises (ANSI cast); ``lenient`` gives NULL for it.
    """
    digits = F.substring(arrival_time, 1, 2)
    hour = digits.try_cast("int") if lenient else digits.cast("int")
    return F.pmod(hour, F.lit(HOURS_PER_DAY)) if wrap else hour


def hour_label(hour: Column) -> Column:
    """``08:00 - 09:00`` for 8; the last hour of the day ends at ``24:00``."""

    def clock(value: Column) -> Column:
        return F.concat(F.lpad(value.cast("string"), 2, "0"), F.lit(":00"))

    return F.concat(clock(hour), F.lit(" - "), clock(hour + 1))


def hour_before(hour: int) -> int:
    return (hour - 1) % HOURS_PER_DAY


def hour_after(hour: Column) -> Column:
    return F.pmod(hour + 1, F.lit(HOURS_PER_DAY)).cast("int")
