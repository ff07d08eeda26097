"""Display texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters cut from both ends of a colour.
BLANKS = " \t\n\r\x0b\x0c"


def hex_colour(colour: Column) -> Column:
    """``#RRGGBB`` from the bare digits; NULL stays NULL."""
    return F.concat(F.lit("#"), F.trim(colour, F.lit(BLANKS)))


def signed_percent(rate: Column) -> Column:
    """``+12%``: whole percent, ties to even, the sign taken from the unrounded rate."""
    sign = F.when(rate < 0, "-").otherwise("+")
    size = F.abs(F.bround(rate * 100))
    return F.concat(sign, F.format_string("%.0f%%", size))


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)
