"""What a report can be narrowed to, and how a selection is described."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.functions.schedule import HOURS_PER_DAY, hour_label
from stopwise.operators.activity import present

# Text for an empty selection, and the caption.
NOTHING_SELECTED = "None"
CAPTION = "Analyzing %d {noun}"


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of ``column`` in order, without NULL."""
    return present(df.select(column), column).distinct().orderBy(column)


def listed_values(spark: SparkSession, values: Sequence[str], column: str) -> DataFrame:
    """Values that are known beforehand, in the order given."""
    listed = F.array(*[F.lit(value) for value in values]).cast("array<string>")
    return spark.range(1).select(F.explode(listed).alias(column))


def hour_labels(spark: SparkSession) -> DataFrame:
    """The 24 hours of the day and their labels."""
    hour = F.col("id").cast("int")
    return spark.range(HOURS_PER_DAY).select(hour.alias("hour"), hour_label(hour).alias("label"))


def _status(values, noun: str) -> list:
    listed = F.concat_ws(", ", values)
    return [
        F.when(F.size(values) > 0, listed).otherwise(NOTHING_SELECTED).alias("value_text"),
        F.format_string(CAPTION.format(noun=noun), F.size(values)).alias("caption"),
    ]


def selection_status(spark: SparkSession, selected: Sequence[str], noun: str) -> DataFrame:
    """One row describing a selection, in the order it was made."""
    values = F.array(*[F.lit(value) for value in selected]).cast("array<string>")
    return spark.range(1).select(*_status(values, noun))


def full_selection_status(arrivals: DataFrame, column: str, noun: str) -> DataFrame:
    """One row describing the default selection: every value of ``column``.

    The values are made distinct before they meet, so the list is no longer than the text
    it becomes.
    """
    values = F.array_sort(F.collect_list(column)).alias("chosen")
    domain = present(arrivals.select(column), column).distinct().agg(values)
    return domain.select(*_status(F.col("chosen"), noun))
