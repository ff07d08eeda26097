"""Temporary views and bounded previews."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: rows a preview may bring to the driver.
PREVIEW_ROWS = 1000


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``rows`` rows in any order; the caller decides whether to collect them."""
    return df.limit(rows)


def show_full(df: DataFrame) -> None:
    """Print the first rows without cutting long values."""
    df.show(truncate=False)
