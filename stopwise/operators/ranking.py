"""Top-k and exact-size samples. Both end in Spark's ordered take, never in a full sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of the busiest-stops report and of the map.
TOP_STOPS = 10
MAP_ROWS = 12000

# Spark's ascending ids hold the number of a row in its partition in their low 33 bits.
_NUMBER_IN_PARTITION = (1 << 33) - 1


def busiest(
    counts: DataFrame, measure: str, ties: Sequence[str], rows: int = TOP_STOPS
) -> DataFrame:
    """The ``rows`` largest by ``measure``; equal ones in the order of ``ties``."""
    order = [F.desc(measure), *[F.asc_nulls_last(name) for name in ties]]
    return counts.orderBy(*order).limit(rows)


def sample_hash(keys: Sequence[str], seed: int) -> Column:
    text = [F.col(name).cast("string") for name in keys]
    return F.md5(F.concat_ws("-", *text, F.lit(str(seed))))


def exact_sample(
    df: DataFrame,
    rows: int = MAP_ROWS,
    keys: Sequence[str] = ("stop_id", "route_id"),
    seed: int = 42,
    prefilter: bool = False,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Exactly min(rows, size) rows, uniform over ``keys`` and the same on every run.

    The sample is the rows with the smallest hash of ``keys`` and ``seed``. ``keys`` should
    tell rows apart; rows that share them are drawn together, in the order of ``ties``.

    Each task keeps ``rows`` candidates and one task merges them, which is right for an
    aggregate of a few thousand partitions at most. For more, or for single arrivals, set
    ``prefilter``: candidates are dealt out anew by their hash and thinned again before that task,
    so it sees ``rows`` for each 64 MB or so of candidates, not for each task. Either way ``df`` is
    read once.
    """
    order = ["_hash", *keys, *ties]
    hashed = df.withColumn("_hash", sample_hash(keys, seed))
    if prefilter:
        hashed = least_of_each_task(hashed, order, rows).repartition(F.col("_hash"))
        hashed = least_of_each_task(hashed, order, rows)
    return hashed.orderBy(*order).limit(rows).drop("_hash")


def least_of_each_task(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first ``rows`` of each partition in ``order``: whatever the partitions are, the first
    ``rows`` of all are among them."""
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(_NUMBER_IN_PARTITION))
    numbered = df.sortWithinPartitions(*order).withColumn("_number", number)
    return numbered.filter(F.col("_number") < rows).drop("_number")
