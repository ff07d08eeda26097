"""Exact distinct counts that can be stored and merged: bitmaps over numbered values.

A distinct count cannot be added up: one per route and hour says nothing of the day. A bitmap can
be merged. Values are numbered once; a set of them is then one bit each in bitmaps of 32,768 bits,
one per bucket of numbers in use, and the union of sets is their bitwise or. A count over any
selection reads the stored bitmaps, not the rows they were made from, and needs no ``Expand``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of a table of bitmaps, besides its keys: the counted column, bucket of numbers, bits.
COUNTED, BUCKET, BITS = "counted", "bucket", "bits"
VALUE, NUMBER = "value", "number"


def numbered(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``value, number`` for the distinct non-NULL values of a one-column frame that ``known`` has
    not. Numbers are from 0, or follow the greatest of ``known``, unique, and gapless within a task.

    They are as lasting as the result: store it before it is used.
    """
    fresh = values.toDF(VALUE).filter(F.col(VALUE).isNotNull()).distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        fresh = fresh.join(known, VALUE, "left_anti")
        start = known.agg(F.coalesce(F.max(NUMBER) + 1, F.lit(0))).scalar()
    return fresh.select(VALUE, (F.monotonically_increasing_id() + start).alias(NUMBER))


def bitmaps(
    df: DataFrame,
    keys: Sequence[str],
    numbers: Mapping[str, DataFrame],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Per ``keys`` and counted column the bitmaps of its values, and ``sums`` (name -> what to
    add up), which are 0 on all rows but the first column's, so that each row counts once.

    ``numbers`` gives each counted column its ``value, number``. NULL is no value.
    """
    columns = list(numbers)
    spots = df.select(*keys, *columns, *[value.alias(name) for name, value in sums.items()])
    for i, column in enumerate(columns):
        table = numbers[column].select(F.col(VALUE).alias(f"_value{i}"), F.col(NUMBER).alias(f"_number{i}"))
        spots = spots.join(table, F.col(column) == F.col(f"_value{i}"), "left")
    # One pass over the rows: a group has one bucket of each column, 4 KB of bits for each.
    grouped = spots.groupBy(
        *keys, *[F.bitmap_bucket_number(f"_number{i}").alias(f"_bucket{i}") for i in range(len(columns))]
    ).agg(
        *[
            F.bitmap_construct_agg(F.bitmap_bit_position(f"_number{i}")).alias(f"_bits{i}")
            for i in range(len(columns))
        ],
        *[F.sum(name).alias(name) for name in sums],
    )
    parts = F.array(
        *[
            F.struct(
                F.lit(column).alias(COUNTED),
                F.coalesce(F.col(f"_bucket{i}"), F.lit(0)).alias(BUCKET),
                F.col(f"_bits{i}").alias(BITS),
                *[(F.col(n) if i == 0 else F.lit(0).cast("long")).alias(n) for n in sums],
            )
            for i, column in enumerate(columns)
        ]
    )
    return merged(grouped.select(*keys, F.inline(parts)), keys, list(sums))


def merged(maps: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Bitmaps of the same keys, column and bucket as one; fewer ``keys`` join the sets of many."""
    return maps.groupBy(*keys, COUNTED, BUCKET).agg(
        F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(name).alias(name) for name in sums]
    )


def counted(
    maps: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], sums: Sequence[str]
) -> DataFrame:
    """Per ``keys``: ``sums``, and for each name of ``distinct`` the distinct values of a column."""
    sets = merged(maps, keys, sums)
    return sets.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in sums],
        *[
            F.coalesce(
                F.sum(F.when(F.col(COUNTED) == column, F.bitmap_count(BITS))), F.lit(0)
            ).alias(name)
            for name, column in distinct.items()
        ],
    )
