"""Words, lines and scratch tables, as every operator here understands them.

A word is a run of characters other than space and U+0009 to U+000D. A null text has no words.
"""

from __future__ import annotations

import gc
import re
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.scratch import scratch_dir

# The characters that end a word, as a Java pattern and as plain text.
GAP = "[ \\t-\\r]+"
GAP_CHARACTERS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def count_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` refers to it
    and wherever the optimiser moves the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unique_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = "8m"


def small_batches_for(spark: SparkSession, most: str = ARROW_BYTES) -> None:
    """Pass texts to Python workers in batches of a few megabytes, which several of them can
    hold at a time. The setting is the session's, and stays; a smaller one is left as it is."""
    if in_bytes(str(spark.conf.get(ARROW_BATCH, "64m"))) > in_bytes(most):
        spark.conf.set(ARROW_BATCH, most)


def in_bytes(size: str) -> int:
    """A size as settings give it: a number of bytes, or of k, m, g or t, with or without a b."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps deleted now. Spark's cleaner does so once the
    driver has collected its garbage, which on its own may be after the next large shuffle. It
    works beside the driver, so it is given a moment, and a second go for what the first freed."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1.0)


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: lineage ends there, and a lost
    executor costs no more than reading it again."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
