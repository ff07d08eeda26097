"""Bronze and silver as streams: the same expectations, files picked up as they arrive."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stopwise import storage
from stopwise.operators.expectations import require
from stopwise.plans.decorators import expect_or_drop, temporary_view
from stopwise.plans.medallion import BRONZE_TIME, SILVER_CONDITION, SILVER_TIME, SILVER_VIEW, stamp
from stopwise.sinks.tables import write_batch


def stream_json_tree(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New files below ``path`` as a stream. Streams need the schema up front."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def start_bronze(
    spark: SparkSession,
    raw_path: str,
    schema: StructType,
    bronze_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append what has arrived to the bronze table, then stop.

    ``checkpoint`` must outlive the driver: it is how a restarted query knows which files
    are done. Run on a schedule, this loads each file exactly once. The table is one like any
    other: batches may be appended to it and columns added, before and while it is streamed to.
    """
    rows = stamp(stream_json_tree(spark, raw_path, schema, files_per_batch), BRONZE_TIME)
    return (
        rows.writeStream.foreachBatch(table_batches(bronze_path, checkpoint))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def table_batches(path: str, checkpoint: str, **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends each batch to a table once, however often it is
    attempted. Batches are told apart by number and by the id that the checkpoint keeps, so a query
    that starts over with a new checkpoint is another stream. ``options`` are ``write_table``'s.
    """

    def add(batch: DataFrame, number: int) -> None:
        write_batch(batch, path, stream_id(batch.sparkSession, checkpoint), number, **options)

    return add


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to; it outlives restarts."""
    kept = storage.read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    return json.loads(kept)["id"]


def stream_silver(
    spark: SparkSession, bronze_path: str, schema: StructType, view: str = SILVER_VIEW
) -> DataFrame:
    """The silver view over the bronze table's own stream of files."""

    @temporary_view(view)
    @expect_or_drop("assigned", SILVER_CONDITION)
    def silver():
        return stamp(spark.readStream.schema(schema).parquet(bronze_path), SILVER_TIME)

    return silver()


def start_unique(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    delay: str,
) -> StreamingQuery:
    """Append the rows of a stream to a table, those that share ``keys`` once, then stop.

    A source that delivers a file twice, under two names, repeats its rows. Keys are remembered
    until the watermark (the greatest ``time`` seen less ``delay``) has passed the time of the
    first row that had them, so the state is bounded by what arrives in ``delay``; a row that is
    later than that is dropped, and counted in ``late_rows``. Rows without a time are never late.
    """
    fresh = rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    return (
        fresh.writeStream.foreachBatch(table_batches(path, checkpoint))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query has dropped as too late, in the batches it reports on."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def checked_batches(
    name: str, condition: str, write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes a batch only if every row meets ``condition``.

    A batch that does not stops the query before anything of it is written.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(require(batch, name, condition), batch_id)
        finally:
            batch.unpersist()

    return handle


def default_checkpoint(spark: SparkSession, query: str) -> str:
    """A fixed place per query under ``spark.checkpoint.dir``, which must be set: a stream's
    progress has to outlive the driver, on a ``local`` master too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; a stream needs a lasting folder")
    return f"{root.rstrip('/')}/streams/{query}"
