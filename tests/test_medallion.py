"""Raw JSON to bronze to silver, in batch and as a stream."""

from __future__ import annotations

import json

import pytest
from conftest import rows_of

from stopwise.operators.expectations import ExpectationFailed
from stopwise.plans.medallion import Medallion, land_raw
from stopwise.sinks.views import PREVIEW_ROWS
from stopwise.sources.tables import read_table
from stopwise.streaming.medallion import (
    checked_batches,
    default_checkpoint,
    start_bronze,
    stream_silver,
)


def put(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(record) + "\n" for record in records))


@pytest.fixture
def raw(tmp_path):
    base = tmp_path / "raw"
    put(base, "a.json", {"trip_id": "1", "is_assigned": True, "arrival": {"time": 5}})
    put(base / "x=1", "b.json", {"trip_id": "2", "is_assigned": False}, {"trip_id": "3"})
    put(base / "x=1" / "y", "c.json", {"trip_id": "4", "is_assigned": None, "actual_track": "T"})
    put(base / "z", "d.json", {"trip_id": "5", "is_assigned": True})
    return base


def test_batch_flow(spark, raw, tmp_path):
    flow = Medallion(spark, str(raw), str(tmp_path / "bronze"))
    stored = flow.bronze()
    assert set(stored.columns) == {
        "trip_id", "is_assigned", "arrival", "actual_track", "ingest_ts"
    }
    assert stored.count() == 5 and stored.filter("ingest_ts IS NULL").count() == 0
    flow.bronze_view()
    assert spark.sql("SELECT count(*) AS n FROM bronze_view").first().n == 5
    silver = flow.silver_view()
    assert rows_of(silver.select("trip_id")) == [("1",), ("5",)]
    assert spark.table("silver_view").columns[-1] == "silver_ingest_ts"


def test_ingest_time_stays_silver_time_moves(spark, raw, tmp_path):
    Medallion(spark, str(raw), str(tmp_path / "bronze")).run()
    first, second = (spark.table("silver_view").collect() for _ in range(2))
    assert [row.ingest_ts for row in first] == [row.ingest_ts for row in second]
    assert first[0].silver_ingest_ts < second[0].silver_ingest_ts


def test_places_come_from_the_environment(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setenv("RAW_BASE_PATH", str(raw))
    monkeypatch.setenv("TABLE_BASE_PATH", str(tmp_path / "tables"))
    Medallion.configured(spark).run()
    assert read_table(spark, str(tmp_path / "tables" / "bronze")).count() == 5


def test_second_load_widens_bronze(spark, raw, tmp_path):
    flow = Medallion(spark, str(raw), str(tmp_path / "bronze"))
    flow.run()
    put(raw, "e.json", {"trip_id": "6", "is_assigned": True, "delay": 3})
    assert rows_of(flow.run().select("trip_id", "delay")) == [
        ("1", None), ("5", None), ("6", 3)
    ]


def test_declared_schema_skips_inference(spark, raw, tmp_path):
    flow = Medallion(
        spark, str(raw), str(tmp_path / "bronze"), raw_schema="trip_id string, is_assigned boolean"
    )
    assert flow.bronze().columns == ["trip_id", "is_assigned", "ingest_ts"]
    assert flow.silver_view().count() == 2


def test_landing_replaces_the_schema(spark, raw, tmp_path, capsys):
    bronze = str(tmp_path / "bronze")
    land_raw(spark, str(raw), bronze, show=True)
    assert "trip_id" in capsys.readouterr().out
    other = tmp_path / "other"
    put(other, "a.json", *[{"n": i} for i in range(PREVIEW_ROWS + 200)])
    assert land_raw(spark, str(other), bronze).count() == PREVIEW_ROWS
    assert read_table(spark, bronze).columns == ["n"]
    assert read_table(spark, bronze).count() == PREVIEW_ROWS + 200



@pytest.fixture
def raw_schema(spark):
    return spark.createDataFrame([], "trip_id string, is_assigned boolean").schema


def test_stream_loads_each_file_once(spark, raw, tmp_path, raw_schema):
    bronze, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")

    def load():
        start_bronze(spark, str(raw), raw_schema, bronze, progress, 2).awaitTermination()
        return spark.read.parquet(bronze)

    assert load().count() == 5
    assert load().count() == 5
    put(raw / "late", "f.json", {"trip_id": "7", "is_assigned": True})
    assert rows_of(load().filter("is_assigned").select("trip_id")) == [("1",), ("5",), ("7",)]


def test_silver_stream(spark, raw, tmp_path, raw_schema):
    bronze = str(tmp_path / "bronze")
    start_bronze(spark, str(raw), raw_schema, bronze, str(tmp_path / "p")).awaitTermination()
    stored = spark.read.parquet(bronze).schema
    silver = stream_silver(spark, bronze, stored, "silver_stream")
    assert silver.isStreaming and spark.table("silver_stream").isStreaming
    query = (
        silver.writeStream.format("memory").queryName("silver_out").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "m")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows_of(spark.table("silver_out").select("trip_id")) == [("1",), ("5",)]


def test_checked_batches_stop_before_writing(spark, raw, tmp_path, raw_schema):
    written = []
    rows = spark.readStream.schema(raw_schema).option("recursiveFileLookup", "true").json(str(raw))

    def run(condition, place):
        handler = checked_batches(
            "rule", condition, lambda batch, _: written.append(batch.count())
        )
        query = (
            rows.writeStream.foreachBatch(handler)
            .option("checkpointLocation", str(tmp_path / place))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    run("trip_id IS NOT NULL", "good")
    assert sum(written) == 5
    with pytest.raises(Exception, match="rows do not meet the condition"):
        run("trip_id <> '2'", "bad")
    assert sum(written) == 5


def test_checkpoint_place_is_stable(spark):
    assert default_checkpoint(spark, "bronze") == default_checkpoint(spark, "bronze")
    assert default_checkpoint(spark, "bronze").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_failure_is_a_value_error():
    assert issubclass(ExpectationFailed, ValueError)
