"""Digests and distinct counts kept up to date batch by batch."""

from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from stopwise import storage
from stopwise.operators import bitmaps
from stopwise.plans.dashboards import borough_dashboard, route_dashboard
from stopwise.sinks.tables import batch_done

ARRIVALS = "trip_id string, stop_id string, route_id string, direction_id int, hour int, route_color string, borough string"
STOPS = "stop_id string, stop_name string, stop_lat double, stop_lon double, borough string"


def arrivals(spark, seed, n=400, hours=range(26), stops=40):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        route = draw.choice([None, *"ABCDEF"])
        rows.append(
            (
                draw.choice([None, f"t{draw.randrange(50)}"]),
                draw.choice([None, *(f"s{k}" for k in range(stops))]),
                route,
                draw.choice([None, 0, 1]),
                draw.choice([None, *hours]),
                None if route is None else f"#{route}",
                draw.choice([None, "X", "Y"]),
            )
        )
    return spark.createDataFrame(rows, ARRIVALS)


@pytest.fixture
def stops(spark):
    return spark.createDataFrame([], STOPS)


@pytest.fixture(params=[route_dashboard, borough_dashboard])
def dashboard(request, stops):
    return lambda rows: request.param(stops, rows)


def reports(board):
    return [
        rows_of(board.summary()), rows_of(board.trend()), rows_of(board.kpi_day()),
        rows_of(board.kpi(0)), rows_of(board.density(8)),
    ]


def test_three_batches_equal_a_rebuild(spark, dashboard, tmp_path):
    batches = [arrivals(spark, 1), arrivals(spark, 2, 150, [3, 8]), arrivals(spark, 3, 50, [30], 90)]
    path = str(tmp_path / "digest")
    board = dashboard(batches[0]).stored(path)
    for batch in batches[1:]:
        board = dashboard(batch).merged_into(path)
    whole = dashboard(batches[0].unionAll(batches[1]).unionAll(batches[2]))
    want = whole.digest()
    assert rows_of(board.arrivals.select(*want.columns)) == rows_of(want)
    assert reports(board) == reports(whole)


def test_only_the_hours_of_a_batch_are_written(spark, dashboard, tmp_path):
    dashboard(arrivals(spark, 1)).stored(str(tmp_path / "digest"))

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "digest").rglob("*.parquet")}

    before = files()
    dashboard(arrivals(spark, 2, 60, [8]).where("hour = 8")).merged_into(str(tmp_path / "digest"))
    kept = {p: t for p, t in before.items() if "hour=8" not in str(p)}
    assert kept and kept.items() <= files().items()
    assert not {p for p in before if "hour=8/" in str(p)} & files().keys()


def test_a_batch_merged_twice_counts_once(spark, dashboard, tmp_path):
    path, batch = str(tmp_path / "digest"), arrivals(spark, 2, 80)
    dashboard(arrivals(spark, 1)).stored(path)
    for number in (1, 1):
        board = dashboard(batch).merged_into(path, once=("feed", number))
    assert reports(board) == reports(dashboard(arrivals(spark, 1).unionAll(batch)))
    empty = dashboard(batch.where("false")).merged_into(path, once=("feed", 2))
    assert batch_done(spark, path, "feed", 2) and reports(empty) == reports(board)


@pytest.mark.parametrize("moves", [0, 1, 2, 3, 5])
def test_a_batch_that_dies_halfway_counts_once(spark, stops, tmp_path, monkeypatch, moves):
    path, rename, calls = str(tmp_path / "digest"), storage.rename, []
    batch = arrivals(spark, 2, 80, [3, 8])
    route_dashboard(stops, arrivals(spark, 1)).stored(path)

    def dies(session, source, destination):
        if len(calls) == moves:
            raise KeyboardInterrupt
        calls.append(source)
        rename(session, source, destination)

    monkeypatch.setattr(storage, "rename", dies)
    with pytest.raises(KeyboardInterrupt):
        route_dashboard(stops, batch).merged_into(path, once=("feed", 1))
    monkeypatch.setattr(storage, "rename", rename)
    board = route_dashboard(stops, batch).merged_into(path, once=("feed", 1))
    assert reports(board) == reports(route_dashboard(stops, arrivals(spark, 1).unionAll(batch)))


# ---------------------------------------------------------------- bitmaps


def test_an_index_answers_as_the_rows_do(spark, dashboard, tmp_path):
    batches = [arrivals(spark, 1), arrivals(spark, 2, 150, [3, 8]), arrivals(spark, 3, 90, [30, 0], 90)]
    index = dashboard(batches[0]).indexed(str(tmp_path / "index"))
    for number, batch in enumerate([*batches[1:], batches[2]]):
        index.merge(dashboard(batch), once=("feed", min(number, 1)))
    whole = dashboard(batches[0].unionAll(batches[1]).unionAll(batches[2]))
    some = ["A", "F"] if whole.layout.by == "route_id" else ["Y"]
    for selected in (None, some, []):
        assert rows_of(index.summary(selected)) == rows_of(whole.summary(selected))
        assert rows_of(index.kpi_day(selected)) == rows_of(whole.kpi_day(selected))
        for hour in (0, 8, 23):
            assert rows_of(index.kpi(hour, selected)) == rows_of(whole.kpi(hour, selected))


def test_an_index_of_a_digest_is_that_of_its_arrivals(spark, dashboard, tmp_path):
    rows = arrivals(spark, 5)
    stored = dashboard(rows).stored(str(tmp_path / "digest"))
    index = stored.indexed(str(tmp_path / "index"))
    assert rows_of(index.summary()) == rows_of(dashboard(rows).summary())
    assert rows_of(index.kpi_day()) == rows_of(dashboard(rows).kpi_day())


def test_reports_of_an_index_expand_no_rows(spark, dashboard, tmp_path):
    index = dashboard(arrivals(spark, 1)).indexed(str(tmp_path / "index"))
    for report in (index.summary(), index.kpi_day(), index.kpi(8)):
        assert "Expand" not in plan_of(report)
    assert "Expand" in plan_of(dashboard(arrivals(spark, 1)).kpi_day())
    assert "PartitionFilters: [hour" in plan_of(index.kpi(8))


def test_an_index_of_nothing(spark, dashboard, tmp_path):
    none = arrivals(spark, 1).where("false")
    index = dashboard(none).indexed(str(tmp_path / "index"))
    assert rows_of(index.summary()) == [] and rows_of(index.kpi(8)) == rows_of(dashboard(none).kpi(8))
    index.merge(dashboard(arrivals(spark, 2)))
    assert rows_of(index.summary()) == rows_of(dashboard(arrivals(spark, 2)).summary())


def test_numbers_are_unique_and_stay(spark, tmp_path):
    def stored(values, known=None):
        path = str(tmp_path / str(random.random()))
        bitmaps.numbered(spark.createDataFrame(values, "x string").repartition(4), known).write.parquet(path)
        return spark.read.parquet(path)

    first = stored([(f"a{k % 300}",) for k in range(2000)] + [(None,)])
    assert first.count() == first.select("number").distinct().count() == 300
    more = stored([("a1",), ("b1",), ("b2",)], first)
    both = first.unionAll(more)
    assert sorted(r["value"] for r in more.collect()) == ["b1", "b2"]
    assert both.select("number").distinct().count() == 302


@pytest.mark.parametrize("n", [1, 32_768, 32_769, 70_000])
def test_counts_over_several_buckets(spark, tmp_path, n):
    numbers = spark.range(n).select(F.col("id").cast("string").alias("value"), F.col("id").alias("number"))
    numbers.write.parquet(str(tmp_path / "n"))
    rows = spark.range(2 * n).select(
        (F.col("id") % n).cast("string").alias("x"), (F.col("id") % 3).alias("k"), F.lit(2).cast("long").alias("m")
    )
    maps = bitmaps.bitmaps(rows, ["k"], {"x": spark.read.parquet(str(tmp_path / "n"))}, {"rows": F.col("m")})
    found = bitmaps.counted(maps, ["k"], {"xs": "x"}, ["rows"])
    want = rows.groupBy("k").agg(F.sum("m").alias("rows"), F.count_distinct("x").alias("xs"))
    assert rows_of(found) == rows_of(want)
    whole = bitmaps.counted(maps, [], {"xs": "x"}, ["rows"])
    assert rows_of(whole) == [(4 * n, n)]
