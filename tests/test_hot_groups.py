"""A third of all arrivals share one stop, route, hour and trip: results stay whole."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows_of

from stopwise.operators import joins
from stopwise.operators.activity import tally
from stopwise.operators.ranking import exact_sample
from stopwise.plans.dashboards import borough_dashboard, route_dashboard
from stopwise.sinks.tables import write_table

COLUMNS = ["trip_id", "stop_id", "route_id", "direction_id", "route_color", "borough", "hour"]
HOT = ("T0", "S0", "R0", 0, "#000000", "North", 8)


@pytest.fixture(scope="module")
def arrivals():
    rng = random.Random(5)
    rows = [HOT] * 3000
    for _ in range(6000):
        route = rng.randrange(6)
        rows.append(
            (
                f"T{rng.randrange(400)}",
                f"S{rng.randrange(60)}",
                f"R{route}",
                rng.randrange(2),
                f"#{route:06d}",
                rng.choice(["North", "South"]),
                rng.randrange(24),
            )
        )
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark, arrivals):
    ddl = ", ".join(f"{c} {'int' if c in ('direction_id', 'hour') else 'string'}" for c in COLUMNS)
    return spark.createDataFrame(arrivals, ddl).repartition(8)


@pytest.fixture(autouse=True)
def small_partitions(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")


def column(row, name):
    return row[COLUMNS.index(name)]


def test_trip_join(spark, frame, arrivals):
    trips = spark.createDataFrame([(f"T{n}", f"shape{n}") for n in range(0, 400, 2)],
                                  "trip_id string, shape_id string")
    known = {f"T{n}": f"shape{n}" for n in range(0, 400, 2)}
    left = joins.attach_trips(frame.select("trip_id", "stop_id"), trips, "left")
    expected = [(row[0], row[1], known.get(row[0])) for row in arrivals]
    assert rows_of(left) == sorted(expected, key=repr)
    inner = joins.attach_trips(frame.select("trip_id", "stop_id"), trips, "inner")
    assert rows_of(inner) == sorted((row for row in expected if row[2]), key=repr)


def test_reports_count_every_arrival(spark, frame, arrivals):
    stops = spark.createDataFrame(
        [(f"S{n}", f"Stop {n}", 1.0, 2.0) for n in range(60)],
        "stop_id string, stop_name string, stop_lat double, stop_lon double",
    )
    for dashboard, by in [
        (route_dashboard(stops, frame), "route_id"),
        (borough_dashboard(stops, frame), "borough"),
    ]:
        totals = Counter(column(row, by) for row in arrivals)
        assert {row[by]: row.total_arrivals for row in dashboard.summary().collect()} == totals
        hours = Counter((column(row, "hour"), column(row, by)) for row in arrivals)
        assert {(r.hour, r[by]): r.arrivals for r in dashboard.trend().collect()} == hours
        assert sum(row.stop_count for row in dashboard.density(8).collect()) == sum(
            column(row, "hour") == 8 for row in arrivals
        )
        assert dashboard.top_stops(8).first().stop_id == "S0"
        at = Counter(column(row, "hour") for row in arrivals)
        assert {r.hour: r.curr_arrivals for r in dashboard.kpi_day().collect()} == at


def test_stored_digest_is_whole(frame, tmp_path):
    keys = ["hour", "stop_id", "route_id"]
    stored = write_table(tally(frame, *keys), str(tmp_path / "digest"), partition_cols=["hour"])
    assert rows_of(stored) == rows_of(tally(frame, *keys))
    assert stored.agg({"n_rows": "sum"}).first()[0] == 9000


@pytest.mark.parametrize("prefilter", [False, True])
def test_sample_size_holds_among_copies(frame, prefilter):
    sampled = exact_sample(frame, 500, ["trip_id", "stop_id"], prefilter=prefilter)
    assert sampled.count() == 500
