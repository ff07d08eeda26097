"""What the optimiser makes of the queries: pushdown, pruning, joins, skew."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL, plan_of
from feeds import write_route_feed
from pyspark.sql import functions as F

from stopwise_testbed import roles
from stopwise_testbed.queries import REGISTRY
from stopwise.operators import joins, kpis, summaries
from stopwise.operators.activity import tally
from stopwise.operators.expectations import drop_failing, violations
from stopwise.operators.ranking import busiest, exact_sample, least_of_each_task
from stopwise.plans.dashboards import route_dashboard
from stopwise.session import sized_for
from stopwise.sinks.tables import write_table
from stopwise.sources.feeds import load_feed


def final_plan_of(df) -> str:
    """The plan AQE arrived at, once the rows are there."""
    df.collect()
    return plan_of(df)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(REGISTRY[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert node not in plan


def test_sql_predicates_reach_the_parquet_scan(spark, tmp_path):
    flagged = spark.range(10).select("id", (F.col("id") > 3).alias("is_assigned"))
    stored = write_table(flagged, str(tmp_path / "t"))
    for df in (drop_failing(stored, "is_assigned = True"), violations(stored, "id > 2")):
        pushed = re.search(r"PushedFilters: \[(.*?)\]", plan_of(df)).group(1)
        assert "is_assigned" in pushed or "id" in pushed


def test_scans_read_only_the_columns_a_report_needs(spark):
    plan = plan_of(summaries.hourly_trend(roles.arrivals(spark, SMALL)))
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<ts:timestamp_ntz,event_type:string>"]


@pytest.mark.parametrize("report", [kpis.hour_kpi_all, lambda a: kpis.hour_kpi(a, 8)])
def test_both_hours_come_from_one_scan(spark, report):
    assert plan_of(report(roles.arrivals(spark, SMALL))).count("FileScan") == 1


def test_stored_digest_is_pruned_by_hour(spark, tmp_path):
    feed = load_feed(spark, str(write_route_feed(tmp_path / "gtfs")))
    dashboard = route_dashboard(feed.stops, feed.arrivals).stored(str(tmp_path / "digest"))
    plan = plan_of(dashboard.kpi(8))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "hour" in filters and plan.count("FileScan") == 1


def test_routes_meet_trips_before_the_stop_times(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    feed = load_feed(spark, str(write_route_feed(tmp_path / "gtfs")))
    lines = plan_of(feed.arrivals).splitlines()
    joins_at = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    times_at = next(i for i in scans if "arrival_time" in lines[i])
    # The stop times pass one join only: the outer one. The other lies on the trips' side.
    # Planned as sort-merge; run-time sizes may still turn either into a hash join.
    assert len(joins_at) == 2 and joins_at[0] < times_at < joins_at[1]


def test_small_dimension_is_broadcast_without_a_hint(spark, tmp_path):
    feed = load_feed(spark, str(write_route_feed(tmp_path / "gtfs")))
    assert "BroadcastHashJoin" in plan_of(feed.arrivals)
    assert "ResolvedHint" not in feed.arrivals._jdf.queryExecution().analyzed().toString()


def test_top_k_never_sorts_everything(spark):
    counts = tally(roles.arrivals(spark, SMALL), "stop_id")
    assert "TakeOrderedAndProject" in plan_of(busiest(counts, "n_rows", ["stop_id"]))
    sampled = exact_sample(roles.arrivals(spark, SMALL), 5, ["trip_id"], prefilter=True)
    assert "TakeOrderedAndProject" in plan_of(sampled)


@pytest.fixture
def hot(spark, tmp_path, conf):
    """Stop times of which a third belong to one trip, and settings that make that skew."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    trip = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    times = spark.range(0, 300000, 1, 16).select(
        trip.alias("trip_id"), F.md5(F.col("id").cast("string")).alias("payload")
    )
    return write_table(times, str(tmp_path / "times"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("threshold, node", [("0", "SortMergeJoin"), ("64m", "ShuffledHashJoin")])
def test_a_hot_trip_is_split_over_tasks(spark, hot, conf, how, threshold, node):
    conf("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", threshold)
    trips = spark.range(4000).select(F.col("id").alias("trip_id"), F.lit("r").alias("route_id"))
    joined = joins.attach_trips(hot, trips, how)
    assert f"{node}(skew=true)" in final_plan_of(joined.select("payload", "route_id"))
    expected = 300000 if how == "left" else hot.filter("trip_id < 4000").count()
    assert joined.count() == expected


def test_a_hot_route_is_combined_before_the_shuffle(spark, hot):
    """The map side sends one row per key and task, however many arrivals the key has."""
    plan = plan_of(tally(hot, "trip_id"))
    partial = plan.index("partial_count")
    assert plan.index("Exchange hashpartitioning") < partial  # the tree prints parents first


def test_stop_names_join_the_ranking_not_the_counts(spark):
    dashboard = route_dashboard(roles.depots(spark, SMALL), roles.arrivals(spark, SMALL))
    plan = plan_of(dashboard.top_stops(8))
    assert plan.count("TakeOrderedAndProject") == 2


def test_sizes_follow_the_input():
    terabyte = 1 << 40
    small, large = sized_for(1 << 30, cores=64), sized_for(100 * terabyte, cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "64"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    assert large["spark.sql.shuffle.partitions"] == "50000"
    assert large["spark.sql.files.maxPartitionBytes"] == str(1 << 30)
    middle = sized_for(terabyte, cores=800)
    assert middle["spark.sql.shuffle.partitions"] == "4096"


@pytest.mark.parametrize("name, scans", [("city_map", 2), ("city_map_borough", 1), ("map_sample", 1)])
def test_a_sample_reads_what_it_is_drawn_from_once(spark, name, scans):
    """The events feed the counts, and in ``city_map`` the list of routes as well."""
    plan = plan_of(REGISTRY[name](spark, SMALL))
    table = "lineitem" if name == "map_sample" else "events"
    assert plan.count(f"{table}.parquet") == scans
    assert "ubquery" not in plan


def test_candidates_are_bounded_per_task(spark):
    rows = spark.range(0, 6000, 1, 6).withColumn("h", F.md5(F.col("id").cast("string")))
    kept = least_of_each_task(rows, ["h"], 10)
    assert kept.count() == 60
    least = sorted(r["h"] for r in rows.collect())[:10]
    assert sorted(r["h"] for r in kept.collect())[:10] == least
