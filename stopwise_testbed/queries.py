"""One query per operator. Each takes (spark, sf_dir) and reads the whole tables it names."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise_testbed import roles
from stopwise_testbed.roles import read
from stopwise.functions.schedule import hour_of
from stopwise.functions.text import hex_colour
from stopwise.operators import expectations, joins, kpis, selection, summaries
from stopwise.operators.expectations import ExpectationFailed
from stopwise.operators.ranking import exact_sample
from stopwise.plans.checked import write_checked
from stopwise.plans.dashboards import borough_dashboard, route_dashboard
from stopwise.plans.decorators import (
    expect_all,
    expect_all_or_fail,
    expect_or_drop,
    expect_or_fail,
    table,
    temporary_view,
)
from stopwise.plans.medallion import Medallion, land_raw
from stopwise.scratch import scratch_dir
from stopwise.sinks.tables import replace_partitions, write_batch, write_table
from stopwise.sinks.views import preview
from stopwise.sources.delimited import read_delimited
from stopwise.sources.feeds import load_feed, load_feeds
from stopwise.sources.json_tree import read_json_tree, read_json_variants, with_fields
from stopwise.sources.tables import read_table, read_view
from stopwise.streaming.medallion import start_bronze, start_unique, stream_json_tree

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

ROUTE_CHOICE = ["click", "view"]
BOROUGH_CHOICE = ["ASIA", "EUROPE"]
HOUR = 8


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore avoids an import's name."""
    REGISTRY[function.__name__.rstrip("_")] = function
    return function


# ---------------------------------------------------------------- bronze and silver


def _raw_events(spark: SparkSession, sf: str) -> str:
    """The events as a tree of JSON files two folders deep, with the flag silver asks for."""
    path = scratch_dir(spark, "raw")
    flagged = read(spark, sf, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.struct(F.col("props").alias("text")).alias("detail"),
        (F.col("event_type") != "error").alias("is_assigned"),
        F.col("event_type").alias("kind"),
        F.substring(F.col("ts").cast("string"), 1, 7).alias("month"),
    )
    flagged.write.partitionBy("month", "kind").json(path)
    return path


def _raw_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("detail", T.StructType([T.StructField("text", T.StringType())])),
            T.StructField("is_assigned", T.BooleanType()),
        ]
    )


@query
def bronze_silver(spark, sf):
    raw, bronze = _raw_events(spark, sf), scratch_dir(spark, "bronze")
    flow = Medallion(spark, raw, bronze, raw_schema=_raw_schema())
    flow.run()
    return spark.sql(
        f"SELECT event_type, count(*) AS n FROM {flow.silver_view_name} "
        "WHERE ingest_ts IS NOT NULL AND silver_ingest_ts IS NOT NULL GROUP BY event_type"
    )


@query
def bronze_silver_stream(spark, sf):
    raw, bronze = _raw_events(spark, sf), scratch_dir(spark, "bronze")
    start_bronze(
        spark, raw, _raw_schema(), bronze, scratch_dir(spark, "progress")
    ).awaitTermination()
    kept = expectations.drop_failing(spark.read.parquet(bronze), "is_assigned = True")
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_beside_batch(spark, sf):
    """Half of the events appended, the others streamed, both into one bronze table."""
    raw, bronze = _raw_events(spark, sf), scratch_dir(spark, "bronze")
    by_hand = read_json_tree(spark, raw, _raw_schema()).where("event_id % 2 = 0")
    write_table(by_hand, bronze, mode="append")
    halves = scratch_dir(spark, "raw")
    read_json_tree(spark, raw, _raw_schema()).where("event_id % 2 = 1").write.json(halves)
    start_bronze(
        spark, halves, _raw_schema(), bronze, scratch_dir(spark, "progress")
    ).awaitTermination()
    return read_table(spark, bronze).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def json_ingest(spark, sf):
    tree = read_json_tree(spark, _raw_events(spark, sf))
    return tree.select(
        "event_id", "user_id", "event_type", "value", F.col("detail.text").alias("props")
    )


# ---------------------------------------------------------------- table writes and reads


@query
def table_roundtrip(spark, sf):
    path = scratch_dir(spark, "orders")

    @table("orders", path=path)
    def orders():
        return read(spark, sf, "orders")

    orders()
    return read_table(spark, path)


@query
def append_write(spark, sf):
    orders, path = read(spark, sf, "orders"), scratch_dir(spark, "orders")
    write_table(orders, path)
    return write_table(orders, path, mode="append")


@query
def quality_history(spark, sf):
    """What three kinds of expectations counted in two writes, the second of them refused."""
    path, history = scratch_dir(spark, "checked"), scratch_dir(spark, "history")
    rules = {
        "drop": {"shipped": "l_linestatus = 'F'", "some": "l_quantity > 1"},
        "flag": {"cheap": "l_extendedprice < 50000", "known": "nullif(l_returnflag, 'A') <> 'N'"},
    }
    lines = read(spark, sf, "lineitem")
    write_checked(lines, path, history, run="first", fail={"taxed": "l_tax >= 0"}, **rules)
    try:
        write_checked(lines, path, history, run="second", fail={"taxed": "l_tax > 0"}, **rules)
    except ExpectationFailed:
        pass
    return read_table(spark, history).select("run", "rule", "kind", "rows", "passed", "failed", "unknown")


@query
def drifting_json(spark, sf):
    """Events landed as VARIANT in two batches, of which the later has a field the first lacks."""
    bronze, raw = scratch_dir(spark, "bronze"), scratch_dir(spark, "raw")
    events = read(spark, sf, "events")
    first = events.where("event_id % 2 = 0").select("event_id", "value")
    later = events.where("event_id % 2 = 1").select(
        "event_id", F.struct(F.col("props").alias("text"), "user_id").alias("detail"), "event_type"
    )
    for name, rows in (("a", first), ("b", later)):
        rows.write.json(f"{raw}/{name}")
        write_table(read_json_variants(spark, f"{raw}/{name}"), bronze, mode="append")
    fields = {"event_id": "long", "value": "double", "event_type": "string",
              "detail.text": "string", "detail.user_id": "long"}
    return with_fields(read_table(spark, bronze), fields, strict=True)


@query
def stream_unique(spark, sf):
    """The raw files of the events delivered twice, under other names, and each event kept once."""
    raw, silver = scratch_dir(spark, "raw"), scratch_dir(spark, "silver")
    events = read(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp"))
    for copy in ("a", "b"):
        events.write.json(f"{raw}/{copy}")
    schema = T.StructType.fromDDL("event_id long, event_type string, ts timestamp")
    start_unique(
        spark, stream_json_tree(spark, raw, schema), silver, scratch_dir(spark, "progress"),
        ["event_id"], "ts", "3650 days",
    ).awaitTermination()
    return read_table(spark, silver).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def side_by_side_append(spark, sf):
    """Four writers that append to a table at once; whichever is first makes it."""
    path, orders = scratch_dir(spark, "orders"), read(spark, sf, "orders")

    def add(part):
        write_table(orders.where(f"o_orderkey % 4 = {part}"), path, mode="append")

    with ThreadPoolExecutor(4) as writers:
        list(writers.map(add, range(4)))
    return read_table(spark, path)


@query
def batch_once(spark, sf):
    """Batches of a stream, one of them attempted twice, between appends to the same table."""
    path, orders = scratch_dir(spark, "orders"), read(spark, sf, "orders")
    write_table(orders.where("o_orderkey % 3 = 0"), path, mode="append")
    for number in (1, 2, 2, 1):
        write_batch(orders.where(f"o_orderkey % 3 = {number}"), path, "orders", number)
    return read_table(spark, path)


@query
def partition_replace(spark, sf):
    """Two of the three partitions of a table doubled in place."""
    path = scratch_dir(spark, "orders")
    stored = write_table(read(spark, sf, "orders"), path, partition_cols=["o_orderstatus"])
    changed = stored.where("o_orderstatus <> 'F'")
    return replace_partitions(changed.withColumn("o_totalprice", F.col("o_totalprice") * 2), path)


@query
def partitioned_write(spark, sf):
    path = scratch_dir(spark, "orders")
    return write_table(read(spark, sf, "orders"), path, partition_cols=["o_orderstatus"])


@query
def schema_replace_write(spark, sf):
    path = scratch_dir(spark, "orders")
    orders = read(spark, sf, "orders")
    write_table(orders, path)
    changed = orders.select("o_orderkey", F.col("o_totalprice").alias("price"))
    write_table(changed, path, replace_schema=True)
    return read_table(spark, path)


@query
def raw_landing(spark, sf):
    """First-generation bronze: the stored table behind the preview that is returned."""
    bronze = scratch_dir(spark, "bronze")
    land_raw(spark, _raw_events(spark, sf), bronze)
    return read_table(spark, bronze).select("event_id", "user_id", "event_type", "is_assigned")


def _two_shapes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = read(spark, sf, "orders")
    first = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    return first, orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority")


@query
def schema_evolution_append(spark, sf):
    path = scratch_dir(spark, "orders")
    first, second = _two_shapes(spark, sf)
    write_table(first, path)
    write_table(second, path, mode="append")
    return read_table(spark, path)


@query
def schema_evolution_overwrite(spark, sf):
    path = scratch_dir(spark, "orders")
    first, second = _two_shapes(spark, sf)
    write_table(first, path)
    write_table(second, path, mode="overwrite")
    return read_table(spark, path)


@query
def self_overwrite(spark, sf):
    """A table replaced by a query over itself."""
    path = scratch_dir(spark, "orders")
    stored = write_table(read(spark, sf, "orders"), path)
    return write_table(stored.withColumn("o_totalprice", F.col("o_totalprice") * 2), path)


@query
def temp_view_sql(spark, sf):
    @temporary_view()
    def stopwise_orders():
        return read(spark, sf, "orders")

    stopwise_orders()
    by_name = read_view(spark, "stopwise_orders").filter("o_orderstatus = 'F'")
    by_sql = spark.sql("SELECT * FROM stopwise_orders WHERE o_orderstatus <> 'F'")
    return by_name.unionByName(by_sql)


@query
def preview_limit(spark, sf):
    return preview(read(spark, sf, "orders").select("o_orderkey").orderBy("o_orderkey"))


@query
def csv_scan(spark, sf):
    return read_delimited(
        spark,
        _write_csv(read(spark, sf, "orders")),
        T.StructType(
            [
                T.StructField("o_orderkey", T.LongType()),
                T.StructField("o_orderstatus", T.StringType()),
                T.StructField("o_totalprice", T.DoubleType()),
            ]
        ),
    )


# ---------------------------------------------------------------- expectations


@query
def expect_or_drop_(spark, sf):
    @expect_or_drop("finished", "nullif(o_orderstatus, 'P') = 'F'")
    def orders():
        return read(spark, sf, "orders")

    return orders()


@query
def expect_all_(spark, sf):
    @expect_all({"price": "o_totalprice BETWEEN 1000 AND 400000", "status": "o_orderstatus <> 'P'"})
    def orders():
        return read(spark, sf, "orders")

    return orders().select("o_orderkey", "is_quarantined")


@query
def expect_all_null(spark, sf):
    rules = {"status": "nullif(o_orderstatus, 'P') <> 'F'", "price": "o_totalprice > 100000"}

    @expect_all(rules)
    def orders():
        return read(spark, sf, "orders")

    return orders().select("o_orderkey", "is_quarantined")


@query
def expect_all_strict(spark, sf):
    rules = {"status": "nullif(o_orderstatus, 'P') <> 'F'", "price": "o_totalprice > 100000"}

    @expect_all(rules, null_is_failure=True)
    def orders():
        return read(spark, sf, "orders")

    return orders().select("o_orderkey", "is_quarantined")


@query
def expect_or_fail_count(spark, sf):
    return expectations.violations(read(spark, sf, "lineitem"), "l_quantity > 10")


@query
def expect_or_fail_pass(spark, sf):
    @expect_or_fail("positive quantity", "l_quantity > 0")
    def lineitem():
        return read(spark, sf, "lineitem")

    return lineitem()


@query
def expect_or_fail_many(spark, sf):
    rules = {"quantity": "l_quantity > 0", "price": "l_extendedprice >= 0", "tax": "l_tax < 1"}

    @expect_all_or_fail(rules)
    def lineitem():
        return read(spark, sf, "lineitem")

    return lineitem()


@query
def checked_write(spark, sf):
    @table("checked", path=scratch_dir(spark, "checked"), checks={"price": "o_totalprice > 0"})
    def orders():
        return read(spark, sf, "orders")

    return orders()


@query
def expectation_report(spark, sf):
    rules = {"finished": "nullif(o_orderstatus, 'P') = 'F'", "price": "o_totalprice > 100000"}
    return expectations.expectation_report(read(spark, sf, "orders"), rules)


@query
def decorator_order(spark, sf):
    condition = "o_orderstatus = 'F'"

    @temporary_view("stopwise_view_last")
    @expect_or_drop("finished", condition)
    def filtered():
        return read(spark, sf, "orders")

    @expect_or_drop("finished", condition)
    @temporary_view("stopwise_view_first")
    def unfiltered():
        return read(spark, sf, "orders")

    filtered()
    unfiltered()
    counted = [
        spark.table(view).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("view", F.lit(label))
        for view, label in [
            ("stopwise_view_last", "view outermost"),
            ("stopwise_view_first", "view innermost"),
        ]
    ]
    return joins.union_by_name(counted)


# ---------------------------------------------------------------- scalar columns


@query
def arrival_hour(spark, sf):
    hour = hour_of(F.col("arrival_time")).alias("hour")
    return roles.arrivals(spark, sf).select("trip_id", hour)


@query
def route_color(spark, sf):
    padded = F.concat(F.lit(" "), "c_mktsegment", F.lit("\t "))
    customers = read(spark, sf, "customer").select("c_custkey", padded.alias("route_color"))
    return customers.withColumn("route_color", hex_colour(F.col("route_color")))


@query
def hour_labels(spark, sf):
    """The 24 labels with the arrivals of their hour."""
    trend = roles.arrivals(spark, sf).groupBy("hour").agg(F.count(F.lit(1)).alias("arrivals"))
    labels = selection.hour_labels(spark)
    return labels.join(trend, "hour", "left").fillna(0, ["arrivals"])


# ---------------------------------------------------------------- joins and unions


@query
def trip_left_join(spark, sf):
    stop_times = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    trips = roles.draft_trips(spark, sf).withColumnRenamed("o_orderkey", "l_orderkey")
    return joins.attach_trips(stop_times, trips, "left", on=["l_orderkey"])


@query
def trip_inner_join(spark, sf):
    stop_times = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    trips = roles.draft_trips(spark, sf).withColumnRenamed("o_orderkey", "l_orderkey")
    return joins.attach_trips(stop_times, trips, "inner", on=["l_orderkey"])


@query
def route_color_join(spark, sf):
    routes = (
        read(spark, sf, "nation")
        .filter("n_regionkey <> 0")
        .select(F.col("n_nationkey").alias("route_id"), F.col("n_name").alias("route_color"))
    )
    trips = read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("route_id"))
    return joins.attach_routes(trips, routes)


@query
def fanout_join(spark, sf):
    """Counts per stop and borough against two stop lists, on the stop id alone."""
    listed = joins.union_by_name([roles.stops(spark, sf), roles.depots(spark, sf)])
    counts = roles.borough_tally(spark, sf, "stop_id").select(
        "stop_id", "borough", F.col("n_rows").alias("arrivals")
    )
    return joins.attach_stops(counts, listed, ["stop_name"], "inner")


@query
def fanout_join_tagged(spark, sf):
    """The same, matched within the borough."""
    listed = joins.union_by_name([roles.stops(spark, sf), roles.depots(spark, sf)])
    counts = roles.borough_tally(spark, sf, "stop_id").select(
        "stop_id", "borough", F.col("n_rows").alias("arrivals")
    )
    return joins.attach_stops(counts, listed, ["stop_name"], "inner", on=["stop_id", "borough"])


def _write_csv(df: DataFrame, *partition_cols: str) -> str:
    path = scratch_dir(df.sparkSession, "csv")
    df.write.option("header", "true").partitionBy(*partition_cols).csv(path)
    return path


def _feed_trips(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        F.col("event_id").alias("trip_id"),
        F.regexp_extract("props", "[0-9]+", 0).alias("route_id"),
        "value",
    )


@query
def subway_arrivals(spark, sf):
    """One feed from CSV: sign-ups have no trip, errors have a trip but no known route."""
    arrivals = roles.arrivals(spark, sf)
    trips = arrivals.filter("route_id <> 'signup'").select(
        "trip_id",
        "route_id",
        "direction_id",
        F.concat(F.lit("S-"), "route_id").alias("shape_id"),
    )
    routes = (
        arrivals.select("route_id")
        .filter("route_id <> 'error'")
        .distinct()
        .select(
            "route_id",
            F.concat(F.upper(F.substring("route_id", 1, 6)), F.lit(" ")).alias("route_color"),
            F.upper("route_id").alias("route_short_name"),
        )
    )
    stops = roles.stops(spark, sf).withColumn("parent_station", F.lit(None).cast("string"))
    feed = {
        "stop_times": _write_csv(arrivals.select("trip_id", "stop_id", "arrival_time")),
        "trips": _write_csv(trips),
        "routes": _write_csv(routes),
        "stops": _write_csv(stops.drop("borough")),
    }
    return load_feed(spark, feed).arrivals


def _borough_feeds(spark: SparkSession, sf: str):
    """A feed per region; trips with a value below 1 are missing, and so is one whole feed."""
    stops = roles.stops(spark, sf)
    placed = joins.attach_stops(roles.arrivals(spark, sf), stops, ["borough"], "inner")
    trips = _feed_trips(spark, sf).filter("value >= 1")
    tagged = joins.attach_trips(placed.select("trip_id", "borough"), trips, "inner")
    tables = {
        "stop_times": _write_csv(
            placed.select("trip_id", "stop_id", "arrival_time", "borough"), "borough"
        ),
        "trips": _write_csv(tagged.select("trip_id", "route_id", "borough"), "borough"),
        "stops": _write_csv(stops, "borough"),
    }
    return load_feeds(
        spark,
        {
            name: {kind: f"{path}/borough={name}" for kind, path in tables.items()}
            for name in [*roles.BOROUGHS, "NOWHERE"]
        },
    )


@query
def feed_union(spark, sf):
    return _borough_feeds(spark, sf).arrivals


@query
def feed_union_stops(spark, sf):
    return _borough_feeds(spark, sf).stops


# ---------------------------------------------------------------- schedule reports


@query
def route_summary(spark, sf):
    return summaries.route_summary(roles.arrivals(spark, sf), ROUTE_CHOICE)


@query
def borough_summary(spark, sf):
    return summaries.borough_summary(
        roles.borough_tally(spark, sf, "stop_id", "route_id"), BOROUGH_CHOICE
    )


@query
def hourly_trend(spark, sf):
    return summaries.hourly_trend(roles.arrivals(spark, sf))


@query
def hourly_trend_borough(spark, sf):
    return summaries.hourly_trend(roles.borough_tally(spark, sf, "hour", "stop_id"), "borough")


@query
def empty_selection(spark, sf):
    return summaries.route_summary(roles.arrivals(spark, sf), [])


def _coloured_tally(spark, sf):
    return roles.coloured_tally(spark, sf, "hour", "stop_id", "route_id")


def _borough_tally(spark, sf):
    return roles.borough_tally(spark, sf, "hour", "stop_id", "route_id")


def _routes(spark, sf):
    return route_dashboard(roles.stops(spark, sf), _coloured_tally(spark, sf))


def _boroughs(spark, sf):
    return borough_dashboard(roles.stops(spark, sf), _borough_tally(spark, sf))


@query
def stop_density(spark, sf):
    """Named from the short stop list, so many stops have no name."""
    dashboard = route_dashboard(roles.depots(spark, sf), _coloured_tally(spark, sf))
    return dashboard.density(HOUR)


@query
def stop_density_borough(spark, sf):
    """Named from the short stop list, so stops without a name vanish."""
    dashboard = borough_dashboard(roles.depots(spark, sf), _borough_tally(spark, sf))
    return dashboard.density(HOUR, BOROUGH_CHOICE)


@query
def city_map(spark, sf):
    return _routes(spark, sf).city_map(HOUR, rows=100)


@query
def city_map_borough(spark, sf):
    return _boroughs(spark, sf).city_map(HOUR, rows=100)


@query
def top_stops(spark, sf):
    dashboard = route_dashboard(roles.depots(spark, sf), roles.arrivals(spark, sf))
    return dashboard.top_stops(HOUR)


@query
def top_stops_borough(spark, sf):
    listed = joins.union_by_name([roles.stops(spark, sf), roles.depots(spark, sf)])
    return borough_dashboard(listed, _borough_tally(spark, sf)).top_stops(HOUR)


@query
def map_sample(spark, sf):
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return exact_sample(lines, keys=["l_orderkey", "l_linenumber", "l_partkey"], prefilter=True)


@query
def hour_kpi(spark, sf):
    return kpis.hour_kpi(roles.arrivals(spark, sf), HOUR)


@query
def hour_kpi_wrap(spark, sf):
    return kpis.hour_kpi(roles.arrivals(spark, sf), 0, selected=ROUTE_CHOICE)


@query
def hour_kpi_borough(spark, sf):
    return _boroughs(spark, sf).kpi(HOUR, BOROUGH_CHOICE)


@query
def hour_kpi_all(spark, sf):
    return kpis.hour_kpi_all(roles.arrivals(spark, sf))


@query
def kpi_table(spark, sf):
    return kpis.kpi_table(kpis.hour_kpi(roles.arrivals(spark, sf), HOUR))


@query
def distinct_routes(spark, sf):
    return selection.distinct_values(roles.arrivals(spark, sf), "route_id")


@query
def selection_status(spark, sf):
    return selection.full_selection_status(
        roles.arrivals(spark, sf), "route_id", "subway routes"
    )


def _tags(spark, sf):
    """Regions in the order of their keys, as the tags of so many feeds."""
    rows = read(spark, sf, "region").orderBy("r_regionkey").select("r_name").collect()
    return tuple(row.r_name for row in rows)


def _tagged(spark, sf):
    dashboard = _boroughs(spark, sf)
    return borough_dashboard(dashboard.stops, dashboard.arrivals, _tags(spark, sf))


@query
def borough_domain(spark, sf):
    return _tagged(spark, sf).domain()


@query
def borough_status(spark, sf):
    return _tagged(spark, sf).status()


@query
def chosen_status(spark, sf):
    """A selection in its own order: the nations with the most customers, largest first."""
    counts = read(spark, sf, "customer").groupBy("c_nationkey").count()
    chosen = counts.orderBy(F.desc("count"), "c_nationkey").limit(3).collect()
    return _routes(spark, sf).status([str(row.c_nationkey) for row in chosen])


@query
def foreign_append(spark, sf):
    """Rows added to a plain folder that lies below a ``name=value`` folder of other origin."""
    path = f"{scratch_dir(spark, 'foreign')}/o_shippriority=5/orders"
    orders = read(spark, sf, "orders")
    orders.where("o_orderkey % 2 = 0").write.parquet(path)
    return write_table(orders.where("o_orderkey % 2 = 1"), path, mode="append")


def _stored_dashboard(spark, sf):
    counted = roles.coloured_tally(spark, sf, "hour", "stop_id", "route_id", "direction_id")
    dashboard = route_dashboard(roles.stops(spark, sf), counted)
    return dashboard.stored(scratch_dir(spark, "digest"))


@query
def stored_digest(spark, sf):
    """The memoised load: arrivals counted once to the keys of every report."""
    return _stored_dashboard(spark, sf).arrivals


@query
def stored_route_summary(spark, sf):
    return _stored_dashboard(spark, sf).summary(ROUTE_CHOICE)


@query
def stored_kpi_day(spark, sf):
    return _stored_dashboard(spark, sf).kpi_day()


def _parts_of_arrivals(spark, sf, parts):
    """Dashboards over the arrivals of every so many events, as batches would bring them."""
    arrivals, stops = roles.arrivals(spark, sf), roles.stops(spark, sf)
    colours = roles.routes(spark, sf)
    return [
        route_dashboard(stops, joins.attach_routes(arrivals.where(f"trip_id % {parts} = {k}"), colours))
        for k in range(parts)
    ]


@query
def merged_digest(spark, sf):
    """The digest from three batches, one of them merged twice."""
    path = scratch_dir(spark, "digest")
    first, second, third = _parts_of_arrivals(spark, sf, 3)
    first.stored(path)
    for number, batch in ((1, second), (2, third), (2, third)):
        dashboard = batch.merged_into(path, once=("arrivals", number))
    return dashboard.arrivals


def _index(spark, sf):
    first, second = _parts_of_arrivals(spark, sf, 2)
    index = first.indexed(scratch_dir(spark, "index"))
    index.merge(second, once=("arrivals", 1))
    return index


@query
def indexed_kpi_day(spark, sf):
    """Hour over hour for all hours from stored bitmaps, built of one batch and merged with another."""
    return _index(spark, sf).kpi_day()


@query
def indexed_kpi(spark, sf):
    return _index(spark, sf).kpi(HOUR)


@query
def indexed_route_summary(spark, sf):
    return _index(spark, sf).summary(ROUTE_CHOICE)
