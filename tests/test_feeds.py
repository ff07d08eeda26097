"""Loading and joining feeds against the same work row by row; damaged files."""

from __future__ import annotations

import pytest
from conftest import plan_of, rows_of
from feeds import (
    borough_arrivals,
    listed_stops,
    route_arrivals,
    tuples,
    write_borough_feeds,
    write_route_feed,
)
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.functions.schedule import hour_label, hour_of
from stopwise.sources import gtfs
from stopwise.sources.delimited import HeaderError, read_delimited
from stopwise.sources.feeds import load_feed, load_feeds
from stopwise.sources.json_tree import read_json_tree

ARRIVALS = "trip_id stop_id arrival_time route_id direction_id shape_id route_color hour".split()


def test_route_feed_row_by_row(spark, tmp_path):
    feed = write_route_feed(tmp_path / "gtfs")
    loaded = load_feed(spark, str(feed))
    arrivals = route_arrivals(feed)
    assert loaded.arrivals.columns == ARRIVALS
    assert rows_of(loaded.arrivals) == tuples(arrivals, ARRIVALS)
    columns = ["stop_id", "stop_name", "stop_lat", "stop_lon"]
    assert rows_of(loaded.stops.select(*columns)) == tuples(listed_stops(feed), columns)
    assert rows_of(loaded.routes) == [
        ("1", "#D82233", "1"),
        ("2", "#00AEEF", "2"),
        ("SI", None, "SIR"),
    ]
    assert dict(loaded.arrivals.dtypes)["direction_id"] == "int"
    # The fixture has what it promises.
    assert any(a["route_id"] is None for a in arrivals) and any(a["hour"] > 23 for a in arrivals)
    assert any(a["route_id"] and not a["route_color"] for a in arrivals)
    assert any(a["route_id"] and a["direction_id"] is None for a in arrivals)


def test_hours_can_be_wrapped(spark, tmp_path):
    feed = str(write_route_feed(tmp_path / "gtfs"))
    wrapped = load_feed(spark, feed, wrap_hours=True).arrivals
    plain = load_feed(spark, feed).arrivals
    assert wrapped.agg(F.max("hour")).first()[0] == 23
    assert wrapped.filter("hour = 1").count() == plain.filter("hour = 25").count()


def test_ids_keep_zeros_and_na(spark, tmp_path):
    loaded = load_feed(spark, str(write_route_feed(tmp_path / "gtfs")))
    found = {row.stop_id for row in loaded.arrivals.select("stop_id").distinct().collect()}
    assert {"001", "01", "NA"} <= found


def test_feed_by_uri_per_table(spark, tmp_path):
    folder = write_route_feed(tmp_path / "gtfs")
    uris = {t: f"{folder}/{t}.txt" for t in ("stops", "stop_times", "trips", "routes")}
    by_folder = load_feed(spark, str(folder))
    assert rows_of(load_feed(spark, uris).arrivals) == rows_of(by_folder.arrivals)


def test_borough_feeds_row_by_row(spark, tmp_path):
    feeds = write_borough_feeds(tmp_path)
    loaded = load_feeds(spark, feeds)
    stops, arrivals = borough_arrivals(feeds)
    columns = ["trip_id", "stop_id", "arrival_time", "route_id", "borough", "hour"]
    assert loaded.arrivals.columns == columns
    assert rows_of(loaded.arrivals) == tuples(arrivals, columns)
    assert rows_of(loaded.stops) == tuples(stops, loaded.stops.columns)


def test_a_selected_borough_reads_only_its_stop_times(spark, tmp_path):
    loaded = load_feeds(spark, write_borough_feeds(tmp_path))
    assert plan_of(loaded.arrivals).count("FileScan csv") == 4
    plan = plan_of(loaded.arrivals.filter("borough = 'North'"))
    assert plan.count("arrival_time:string") == 1 and plan.count("FileScan csv") == 3


def test_no_feed_at_all(spark, tmp_path):
    with pytest.raises(ValueError):
        load_feeds(spark, {"North": str(tmp_path / "nowhere")})


def test_tag_name_is_free(spark, tmp_path):
    loaded = load_feeds(spark, write_borough_feeds(tmp_path), tag="network")
    assert "network" in loaded.arrivals.columns and "network" in loaded.stops.columns


def _file(tmp_path, text, name="t.txt"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


CALENDAR_DATES = T.StructType(
    [
        T.StructField("service_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("exception_type", T.IntegerType()),
    ]
)


def test_wrong_header_is_refused(spark, tmp_path):
    path = _file(
        tmp_path,
        "service_id,monday,tuesday,start_date\nA,1,1,20250101\nB,20250102,1\n",
    )
    with pytest.raises(HeaderError, match="lacks.*date"):
        read_delimited(spark, path, CALENDAR_DATES)


def test_pointer_file_is_refused(spark, tmp_path):
    path = _file(
        tmp_path, "version https://git-lfs.github.com/spec/v1\noid sha256:00\nsize 12\n"
    )
    with pytest.raises(HeaderError, match="pointer"):
        read_delimited(spark, path, gtfs.STOP_TIMES)


def test_empty_file_is_refused(spark, tmp_path):
    with pytest.raises(HeaderError, match="empty"):
        read_delimited(spark, _file(tmp_path, ""), gtfs.STOP_TIMES)


def test_one_odd_file_in_a_folder_fails_the_scan(spark, tmp_path):
    folder = tmp_path / "stop_times.txt"
    folder.mkdir()
    _file(folder, "trip_id,stop_id,arrival_time\n" + "T1,S1,08:00:00\n" * 50, "a.csv")
    _file(folder, "stop_id,trip_id,arrival_time\nS2,T2,08:00:00\n", "b.csv")
    with pytest.raises(Exception, match="header does not conform"):
        read_delimited(spark, str(folder), gtfs.STOP_TIMES).collect()


def test_quoting_blanks_and_byte_order_mark(spark, tmp_path):
    path = _file(
        tmp_path,
        '﻿stop_id,stop_name,stop_lat,stop_lon\n1,"A ""b"", c",1.5,2\n2, lead,,\n3,"",0,0\n',
    )
    assert rows_of(read_delimited(spark, path, gtfs.TAGGED_STOPS)) == [
        ("1", 'A "b", c', 1.5, 2.0),
        ("2", " lead", None, None),
        ("3", None, 0.0, 0.0),
    ]


def test_hours(spark):
    texts = [("08:00:00",), (" 8:00:00",), ("25:30:00",), (None,)]
    df = spark.createDataFrame(texts, "t string")
    hours = [row[0] for row in df.select(hour_of(F.col("t"))).collect()]
    assert hours == [8, 8, 25, None]
    wrapped = [row[0] for row in df.select(hour_of(F.col("t"), wrap=True)).collect()]
    assert wrapped == [8, 8, 1, None]
    bad = spark.createDataFrame([("8:00:00",)], "t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(hour_of(F.col("t"))).collect()
    assert bad.select(hour_of(F.col("t"), lenient=True)).first()[0] is None


def test_hour_labels(spark):
    label = spark.range(24).select(hour_label(F.col("id").cast("int"))).collect()
    assert [row[0] for row in label] == [f"{h:02d}:00 - {h + 1:02d}:00" for h in range(24)]


def test_json_tree_infers_over_all_files(spark, tmp_path):
    deep = tmp_path / "x=1" / "y"
    deep.mkdir(parents=True)
    _file(tmp_path, '{"id": 1, "v": 2}\n', "a.json")
    _file(deep, '{"id": 2, "v": 2.5, "is_assigned": true, "n": {"t": 3}}\n{broken\n', "b.json")
    tree = read_json_tree(spark, str(tmp_path))
    assert tree.columns == ["_corrupt_record", "id", "is_assigned", "n", "v"]
    assert dict(tree.dtypes)["v"] == "double"
    kept = rows_of(tree.filter("id IS NOT NULL").select("id", "is_assigned", "n.t", "v"))
    assert kept == [(1, None, None, 2.0), (2, True, 3, 2.5)]


def test_json_tree_with_schema_runs_no_job_to_infer(spark, tmp_path):
    _file(tmp_path, '{"id": 1, "v": 2}\n', "a.json")
    assert rows_of(read_json_tree(spark, str(tmp_path), "id bigint")) == [(1,)]


def test_compressed_folder(spark, tmp_path):
    rows = spark.createDataFrame([("T1", "S1", "08:00:00")], gtfs.STOP_TIMES)
    path = str(tmp_path / "stop_times.txt")
    rows.repartition(2).write.option("header", "true").option("compression", "gzip").csv(path)
    assert rows_of(read_delimited(spark, path, gtfs.STOP_TIMES)) == [("T1", "S1", "08:00:00")]


def test_glob_over_part_feeds(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        _file(tmp_path / name, f"trip_id,stop_id,arrival_time\n{name},S1,08:00:00\n")
    read = read_delimited(spark, str(tmp_path / "*" / "t.txt"), gtfs.STOP_TIMES)
    assert rows_of(read.select("trip_id")) == [("a",), ("b",)]
    with pytest.raises(HeaderError, match="not there"):
        read_delimited(spark, str(tmp_path / "c*" / "t.txt"), gtfs.STOP_TIMES)


def test_unreadable_numbers(spark, tmp_path):
    path = _file(tmp_path, "stop_id,stop_name,stop_lat,stop_lon\n1,a,north,2\n")
    assert rows_of(read_delimited(spark, path, gtfs.TAGGED_STOPS)) == [("1", "a", None, 2.0)]
    strict = read_delimited(spark, path, gtfs.TAGGED_STOPS, {"mode": "FAILFAST"})
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        strict.collect()
