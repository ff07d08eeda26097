"""Situations in which a table write once lost, hid or corrupted rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stopwise import storage
from stopwise.operators.activity import tally
from stopwise.operators.expectations import ExpectationFailed, require_all
from stopwise.operators.summaries import hourly_trend
from stopwise.plans.decorators import expect_all_or_fail, table
from stopwise.sinks import tables as sink
from stopwise.sinks.tables import SchemaMismatch, replace_partitions, write_batch, write_table
from stopwise.sources.delimited import read_delimited
from stopwise.sources.json_tree import read_json_tree
from stopwise.sources.tables import TableShape, read_table, save_shape, saved_shape
from stopwise.streaming.medallion import default_checkpoint, start_bronze


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def raw_json(folder, name, *numbers):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f'{{"id": {n}}}\n' for n in numbers))
    return str(folder)


def test_append_to_a_folder_with_a_stream_log_raises(spark, tmp_path):
    """Spark's own file sink hides all files that its log does not list."""
    raw, sunk = raw_json(tmp_path / "raw", "a.json", 1, 2), str(tmp_path / "sunk")
    rows = spark.readStream.schema("id long").json(raw).writeStream.format("parquet")
    rows = rows.option("path", sunk).option("checkpointLocation", str(tmp_path / "c"))
    rows.trigger(availableNow=True).start().awaitTermination()
    before = rows_of(spark.read.parquet(sunk))
    for options in ({"mode": "append"}, {"staged": False}):
        with pytest.raises(ValueError, match="stream"):
            write_table(ids(spark, 7).withColumn("x", F.lit(1)), sunk, **options)
    assert rows_of(spark.read.parquet(sunk)) == before and len(before) == 2


def test_stream_and_batches_share_a_table(spark, tmp_path):
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "c")
    schema = StructType.fromDDL("id long")

    def stream():
        start_bronze(spark, str(tmp_path / "raw"), schema, bronze, checkpoint).awaitTermination()

    write_table(ids(spark, *range(10)), bronze, mode="append")
    raw_json(tmp_path / "raw", "a.json", 100, 101, 102)
    stream()
    assert read_table(spark, bronze).count() == spark.read.parquet(bronze).count() == 13
    write_table(ids(spark, 7, 8).withColumn("x", F.lit(1)), bronze, mode="append")
    raw_json(tmp_path / "raw", "b.json", 200)
    stream()
    stream()
    found = read_table(spark, bronze)
    assert set(found.columns) == {"id", "ingest_ts", "x"}
    assert sorted(r["id"] for r in found.collect()) == sorted([*range(10), 100, 101, 102, 7, 8, 200])
    assert sum("_stopwise_batch." in n for n in storage.names_in(spark, bronze)) == 1


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_batch(ids(spark, 1, 2), path, "a", 0)
    assert not write_batch(ids(spark, 1, 2), path, "a", 0)
    assert write_batch(ids(spark, 3), path, "a", 1)
    assert not write_batch(ids(spark, 9), path, "a", 0)
    assert write_batch(ids(spark, 4), path, "another-stream", 0)
    assert rows_of(read_table(spark, path)) == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError, match="name of a stream"):
        write_batch(ids(spark, 1), path, "a/b", 0)


@pytest.mark.parametrize("partition_cols", [[], ["id"]])
@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_batch_that_dies_while_moving_is_finished(spark, tmp_path, monkeypatch, moved, partition_cols):
    path, rename, calls = str(tmp_path / "t"), storage.rename, []

    def dies(session, source, destination):
        if len(calls) == moved:
            raise KeyboardInterrupt
        calls.append(source)
        rename(session, source, destination)

    rows = ids(spark, *range(40)).withColumn("v", F.col("id")).repartition(3)
    rows = rows.where("id < 4") if partition_cols else rows
    monkeypatch.setattr(storage, "rename", dies)
    with pytest.raises(KeyboardInterrupt):
        write_batch(rows, path, "s", 0, partition_cols=partition_cols)
    monkeypatch.setattr(storage, "rename", rename)
    assert write_batch(rows, path, "s", 0, partition_cols=partition_cols)
    stored = read_table(spark, path)
    assert sorted(r["v"] for r in stored.collect()) == sorted(r["v"] for r in rows.collect())
    assert not any("adding" in name for name in storage.names_in(spark, path))


def test_a_batch_that_dies_before_it_is_complete_is_written_anew(spark, tmp_path, monkeypatch):
    path, write_text = str(tmp_path / "t"), storage.write_text

    def dies(session, name, text):
        if name.endswith(sink.COMPLETE):
            raise KeyboardInterrupt
        write_text(session, name, text)

    monkeypatch.setattr(storage, "write_text", dies)
    with pytest.raises(KeyboardInterrupt):
        write_batch(ids(spark, 1, 2), path, "s", 0)
    monkeypatch.setattr(storage, "write_text", write_text)
    assert write_batch(ids(spark, 1, 2), path, "s", 0)
    assert rows_of(read_table(spark, path)) == [(1,), (2,)]


def between_look_and_write(monkeypatch, action):
    """Have ``action`` run once after a writer has looked for its table and before it writes."""
    arranged, waiting = sink._arranged, [action]

    def interleaved(*args):
        if waiting:
            waiting.pop()()
        return arranged(*args)

    monkeypatch.setattr(sink, "_arranged", interleaved)


@pytest.mark.parametrize("staged", [True, False])
def test_first_appends_side_by_side_keep_all_rows(spark, tmp_path, monkeypatch, staged):
    path = str(tmp_path / "t")
    wider = ids(spark, *range(7)).withColumn("x", F.lit("new"))
    between_look_and_write(monkeypatch, lambda: write_table(wider, path, mode="append"))
    stored = write_table(ids(spark, *range(10, 15)), path, mode="append", staged=staged)
    want = [*((n, "new") for n in range(7)), *((n, None) for n in range(10, 15))]
    assert rows_of(stored) == sorted(want, key=repr)
    assert rows_of(read_table(spark, path)) == rows_of(stored)


def test_first_appends_that_partition_differently(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string")
    between_look_and_write(
        monkeypatch, lambda: write_table(rows, path, mode="append", partition_cols=["k"])
    )
    stored = write_table(rows, path, mode="append")
    assert rows_of(stored) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert saved_shape(spark, path).partition_cols == ("k",)


def test_first_appends_of_other_types_raise(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    between_look_and_write(monkeypatch, lambda: write_table(ids(spark, 1, 2), path, mode="append"))
    with pytest.raises(SchemaMismatch):
        write_table(spark.createDataFrame([("x",)], "id string"), path, mode="append")
    assert rows_of(read_table(spark, path)) == [(1,), (2,)]


@pytest.mark.parametrize("mode", ["error", "ignore"])
def test_a_table_made_meanwhile_exists(spark, tmp_path, monkeypatch, mode):
    path = str(tmp_path / "t")
    between_look_and_write(monkeypatch, lambda: write_table(ids(spark, 1), path, mode="append"))
    if mode == "error":
        with pytest.raises(FileExistsError):
            write_table(ids(spark, 2), path, mode=mode)
    else:
        write_table(ids(spark, 2), path, mode=mode)
    assert rows_of(read_table(spark, path)) == [(1,)]


def test_columns_of_one_name_and_two_types_added_side_by_side(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(ids(spark, 1), path)
    number, text = (ids(spark, n).withColumn("x", F.lit(v)) for n, v in ((2, 0.5), (3, "s")))
    between_look_and_write(monkeypatch, lambda: write_table(number, path, mode="append"))
    with pytest.raises(SchemaMismatch):
        write_table(text, path, mode="append")
    assert rows_of(read_table(spark, path)) == [(1, None), (2, 0.5)]


def test_many_writers_make_and_fill_one_table(spark, tmp_path):
    path = str(tmp_path / "t")

    def add(k):
        rows = spark.range(k * 1000, k * 1000 + 1000, 1, 4)
        write_table(rows.withColumn(f"c{k % 3}", F.lit(k)), path, mode="append")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(add, range(8)))
    stored = read_table(spark, path)
    assert sorted(stored.columns) == ["c0", "c1", "c2", "id"]
    assert stored.agg(F.count("*"), F.count_distinct("id")).first()[:] == (8000, 8000)


def test_a_failed_first_append_makes_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ExpectationFailed):
        write_table(ids(spark, 1, -1), path, mode="append", checks={"positive": "id > 0"})
    assert rows_of(write_table(spark.createDataFrame([("x",)], "id string"), path, mode="error")) == [("x",)]


# ---------------------------------------------------------------- single partitions


def by_day(spark, *rows):
    return spark.createDataFrame(list(rows), "day int, id long")


def files_of(folder):
    return {p.relative_to(folder).as_posix(): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


@pytest.fixture
def days(spark, tmp_path):
    write_table(by_day(spark, (1, 10), (2, 20), (3, 30)), str(tmp_path / "t"), partition_cols=["day"])
    return tmp_path / "t"


def test_only_the_partitions_with_rows_are_replaced(spark, days):
    before = files_of(days)
    stored = replace_partitions(by_day(spark, (2, 21), (2, 22), (4, 40)), str(days))
    assert rows_of(stored.select("day", "id")) == [(1, 10), (2, 21), (2, 22), (3, 30), (4, 40)]
    after = files_of(days)
    for part in ("day=1", "day=3"):
        kept = {k: v for k, v in before.items() if k.startswith(part)}
        assert kept and kept.items() <= after.items()
    assert not any(n.startswith(("_stopwise_rep", "_stopwise_ret")) for n in storage.names_in(spark, str(days)))


def test_partitions_may_be_replaced_from_themselves(spark, days):
    stored = read_table(spark, str(days))
    doubled = stored.where("day <> 3").withColumn("id", F.col("id") * 2)
    assert rows_of(replace_partitions(doubled, str(days)).select("day", "id")) == [(1, 20), (2, 40), (3, 30)]


@pytest.mark.parametrize("moves", range(5))
def test_an_interrupted_replacement_is_finished(spark, days, monkeypatch, moves):
    rename, calls = storage.rename, []

    def dies(session, source, destination):
        if len(calls) == moves:
            raise KeyboardInterrupt
        calls.append(source)
        rename(session, source, destination)

    monkeypatch.setattr(storage, "rename", dies)
    rows = by_day(spark, (1, 11), (2, 21), (5, 50))
    with pytest.raises(KeyboardInterrupt):
        replace_partitions(rows, str(days))
    monkeypatch.setattr(storage, "rename", rename)
    stored = replace_partitions(by_day(spark, (9, 90)), str(days))
    assert rows_of(stored.select("day", "id")) == [(1, 11), (2, 21), (3, 30), (5, 50), (9, 90)]


def test_a_replacement_that_fails_changes_nothing(spark, days):
    with pytest.raises(ExpectationFailed):
        replace_partitions(by_day(spark, (1, -1)), str(days), checks={"positive": "id > 0"})
    with pytest.raises(SchemaMismatch):
        replace_partitions(by_day(spark, (1, 1)).withColumn("x", F.lit(1)), str(days))
    assert rows_of(read_table(spark, str(days)).select("day", "id")) == [(1, 10), (2, 20), (3, 30)]


def test_only_partitioned_tables_have_partitions_to_replace(spark, tmp_path):
    write_table(ids(spark, 1), str(tmp_path / "t"))
    for path in ("t", "none"):
        with pytest.raises(ValueError, match="partitioned"):
            replace_partitions(ids(spark, 1), str(tmp_path / path))


def test_folders_above_a_table_are_not_its_partitions(spark, tmp_path):
    path = str(tmp_path / "day=5" / "events")
    rows = spark.createDataFrame([(1, 5), (2, 5)], "id long, day int")
    rows.write.parquet(path)
    stored = write_table(spark.createDataFrame([(3, 6)], "id long, day int"), path, mode="append")
    assert rows_of(stored) == [(1, 5), (2, 5), (3, 6)]
    assert saved_shape(spark, path).partition_cols == ()


def test_interrupted_swap_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(ids(spark, *range(10)), path)
    rename, calls = storage.rename, []

    def dies(session, source, destination):
        calls.append(source)
        if len(calls) > 1:
            raise KeyboardInterrupt
        rename(session, source, destination)

    monkeypatch.setattr(storage, "rename", dies)
    with pytest.raises(KeyboardInterrupt):
        write_table(ids(spark, *range(5)), path)
    monkeypatch.setattr(storage, "rename", rename)
    assert not storage.exists(spark, path)
    stored = write_table(ids(spark, 100, 101), path, mode="append")
    assert stored.count() == 12


def test_interrupt_at_the_swap_restores_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(ids(spark, *range(10)), path)
    rename = storage.rename

    def dies(session, source, destination):
        if "__new_" in source:
            raise KeyboardInterrupt
        rename(session, source, destination)

    monkeypatch.setattr(storage, "rename", dies)
    with pytest.raises(KeyboardInterrupt):
        write_table(ids(spark, *range(5)), path)
    assert read_table(spark, path).count() == 10


def test_two_evolving_appends_keep_both_columns(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(ids(spark, 1), path)
    save, done = sink._save, []

    def overtaken(df, target, mode, shape, fmt):
        if not done:
            done.append(1)
            write_table(ids(spark, 3).withColumn("y", F.lit("b")), path, mode="append")
        save(df, target, mode, shape, fmt)

    monkeypatch.setattr(sink, "_save", overtaken)
    write_table(ids(spark, 2).withColumn("x", F.lit("a")), path, mode="append")
    stored = read_table(spark, path)
    assert stored.columns[0] == "id" and sorted(stored.columns[1:]) == ["x", "y"]
    assert rows_of(stored.select("id", "x", "y")) == [(1, None, None), (2, "a", None), (3, None, "b")]


def test_conflicting_added_columns_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(ids(spark, 1), path)
    for kind in ("id long, x int", "id long, x string"):
        save_shape(spark, path, TableShape(StructType.fromDDL(kind)), added=True)
    with pytest.raises(SchemaMismatch):
        read_table(spark, path)


def test_names_that_differ_in_case_stay_apart_where_the_session_says_so(spark, conf, tmp_path):
    conf("spark.sql.caseSensitive", "true")
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, 2)], "a int, A int"), path)
    stored = write_table(spark.createDataFrame([(3, 4)], "a int, A int"), path, mode="append")
    assert rows_of(stored) == [(1, 2), (3, 4)]


def test_overwrite_in_place_under_dynamic_partition_overwrite(spark, conf, tmp_path):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("p", F.lit("old"))
    write_table(rows, path, partition_cols=["p"])
    stored = write_table(rows.withColumn("p", F.lit("new")), path, partition_cols=["p"], staged=False)
    assert stored.count() == 10 and stored.select("p").distinct().count() == 1


def test_killed_first_write_does_not_block_the_table(spark, tmp_path):
    path = tmp_path / "t"
    (path / "_temporary" / "0").mkdir(parents=True)
    assert write_table(ids(spark, 1), str(path)).count() == 1


def test_empty_partitioned_table_is_still_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(ids(spark).withColumn("p", F.lit("a")), path, partition_cols=["p"])
    stored = write_table(ids(spark, 1).withColumn("p", F.lit("a")).withColumn("x", F.lit(1)), path, mode="append")
    assert rows_of(stored.select("id", "p", "x")) == [(1, "a", 1)]
    assert saved_shape(spark, path).partition_cols == ("p",)


def test_delta_writes_are_rebalanced_and_sorted(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(sink, "_write_delta", lambda df, *rest: seen.append(df))
    monkeypatch.setattr(sink, "read_table", lambda *a: None)
    rows = spark.range(10).withColumn("p", F.col("id") % 2)
    write_table(rows, str(tmp_path / "t"), fmt="delta", partition_cols=["p"], sort_cols=["id"])
    plan = plan_of(seen[0])
    assert "REBALANCE" in plan and "Sort [p" in plan


def test_separator_of_the_options_splits_the_header(spark, tmp_path):
    file = tmp_path / "stops.txt"
    file.write_text("'stop;id';name\n1;'a;b'\n")
    schema = StructType.fromDDL("name string")
    found = read_delimited(spark, str(file), schema, {"sep": ";", "quote": "'"})
    assert rows_of(found) == [("a;b",)]


def test_malformed_json_under_a_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{broken\n{"id": 2}\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_json_tree(spark, str(tmp_path), "id long").collect()
    kept = read_json_tree(spark, str(tmp_path), "id long", malformed="keep")
    assert rows_of(kept) == [(1, None), (2, None), (None, "{broken")]
    assert read_json_tree(spark, str(tmp_path), "id long", malformed="null").count() == 3


def test_stream_progress_needs_a_lasting_folder(spark):
    assert default_checkpoint(spark, "q").endswith("/streams/q")
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="checkpoint"):
        default_checkpoint(bare, "q")


def test_a_column_named_like_a_count_is_counted_not_summed(spark):
    rows = spark.createDataFrame([(8, "a", 100), (8, "a", 200)], "hour int, route_id string, n_rows int")
    assert hourly_trend(rows, "route_id").first().arrivals == 2
    counted = tally(rows.withColumn("trip_id", F.lit("t")), "hour", "route_id")
    assert hourly_trend(counted, "route_id").first().arrivals == 2


def test_stored_tally_is_still_one(spark, tmp_path):
    rows = spark.createDataFrame([(8, "a", "t")] * 3, "hour int, route_id string, trip_id string")
    for _ in range(2):
        stored = write_table(tally(rows, "hour", "route_id"), str(tmp_path / "t"))
    assert rows_of(tally(stored, "route_id")) == [("a", 3, 3)]


RULES = {"small": "id < 8", "even": "id % 2 = 0", "known": "id is not null"}


def test_all_rules_are_counted_in_one_pass(spark):
    group = "one-pass"
    spark.sparkContext.setJobGroup(group, group)
    require_all(spark.range(0, 8, 2), RULES)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 2  # one query; AQE runs its two stages as jobs

    @expect_all_or_fail(RULES)
    def step():
        return spark.range(10)

    with pytest.raises(ExpectationFailed) as error:
        step()
    assert str(error.value) == (
        "Expectation 'small' failed: 2 rows do not meet the condition; "
        "Expectation 'even' failed: 5 rows do not meet the condition"
    )


@pytest.mark.parametrize("mode, staged", [("overwrite", True), ("overwrite", False), ("append", True)])
def test_failed_check_leaves_the_old_table(spark, tmp_path, mode, staged):
    path = str(tmp_path / "t")
    write_table(ids(spark, 1, 2), path)
    with pytest.raises(ExpectationFailed, match="'small' failed: 1 rows"):
        write_table(ids(spark, 2, 9), path, mode=mode, staged=staged, checks={"small": "id < 8"})
    assert rows_of(read_table(spark, path)) == [(1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_failed_check_leaves_no_first_table(spark, tmp_path):
    @table("t", path=str(tmp_path / "t"), checks={"small": "id < 8"})
    def step():
        return ids(spark, 9)

    with pytest.raises(ExpectationFailed):
        step()
    assert list(tmp_path.iterdir()) == []
