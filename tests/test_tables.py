"""Save modes, partitioning, schema evolution and replacement."""

from __future__ import annotations

import glob
import os

import pytest
from conftest import plan_of, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopwise import storage
from stopwise.config import Settings
from stopwise.plans.decorators import expect_or_fail, table
from stopwise.sinks.tables import SchemaMismatch, write_batch, write_table
from stopwise.sources.tables import SCHEMA_FILE, read_table, saved_shape


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_overwrite_then_append(spark, path):
    one = frame(spark, [(1, "a")], "id int, s string")
    write_table(one, path)
    assert rows_of(write_table(one, path, mode="append")) == [(1, "a"), (1, "a")]
    assert rows_of(write_table(one, path)) == [(1, "a")]


def test_ignore_and_error_modes(spark, path):
    write_table(frame(spark, [(1,)], "id int"), path)
    two = frame(spark, [(2,)], "id int")
    assert rows_of(write_table(two, path, mode="ignore")) == [(1,)]
    with pytest.raises(FileExistsError):
        write_table(two, path, mode="error")
    for place in (path, path + "_new"):
        with pytest.raises(ValueError, match="unknown save mode"):
            write_table(two, place, mode="upsert")
    assert rows_of(read_table(spark, path)) == [(1,)]


def test_append_adds_columns(spark, path):
    write_table(frame(spark, [(1, "a")], "id int, s string"), path)
    write_table(frame(spark, [(2, 0.5)], "id int, d double"), path, mode="append")
    stored = read_table(spark, path)
    assert stored.columns == ["id", "s", "d"]
    assert rows_of(stored) == [(1, "a", None), (2, None, 0.5)]


def test_overwrite_keeps_old_columns_as_null(spark, path):
    write_table(frame(spark, [(1, "a")], "id int, s string"), path)
    stored = write_table(frame(spark, [(2, 0.5)], "id int, d double"), path)
    assert stored.schema.simpleString() == "struct<id:int,s:string,d:double>"
    assert rows_of(stored) == [(2, None, 0.5)]


def test_replace_forgets_old_columns(spark, path):
    write_table(frame(spark, [(1, "a")], "id int, s string"), path)
    write_table(frame(spark, [(0.5,)], "id double"), path, replace_schema=True)
    assert read_table(spark, path).schema.simpleString() == "struct<id:double>"


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_type_conflict_is_an_error_and_changes_nothing(spark, path, mode):
    write_table(frame(spark, [(1, "a")], "id int, s string"), path)
    with pytest.raises(SchemaMismatch, match="column id "):
        write_table(frame(spark, [("x",)], "id string"), path, mode=mode)
    assert rows_of(read_table(spark, path)) == [(1, "a")]


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_without_merge_new_columns_are_refused(spark, path, mode):
    write_table(frame(spark, [(1,)], "id int"), path)
    with pytest.raises(SchemaMismatch, match="merge_schema is off"):
        write_table(frame(spark, [(1, 2)], "id int, n int"), path, mode=mode, merge_schema=False)


def test_nested_fields_evolve(spark, path):
    write_table(frame(spark, [(1, (2,))], "id int, v struct<a:int>"), path)
    wider = frame(spark, [(2, (3, "b"))], "id int, v struct<a:int,b:string>")
    write_table(wider, path, mode="append")
    got = read_table(spark, path).orderBy("id").select("v.a", "v.b").collect()
    assert [tuple(row) for row in got] == [(2, None), (3, "b")]
    with pytest.raises(SchemaMismatch, match=r"v\.a"):
        write_table(frame(spark, [(3, ("x",))], "id int, v struct<a:string>"), path, mode="append")


def test_fields_inside_arrays_and_maps_evolve(spark, path):
    write_table(
        frame(
            spark,
            [(1, [(2,), None], {"k": (3,)})],
            "id int, a array<struct<x:int>>, m map<string,struct<x:int>>",
        ),
        path,
    )
    stored = write_table(
        frame(
            spark,
            [(2, [("p", 5)], {"k": ("q", 6)}), (3, None, None)],
            "id int, a array<struct<y:string,x:int>>, m map<string,struct<y:string,x:int>>",
        ),
        path,
        mode="append",
    )
    assert stored.schema.simpleString() == (
        "struct<id:int,a:array<struct<x:int,y:string>>,m:map<string,struct<x:int,y:string>>>"
    )
    got = {row.id: row for row in stored.collect()}
    assert [item and tuple(item) for item in got[1].a] == [(2, None), None]
    assert tuple(got[2].a[0]) == (5, "p") and tuple(got[2].m["k"]) == (6, "q")
    assert got[3].a is None and got[3].m is None
    # Rows of the narrower kind still fit the wider table.
    write_table(frame(spark, [(4, [(9,)])], "id int, a array<struct<x:int>>"), path, mode="append")
    assert tuple(read_table(spark, path).filter("id = 4").first().a[0]) == (9, None)
    with pytest.raises(SchemaMismatch, match="merge_schema is off"):
        write_table(
            frame(spark, [(5, [(1, 2)])], "id int, a array<struct<x:int,z:int>>"),
            path,
            mode="append",
            merge_schema=False,
        )


COLUMNS = {"a": ("int", 1), "b": ("string", "x"), "c": ("double", 0.5), "d": ("bigint", 7)}


@given(
    st.lists(
        st.tuples(
            st.sampled_from(["append", "overwrite", "replace"]),
            st.sets(st.sampled_from(sorted(COLUMNS)), min_size=1),
            st.integers(1, 3),
        ),
        min_size=1,
        max_size=4,
    )
)
@settings(max_examples=12, deadline=None)
def test_any_sequence_of_writes(spark, tmp_path_factory, writes):
    """The table against a list of dicts and a list of known columns."""
    path = str(tmp_path_factory.mktemp("seq") / "t")
    rows, known = [], []
    for mode, names, count in writes:
        names = sorted(names)
        ddl = ", ".join(f"{name} {COLUMNS[name][0]}" for name in names)
        values = tuple(COLUMNS[name][1] for name in names)
        df = frame(spark, [values] * count, ddl)
        if mode == "replace":
            write_table(df, path, replace_schema=True)
        else:
            write_table(df, path, mode=mode)
        new = [dict(zip(names, values))] * count
        rows = rows + new if mode == "append" else new
        known = names if mode == "replace" else known + [n for n in names if n not in known]
    stored = read_table(spark, path)
    assert stored.columns == known
    expected = sorted((tuple(row.get(name) for name in known) for row in rows), key=repr)
    assert rows_of(stored) == expected


def test_partitioned_write_keeps_types_and_prunes(spark, path):
    rows = [(i, f"{i % 3:03d}") for i in range(30)]
    stored = write_table(frame(spark, rows, "id int, code string"), path, partition_cols=["code"])
    assert sorted(os.path.basename(p) for p in glob.glob(f"{path}/code=*")) == [
        "code=000",
        "code=001",
        "code=002",
    ]
    again = read_table(spark, path)
    assert again.schema == stored.schema and again.columns == ["id", "code"]
    assert dict(again.dtypes)["code"] == "string"
    picked = again.filter("code = '001'")
    assert "PartitionFilters: [isnotnull(code" in plan_of(picked)
    assert picked.count() == 10


def test_append_follows_the_partitioning(spark, path):
    write_table(frame(spark, [(1, "a")], "id int, k string"), path, partition_cols=["k"])
    write_table(frame(spark, [(2, "b")], "id int, k string"), path, mode="append")
    assert saved_shape(spark, path).partition_cols == ("k",)
    assert rows_of(read_table(spark, path)) == [(1, "a"), (2, "b")]
    with pytest.raises(SchemaMismatch, match="partitioned by"):
        two = frame(spark, [(2, "b")], "id int, k string")
        write_table(two, path, mode="append", partition_cols=["id"])


def test_sorted_files_skip_row_groups(spark, path):
    rows = spark.range(0, 5000, 1, 4).select(
        (F.col("id") % 97).alias("v"), (F.col("id") % 3).cast("int").alias("k")
    )
    stored = write_table(rows, path, partition_cols=["k"], sort_cols=["v"])
    assert stored.count() == 5000
    for part in glob.glob(f"{path}/k=*/*.parquet"):
        values = [row.v for row in spark.read.parquet(part).collect()]
        assert values == sorted(values) and len(values) > 1000
    assert "PushedFilters: [In(v" in plan_of(stored.filter(F.col("v").isin(3, 5)))


def test_hot_partition_is_written_by_several_tasks(spark, path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    rows = spark.range(0, 60000, 1, 16).select(
        F.md5(F.col("id").cast("string")).alias("payload"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 20).cast("string")))
        .alias("k"),
    )
    assert write_table(rows, path, partition_cols=["k"]).count() == 60000
    assert len(glob.glob(f"{path}/k=hot/*.parquet")) > 4
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    calm = path + "_calm"
    write_table(rows, calm, partition_cols=["k"])
    assert max(len(glob.glob(f"{folder}/*.parquet")) for folder in glob.glob(f"{calm}/k=*")) == 1


def test_a_table_may_be_overwritten_from_itself(spark, path):
    write_table(spark.range(100).withColumn("v", F.col("id")), path)
    doubled = read_table(spark, path).withColumn("v", F.col("v") * 2)
    stored = write_table(doubled, path)
    assert stored.agg(F.sum("v")).first()[0] == 2 * sum(range(100))
    assert glob.glob(f"{path}__*") == []


def test_overwrite_in_place(spark, path):
    write_table(frame(spark, [(1, "a")], "id int, s string"), path)
    stored = write_table(frame(spark, [(2, 0.5)], "id int, d double"), path, staged=False)
    assert rows_of(stored) == rows_of(read_table(spark, path)) == [(2, None, 0.5)]


def test_a_failed_overwrite_leaves_the_table(spark, path):
    write_table(spark.range(5), path)
    broken = spark.range(5).select(F.assert_true(F.col("id") < 3).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        write_table(broken, path)
    assert read_table(spark, path).count() == 5
    assert glob.glob(f"{path}__*") == []


def test_folder_of_other_origin_is_read_with_merged_schema(spark, path):
    frame(spark, [(1,)], "a int").write.parquet(path)
    frame(spark, [(2,)], "b int").write.mode("append").parquet(path)
    assert set(read_table(spark, path).columns) == {"a", "b"}
    write_table(frame(spark, [(3,)], "c int"), path, mode="append")
    assert set(read_table(spark, path).columns) == {"a", "b", "c"}
    assert read_table(spark, path).count() == 3


def test_partitioned_folder_of_other_origin_stays_partitioned(spark, path):
    frame(spark, [(1, "a"), (2, "b")], "id int, k string").write.partitionBy("k").parquet(path)
    write_table(frame(spark, [(3, "c", 0.5)], "id int, k string, d double"), path, mode="append")
    assert os.path.isdir(f"{path}/k=c") and not glob.glob(f"{path}/*.parquet")
    stored = read_table(spark, path).select("id", "k", "d")
    assert rows_of(stored) == [(1, "a", None), (2, "b", None), (3, "c", 0.5)]


def test_empty_folder_counts_as_no_table(spark, path):
    os.makedirs(path)
    assert rows_of(write_table(frame(spark, [(1,)], "id int"), path, mode="error")) == [(1,)]


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_file_formats(spark, path, fmt):
    write_table(frame(spark, [(1, "a")], "id int, s string"), path, fmt=fmt)
    write_table(frame(spark, [(2, 0.5)], "id int, d double"), path, mode="append", fmt=fmt)
    assert rows_of(read_table(spark, path, fmt)) == [(1, "a", None), (2, None, 0.5)]


def test_column_names_with_dots(spark, path):
    stored = write_table(frame(spark, [(1,)], "`a.b` int"), path)
    assert stored.columns == ["a.b"]


def test_delta_goes_through_its_own_writer(spark, path):
    with pytest.raises(Exception, match="(?i)delta"):
        write_table(spark.range(1), path, fmt="delta")
    with pytest.raises(Exception, match="(?i)delta"):
        write_batch(spark.range(1), path, "stream", 1, fmt="delta")


def test_decorator_returns_the_stored_rows(spark, path):
    @table("clock", path=path)
    def clock():
        return spark.range(3).withColumn("ingest_ts", F.current_timestamp())

    stored = clock()
    assert stored.collect() == stored.collect()
    assert stored.collect() == read_table(spark, path).collect()


def test_decorator_can_return_the_source(spark, path):
    @table("source", path=path, return_source=True)
    def source():
        return spark.range(3)

    assert "Range" in plan_of(source())
    assert read_table(spark, path).count() == 3


def test_default_path_and_environment(spark, tmp_path, monkeypatch):
    assert Settings(table_base=".").table_path("orders") == "./orders"
    monkeypatch.setenv("RAW_BASE_PATH", "/somewhere")
    assert Settings().raw_path == "/somewhere"
    monkeypatch.delenv("RAW_BASE_PATH")
    assert Settings().raw_path == "/data/raw"
    monkeypatch.setenv("TABLE_BASE_PATH", str(tmp_path))

    @table("orders", partition_cols=["k"], mode="append")
    def orders():
        return frame(spark, [(1, "a")], "id int, k string")

    orders()
    orders()
    assert storage.exists(spark, f"{tmp_path}/orders/{SCHEMA_FILE}")
    assert read_table(spark, f"{tmp_path}/orders").count() == 2


def test_failing_above_table_comes_after_the_write(spark, path):
    @expect_or_fail("small", "id < 2")
    @table("late", path=path)
    def late():
        return spark.range(3)

    with pytest.raises(ValueError):
        late()
    assert read_table(spark, path).count() == 3


def test_failing_below_table_comes_before_the_write(spark, path):
    @table("early", path=path)
    @expect_or_fail("small", "id < 2")
    def early():
        return spark.range(3)

    with pytest.raises(ValueError):
        early()
    assert not storage.exists(spark, path)


def test_stored_schema_spares_the_footer_pass(spark, path):
    write_table(spark.range(10), path)
    logical = read_table(spark, path)._jdf.queryExecution().logical().toString()
    assert "mergeschema" not in logical.lower()
    assert saved_shape(spark, path).schema.names == ["id"]
