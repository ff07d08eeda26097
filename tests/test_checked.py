"""One-pass checked writes, VARIANT landing, and streams that keep a row once."""

from __future__ import annotations

import json

import pytest
from conftest import rows_of

from stopwise import storage
from stopwise.operators.expectations import QUARANTINE_COLUMN, ExpectationFailed
from stopwise.plans.checked import write_checked
from stopwise.sources.json_tree import fields_in, read_json_tree, read_json_variants, with_fields
from stopwise.sources.tables import read_table
from stopwise.sinks.tables import write_table
from stopwise.streaming.medallion import late_rows, start_unique, stream_json_tree

ROWS = [(1, 10, "a"), (2, None, "b"), (3, -5, None), (None, 7, "a"), (5, 60, "c")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, v long, k string")


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "t"), str(tmp_path / "history")


def history_of(spark, place):
    found = read_table(spark, place).select("run", "rule", "kind", "rows", "passed", "failed", "unknown")
    return rows_of(found)


def test_all_kinds_are_counted_while_writing(spark, rows, places):
    stored = write_checked(
        rows, *places, run="r", drop={"has id": "id > 0"}, flag={"small": "v < 50"}, fail={"k": "k <> 'z'"}
    )
    kept = [(1, 10, "a", False), (2, None, "b", None), (3, -5, None, False), (5, 60, "c", True)]
    assert rows_of(stored.select("id", "v", "k", QUARANTINE_COLUMN)) == sorted(kept, key=repr)
    assert history_of(spark, places[1]) == [
        ("r", "has id", "drop", 5, 4, 0, 1), ("r", "k", "fail", 4, 3, 0, 1), ("r", "small", "flag", 4, 2, 1, 1),
    ]


def test_a_refused_write_leaves_its_counts_and_no_rows(spark, rows, places):
    write_checked(rows, *places, run="1", drop={"has id": "id > 0"}, fail={"positive": "v > -9"})
    before = rows_of(read_table(spark, places[0]))
    for mode in ("overwrite", "append"):
        with pytest.raises(ExpectationFailed, match="positive"):
            write_checked(rows, *places, run=mode, fail={"positive": "v > 0"}, mode=mode)
    assert rows_of(read_table(spark, places[0])) == before
    assert ("append", "positive", "fail", 5, 3, 1, 1) in history_of(spark, places[1])
    assert ("overwrite", "positive", "fail", 5, 3, 1, 1) in history_of(spark, places[1])


def test_the_source_is_read_once(spark, places, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.range(100).mapInArrow(seen, "id long")
    write_checked(source, *places, drop={"a": "id > 9"}, flag={"b": "id > 50"}, fail={"c": "id < 1000"})
    assert reads.value == 100 and read_table(spark, places[0]).count() == 90


def test_no_rows_and_no_rules(spark, rows, places):
    write_checked(rows.where("false"), *places, run="e", drop={"d": "id > 0"}, fail={"f": "v > 0"})
    assert history_of(spark, places[1]) == [("e", "d", "drop", 0, 0, 0, 0), ("e", "f", "fail", 0, 0, 0, 0)]
    assert rows_of(write_checked(rows, *places, run="n")) == sorted(ROWS, key=repr)
    assert len(history_of(spark, places[1])) == 2
    with pytest.raises(ValueError, match="ignore"):
        write_checked(rows, *places, mode="ignore")


def test_a_job_that_dies_is_not_waited_for(spark, rows, places):
    with pytest.raises(Exception, match="RAISED|boom"):
        write_checked(rows.selectExpr("id", "raise_error('boom') as v"), *places, fail={"f": "id > 0"})
    assert not storage.is_there(spark, places[1])


# ---------------------------------------------------------------- VARIANT


def lines(folder, name, *values):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(v if isinstance(v, str) else json.dumps(v) for v in values) + "\n")
    return str(folder)


def test_a_field_that_comes_later_is_read_without_a_new_schema(spark, tmp_path):
    table = str(tmp_path / "bronze")
    early = lines(tmp_path / "a", "x.json", {"id": 1, "d": {"t": "x"}}, "", {"id": 2})
    late = lines(tmp_path / "b" / "deep", "y.json", {"id": 3, "n": [1, 2], "d": {"u": 0.5}}, {"id": "four"})
    for place in (early, late):
        stored = write_table(read_json_variants(spark, place), table, mode="append")
    found = with_fields(stored, {"id": "long", "d.t": "string", "d.u": "double", "n": "array<int>"})
    assert found.columns == ["id", "d_t", "d_u", "n"]
    assert rows_of(found) == sorted(
        [(1, "x", None, None), (2, None, None, None), (3, None, 0.5, [1, 2]), (None, None, None, None)], key=repr
    )
    assert fields_in(stored) == "OBJECT<d: OBJECT<t: STRING, u: DECIMAL(1,1)>, id: VARIANT, n: ARRAY<BIGINT>>"
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        with_fields(stored, {"id": "long"}, strict=True).collect()


def test_variants_agree_with_declared_fields(spark, tmp_path):
    place = lines(tmp_path / "a", "x.json", *({"id": k, "s": f"v{k}", "f": k / 4} for k in range(50)))
    declared = read_json_tree(spark, place, "id long, s string, f double")
    landed = with_fields(read_json_variants(spark, place), {"id": "long", "s": "string", "f": "double"})
    assert rows_of(landed) == rows_of(declared)


def test_lines_that_are_no_json(spark, tmp_path):
    place = lines(tmp_path / "a", "x.json", {"id": 1}, "broken{", "null")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_variants(spark, place).collect()
    kept = read_json_variants(spark, place, malformed="keep")
    assert rows_of(with_fields(kept, {"id": "long"})) == [("broken{", None), (None, 1), (None, None)]
    assert read_json_variants(spark, place, malformed="null").where("raw is null").count() == 1
    with pytest.raises(ValueError):
        read_json_variants(spark, place, malformed="what")


# ---------------------------------------------------------------- once per key


def test_a_file_delivered_twice_gives_its_rows_once(spark, tmp_path):
    silver, checkpoint = str(tmp_path / "silver"), str(tmp_path / "c")

    def run():
        rows = stream_json_tree(spark, str(tmp_path / "raw"), "id long, at timestamp", 1)
        query = start_unique(spark, rows, silver, checkpoint, ["id"], "at", "1 hour")
        query.awaitTermination()
        return late_rows(query)

    def at(hour, *numbers):
        return [{"id": n, "at": f"2024-01-01T{hour:02d}:00:00Z"} for n in numbers]

    lines(tmp_path / "raw", "a.json", *at(10, 1, 2, 2))
    assert run() == 0
    lines(tmp_path / "raw", "a-again.json", *at(10, 1, 2))
    lines(tmp_path / "raw", "b.json", *at(11, 3))
    run()
    assert rows_of(read_table(spark, silver).select("id")) == [(1,), (2,), (3,)]
    # The watermark stands at ten by now, and moves on to nineteen.
    lines(tmp_path / "raw", "c.json", *at(20, 4))
    run()
    lines(tmp_path / "raw", "d.json", *at(9, 5, 6), *at(21, 7))
    assert run() == 2
    assert rows_of(read_table(spark, silver).select("id")) == [(1,), (2,), (3,), (4,), (7,)]
