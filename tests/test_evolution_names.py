"""Column names that differ in case only are one column."""

from __future__ import annotations

from conftest import rows_of

from stopwise.sinks.tables import write_table
from stopwise.sources.tables import read_table


def test_case_of_a_name_adds_no_column(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, "a")], "id int, Name string"), path)
    write_table(spark.createDataFrame([("b", 2)], "NAME string, ID int"), path, mode="append")
    stored = read_table(spark, path)
    assert stored.columns == ["id", "Name"]
    assert rows_of(stored) == [(1, "a"), (2, "b")]
