"""TRUE, FALSE and NULL under each mode."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stopwise.operators.expectations import (
    ExpectationFailed,
    drop_failing,
    expectation_report,
    flag_failing,
    require,
    violations,
)
from stopwise.plans.decorators import expect_all, expect_or_drop, expect_or_fail, temporary_view


@pytest.fixture
def verdicts(spark):
    return spark.createDataFrame([(1, 5), (2, -5), (3, None)], "id int, x int")


def test_drop_keeps_true_only(verdicts):
    assert rows_of(drop_failing(verdicts, "x > 0")) == [(1, 5)]


def test_drop_counts_when_observed(verdicts):
    seen = Observation("drops")
    drop_failing(verdicts, "x > 0", seen).collect()
    assert seen.get == {"rows_in": 3, "rows_kept": 1}


def test_flag_is_three_valued(verdicts):
    flagged = flag_failing(verdicts, {"positive": "x > 0"})
    assert rows_of(flagged.select("id", "is_quarantined")) == [(1, False), (2, True), (3, None)]


def test_flag_null_gives_way_to_another_failure(spark):
    df = spark.createDataFrame([(None, 1), (None, 9), (1, 1)], "a int, b int")
    flagged = flag_failing(df, {"a": "a > 0", "b": "b < 5"})
    assert [row.is_quarantined for row in flagged.orderBy("b", "a").collect()] == [
        None,
        False,
        True,
    ]


def test_flag_can_count_null_as_failure(verdicts):
    flagged = flag_failing(verdicts, {"positive": "x > 0"}, null_is_failure=True)
    assert rows_of(flagged.select("id", "is_quarantined")) == [(1, False), (2, True), (3, True)]


def test_no_rules_flag_nothing(verdicts):
    assert {row.is_quarantined for row in flag_failing(verdicts, {}).collect()} == {False}


def test_rule_text_cannot_reach_its_neighbour(verdicts):
    rules = {"either": "x > 0 OR x < 0", "comment": "x > -100 -- always"}
    flagged = flag_failing(verdicts, rules).filter("is_quarantined IS NOT NULL")
    assert rows_of(flagged.select("id", "is_quarantined")) == [(1, False), (2, False)]


def test_fail_counts_false_only(verdicts):
    with pytest.raises(ExpectationFailed) as failure:
        require(verdicts, "positive", "x > 0")
    assert str(failure.value) == (
        "Expectation 'positive' failed: 1 rows do not meet the condition"
    )
    assert isinstance(failure.value, ValueError)


def test_fail_lets_null_pass(verdicts):
    passed = require(verdicts.filter("id <> 2"), "positive", "x > 0")
    assert passed.count() == 2


def test_violations_of_nothing(verdicts):
    assert violations(verdicts.filter("false"), "x > 0").first().failing == 0


def test_report_counts_every_rule(verdicts):
    report = expectation_report(verdicts, {"positive": "x > 0", "small": "x < 100"})
    assert rows_of(report) == [("positive", 1, 1, 1), ("small", 2, 0, 1)]
    assert rows_of(expectation_report(verdicts, {})) == []


def test_report_reads_the_input_once(verdicts):
    from conftest import plan_of

    plan = plan_of(expectation_report(verdicts, {"a": "x > 0", "b": "x < 9", "c": "x = 1"}))
    assert plan.count("Scan ExistingRDD") == 1


def test_expectation_below_view_filters_the_view(spark, verdicts):
    @temporary_view()
    @expect_or_drop("positive", "x > 0")
    def filtered_view():
        """Only good rows."""
        return verdicts

    assert filtered_view.__name__ == "filtered_view"
    assert filtered_view.__doc__ == "Only good rows."
    filtered_view()
    assert spark.sql("SELECT * FROM filtered_view").count() == 1


def test_expectation_above_view_does_not(spark, verdicts):
    @expect_all({"positive": "x > 0"})
    @temporary_view("unflagged")
    def step():
        return verdicts

    assert "is_quarantined" in step().columns
    assert spark.table("unflagged").columns == ["id", "x"]


def test_steps_take_arguments(verdicts):
    @expect_or_fail("few", "id <= 10")
    @expect_or_drop("above", "x > -100")
    def step(df, *, least):
        return df.filter(F.col("id") >= least)

    assert rows_of(step(verdicts, least=2)) == [(2, -5)]


def test_condition_on_text_flag_follows_ansi(spark):
    good = spark.createDataFrame([("true",), ("false",)], "is_assigned string")
    assert drop_failing(good, "is_assigned = True").count() == 1
    bad = spark.createDataFrame([("x",)], "is_assigned string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        drop_failing(bad, "is_assigned = True").collect()
