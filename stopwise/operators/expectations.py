"""Data-quality expectations on SQL predicates.

A predicate can be TRUE, FALSE or NULL for a row, and the modes differ on NULL: dropping
removes the row, flagging leaves the flag NULL unless another rule is FALSE, and failing
lets it pass.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

QUARANTINE_COLUMN = "is_quarantined"

# Fixed value: text of the error a failed expectation raises.
FAILURE_TEXT = "Expectation '{name}' failed: {count} rows do not meet the condition"

REPORT_SCHEMA = "name string, passed bigint, failed bigint, unknown bigint"


class ExpectationFailed(ValueError):
    pass


def drop_failing(
    df: DataFrame, condition: str, observation: Observation | None = None
) -> DataFrame:
    """Keep the rows for which ``condition`` is TRUE.

    An ``observation`` counts rows_in and rows_kept while the query runs. It stands between
    filter and scan, which ends predicate pushdown there, so it is off unless asked for.
    """
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(F.expr(condition)).alias("rows_kept"),
        )
    return df.filter(condition)


def flag_failing(
    df: DataFrame, rules: Mapping[str, str], null_is_failure: bool = False
) -> DataFrame:
    """Add ``is_quarantined``: TRUE where a rule is FALSE. No rules, no quarantine."""
    verdicts = [F.expr(rule) for rule in rules.values()]
    if null_is_failure:
        verdicts = [F.coalesce(verdict, F.lit(False)) for verdict in verdicts]
    if not verdicts:
        return df.withColumn(QUARANTINE_COLUMN, F.lit(False))
    failed = functools.reduce(operator.or_, [~verdict for verdict in verdicts])
    return df.withColumn(QUARANTINE_COLUMN, failed)


def violations(df: DataFrame, condition: str) -> DataFrame:
    """One row: how many rows have ``condition`` FALSE."""
    return df.filter(~F.expr(condition)).agg(F.count(F.lit(1)).alias("failing"))


def require(df: DataFrame, name: str, condition: str) -> DataFrame:
    """Return ``df``, or raise if any row has ``condition`` FALSE. Runs a job."""
    count = violations(df, condition).first().failing
    if count:
        raise ExpectationFailed(FAILURE_TEXT.format(name=name, count=count))
    return df


def failures(rules: Mapping[str, str]) -> list[Column]:
    """One count per rule, in order: the rows for which it is FALSE."""
    return [
        F.count_if(~F.expr(rule)).alias(f"failing_{position}")
        for position, rule in enumerate(rules.values())
    ]


def raise_on_failures(rules: Mapping[str, str], counts: Mapping[str, int]) -> None:
    """Raise if a count of ``failures`` is not 0; the text names every rule that failed."""
    broken = [
        FAILURE_TEXT.format(name=name, count=counts[f"failing_{position}"])
        for position, name in enumerate(rules)
        if counts[f"failing_{position}"]
    ]
    if broken:
        raise ExpectationFailed("; ".join(broken))


def require_all(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Return ``df``, or raise if any row has a rule FALSE. One pass however many rules."""
    if rules:
        raise_on_failures(rules, df.agg(*failures(rules)).first().asDict())
    return df


def expectation_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows passed, failed and unknown per rule, all rules in one pass."""
    if not rules:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counters = []
    for position, rule in enumerate(rules.values()):
        verdict = F.expr(rule)
        counters += [
            F.count_if(verdict).alias(f"passed_{position}"),
            F.count_if(~verdict).alias(f"failed_{position}"),
            F.count_if(verdict.isNull()).alias(f"unknown_{position}"),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("name"),
            *[F.col(f"{kind}_{position}").alias(kind) for kind in ("passed", "failed", "unknown")],
        )
        for position, name in enumerate(rules)
    ]
    return df.agg(*counters).select(F.inline(F.array(*lines)))
