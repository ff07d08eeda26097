"""Expectations of all three kinds in the one pass that writes a table, with a history of counts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stopwise.operators.expectations import ExpectationFailed, flag_failing
from stopwise.sinks.tables import write_table

HISTORY = (
    "run string, table string, rule string, kind string, condition string, rows long, "
    "passed long, failed long, unknown long"
)


def write_checked(
    df: DataFrame,
    path: str,
    history: str,
    *,
    drop: Mapping[str, str] | None = None,
    flag: Mapping[str, str] | None = None,
    fail: Mapping[str, str] | None = None,
    run: str | None = None,
    **options,
) -> DataFrame:
    """Write ``df`` to ``path`` under expectations (name -> condition) and return the table.

    Rows that do not meet every rule of ``drop`` go; the others get ``is_quarantined`` by the
    rules of ``flag``, if there are any; and if a rule of ``fail`` is FALSE for one of them nothing
    is written and the call raises. NULL counts as in the single expectations. ``drop`` is judged
    on all rows, the other two on the rows that are kept.

    All counts come from the job that writes, one scan in all, and are appended to the table
    ``history`` with the time, one row per rule, whether the write went through or was refused. ``options`` are those of
    ``write_table``; writes that are not staged are checked in a pass of their own.
    """
    if options.get("mode") == "ignore":
        raise ValueError("mode ignore may write nothing, and a write that is left out has no counts")
    named = {"drop": drop or {}, "flag": flag or {}, "fail": fail or {}}
    rules = [(kind, *rule) for kind, group in named.items() for rule in group.items()]
    every, kept = Observation(), Observation()
    counted = df.observe(every, *_counts(rules, dropping=True))
    for condition in named["drop"].values():
        counted = counted.filter(condition)
    counted = counted.observe(kept, *_counts(rules, dropping=False))
    if flag:
        counted = flag_failing(counted, flag)

    def record() -> None:
        # Only after a job that ended: one that died has no counts, and would be waited for.
        seen = {True: every.get, False: kept.get}
        rows = []
        for place, (kind, name, condition) in enumerate(rules):
            own = seen[kind == "drop"]
            verdicts = [own[f"{verdict}_{place}"] for verdict in ("passed", "failed", "unknown")]
            rows.append((run or tag, path, name, kind, condition, own["rows"], *verdicts))
        found = df.sparkSession.createDataFrame(rows, HISTORY)
        write_table(found.withColumn("checked_at", F.current_timestamp()), history, mode="append")

    tag = uuid.uuid4().hex
    try:
        stored = write_table(counted, path, checks=fail, **options)
    except ExpectationFailed:
        record()
        raise
    record()
    return stored


def _counts(rules: list[tuple[str, str, str]], dropping: bool) -> list[Column]:
    """All rows, and the verdicts of the rules of one side: those that drop, or the others."""
    counts = [F.count(F.lit(1)).alias("rows")]
    for place, (kind, _, condition) in enumerate(rules):
        if (kind == "drop") == dropping:
            verdict = F.expr(condition)
            counts += [
                F.count_if(verdict).alias(f"passed_{place}"),
                F.count_if(~verdict).alias(f"failed_{place}"),
                F.count_if(verdict.isNull()).alias(f"unknown_{place}"),
            ]
    return counts
