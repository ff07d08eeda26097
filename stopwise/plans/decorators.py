"""Decorators for functions that return a DataFrame.

They run when the function is called and apply from the inside out, so a table or view holds
what the decorators *below* it produced. Put expectations innermost: ``expect_or_fail``
above ``table`` checks rows that are already written.
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation

from stopwise.config import Settings
from stopwise.operators.expectations import drop_failing, flag_failing, require, require_all
from stopwise.sinks.tables import write_table
from stopwise.sinks.views import register_view

log = logging.getLogger(__name__)

Step = Callable[..., DataFrame]


def _followed_by(action: Callable[[DataFrame, str], DataFrame]) -> Callable[[Step], Step]:
    """A decorator that hands a step's result, and the step's name, to ``action``."""

    def decorate(step: Step) -> Step:
        return functools.wraps(step)(
            lambda *args, **kwargs: action(step(*args, **kwargs), step.__name__)
        )

    return decorate


def table(
    name: str,
    partition_cols: Sequence[str] | None = None,
    path: str | None = None,
    mode: str = "overwrite",
    merge_schema: bool = True,
    *,
    fmt: str | None = None,
    return_source: bool = False,
    settings: Settings | None = None,
    checks: Mapping[str, str] | None = None,
) -> Callable[[Step], Step]:
    """Write the step's rows to a table, ``<table base>/<name>`` unless ``path`` is given.

    The step then returns the stored table: later actions read what was written instead of
    running the source again, and load times stay the ones that were stored.
    ``return_source`` returns the step's own lazy frame instead. ``checks`` (name -> condition)
    are counted while an overwrite is staged; if any fails, the old table stays.
    """

    def store(df: DataFrame, _: str) -> DataFrame:
        config = settings or Settings()
        target = path or config.table_path(name)
        stored = write_table(
            df,
            target,
            mode=mode,
            partition_cols=partition_cols or (),
            merge_schema=merge_schema,
            fmt=fmt or config.table_format,
            checks=checks,
        )
        log.info("table %s: mode %s, merge_schema %s, at %s", name, mode, merge_schema, target)
        return df if return_source else stored

    return _followed_by(store)


def temporary_view(name: str | None = None) -> Callable[[Step], Step]:
    """Register the step's frame as a view, named like the function unless ``name`` is given."""

    def publish(df: DataFrame, step_name: str) -> DataFrame:
        log.info("view %s registered", name or step_name)
        return register_view(df, name or step_name)

    return _followed_by(publish)


def expect_or_drop(
    expectation_name: str, condition: str, observation: Observation | None = None
) -> Callable[[Step], Step]:
    """Drop the rows for which ``condition`` is not TRUE.

    An ``observation`` counts them for one call of the step; Spark lets it serve no second.
    """

    def keep(df: DataFrame, _: str) -> DataFrame:
        log.info("expectation %s: rows that fail are dropped", expectation_name)
        return drop_failing(df, condition, observation)

    return _followed_by(keep)


def expect_all(
    rules: Mapping[str, str], null_is_failure: bool = False
) -> Callable[[Step], Step]:
    """Flag the rows that break any rule in ``is_quarantined``; none is dropped."""

    def flag(df: DataFrame, _: str) -> DataFrame:
        log.info("expectations %s: rows that fail are flagged", list(rules))
        return flag_failing(df, rules, null_is_failure)

    return _followed_by(flag)


def expect_or_fail(expectation_name: str, condition: str) -> Callable[[Step], Step]:
    """Raise if ``condition`` is FALSE for any row; counts the rows when the step is called."""

    def check(df: DataFrame, _: str) -> DataFrame:
        checked = require(df, expectation_name, condition)
        log.info("expectation %s: every row meets it", expectation_name)
        return checked

    return _followed_by(check)


def expect_all_or_fail(rules: Mapping[str, str]) -> Callable[[Step], Step]:
    """Raise if any rule is FALSE for any row. All rules are counted in one pass, where as many
    stacked ``expect_or_fail`` would take a pass each."""

    def check(df: DataFrame, _: str) -> DataFrame:
        checked = require_all(df, rules)
        log.info("expectations %s: every row meets them", list(rules))
        return checked

    return _followed_by(check)
