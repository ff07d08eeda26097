"""Declarative table pipelines and transit-schedule analytics on Spark DataFrames."""

from stopwise.config import Settings
from stopwise.plans.checked import write_checked
from stopwise.plans.decorators import (
    expect_all,
    expect_all_or_fail,
    expect_or_drop,
    expect_or_fail,
    table,
    temporary_view,
)
from stopwise.sinks.tables import replace_partitions, write_batch, write_table
from stopwise.sources.feeds import load_feed, load_feeds
from stopwise.sources.json_tree import read_json_tree, read_json_variants, with_fields
from stopwise.sources.tables import read_table

__all__ = [
    "Settings",
    "expect_all",
    "expect_all_or_fail",
    "expect_or_drop",
    "expect_or_fail",
    "load_feed",
    "load_feeds",
    "read_json_tree",
    "read_json_variants",
    "read_table",
    "replace_partitions",
    "table",
    "temporary_view",
    "with_fields",
    "write_batch",
    "write_checked",
    "write_table",
]
