"""Settings and limits that several operators share."""

from __future__ import annotations

import pytest
from llm_cases import documents  # noqa: F401

from stopwise.llm import substring_dedup
from stopwise.llm.text import ARROW_BATCH, in_bytes, small_batches_for


def test_sizes():
    sizes = {"5": 5, "8b": 8, "4m": 4 << 20, "4MB": 4 << 20, "1 g": 1 << 30, "2kb": 2048, "1t": 1 << 40}
    assert {text: in_bytes(text) for text in sizes} == sizes


@pytest.mark.parametrize("given, kept", [("4m", True), ("100k", True), ("64m", False)])
def test_a_smaller_batch_stays(spark, conf, given, kept):
    conf(ARROW_BATCH, given)
    small_batches_for(spark)
    assert spark.conf.get(ARROW_BATCH) == (given if kept else "8m")


def test_windows_that_the_index_cannot_tell_apart_are_refused(documents):
    for window in (0, 17):
        with pytest.raises(ValueError, match="windows"):
            substring_dedup.substring_dedup(documents([(1, "a b")]), window=window)
