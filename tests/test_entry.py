"""The entry points with and without the optional text package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
CODE = """
import sys
{}
sys.path.insert(0, {!r})
import __spark_entry__ as entry
names = entry.queries()
assert "bronze_silver" in names and set(entry.oracle_sql()) <= set(names)
assert not any(name.startswith("op") for name in names)
"""


@pytest.mark.parametrize(
    "lacking", ["sys.modules['zstandard'] = None", "sys.modules['stopwise.llm.queries'] = None"]
)
def test_queries_without_the_text_package(lacking):
    subprocess.run([sys.executable, "-c", CODE.format(lacking, ROOT)], check=True, timeout=120)
