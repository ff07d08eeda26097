"""Locations a pipeline reads from and writes to, with environment defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# The environment variable that names the raw tree, and its default.
RAW_PATH_VARIABLE = "RAW_BASE_PATH"
RAW_PATH_DEFAULT = "/data/raw"

TABLE_BASE_VARIABLE = "TABLE_BASE_PATH"
TABLE_BASE_DEFAULT = "."


@dataclass(frozen=True)
class Settings:
    """Any path may be a URI that Spark can read (file, hdfs, s3a, abfs, ...)."""

    raw_path: str = field(
        default_factory=lambda: os.environ.get(RAW_PATH_VARIABLE, RAW_PATH_DEFAULT)
    )
    table_base: str = field(
        default_factory=lambda: os.environ.get(TABLE_BASE_VARIABLE, TABLE_BASE_DEFAULT)
    )
    table_format: str = "parquet"

    def table_path(self, name: str) -> str:
        return f"{self.table_base.rstrip('/')}/{name}"
