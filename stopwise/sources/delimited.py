"""Scan of delimited text by column name, with the file's own header checked."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from stopwise import storage

# Fixed value: first line of a large-file pointer left in place of the real content.
POINTER_PREFIX = "version https://git-lfs"


class HeaderError(ValueError):
    """The file does not carry the columns that were asked for."""


def read_header(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None
) -> list[str]:
    """Column names on the first line, of any one file if ``path`` is a folder, split and
    unquoted as the reader's ``options`` say."""
    line = storage.first_line(spark, path)
    if line is None:
        raise HeaderError(f"{path} is empty or not there")
    line = line.lstrip("\ufeff")
    if line.startswith(POINTER_PREFIX):
        raise HeaderError(f"{path} is a large-file pointer, not the data itself")
    said = {name.lower(): value for name, value in (options or {}).items()}
    separator = said.get("sep", said.get("delimiter", ","))
    quote = said.get("quote", '"')
    if len(separator) == 1:
        dialect = {"quotechar": quote} if quote else {"quoting": csv.QUOTE_NONE}
        return next(csv.reader([line], delimiter=separator, **dialect), [])
    return [name.strip(quote) if quote else name for name in line.split(separator)]


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read the columns of ``schema`` from the file or folder at ``path``, by name.

    The scan schema follows the order of the header, so columns may stand in any order and
    unknown ones are pruned by the reader. ``enforceSchema=false`` makes each task compare
    the header of its own file, so a folder with one odd file fails instead of shifting
    values into the wrong column. Types are declared, never inferred: ids keep their
    leading zeros, and only an empty field is NULL. A number that cannot be read is NULL
    too; ``options={"mode": "FAILFAST"}`` makes it an error.
    """
    header = read_header(spark, path, options)
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise HeaderError(f"{path} lacks {missing}; its header is {header}")
    declared = {field.name: field for field in schema.fields}
    in_file_order = StructType(
        [declared.get(name, StructField(name, StringType())) for name in header]
    )
    settings = {"header": "true", "enforceSchema": "false", "escape": '"', **(options or {})}
    return spark.read.schema(in_file_order).options(**settings).csv(path).select(*schema.names)
