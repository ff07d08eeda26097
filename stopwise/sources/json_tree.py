"""Recursive scan of a tree of JSON-lines files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def read_json_tree(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    malformed: str = "fail",
) -> DataFrame:
    """Read every JSON file below ``path``; ``key=value`` folder names add no columns.

    Without a ``schema`` Spark infers one, which is a job of its own over all the files, and
    lines that are no JSON stand in ``_corrupt_record``. For a large tree pass the schema. Such
    a line then ends the query, rather than become a row of NULLs that a later filter drops
    unseen; ``malformed="keep"`` adds ``_corrupt_record`` instead, and ``"null"`` allows the NULLs.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is None:
        return reader.json(path)
    if malformed not in ("fail", "keep", "null"):
        raise ValueError(f"malformed is fail, keep or null, not {malformed!r}")
    if malformed == "fail":
        reader = reader.option("mode", "FAILFAST")
    elif malformed == "keep":
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        if CORRUPT not in schema.names:
            schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)


def read_json_variants(
    spark: SparkSession, path: str | list[str], column: str = "raw", malformed: str = "fail"
) -> DataFrame:
    """Every line of every JSON file below ``path`` as one VARIANT, whatever fields it has.

    No schema is given or inferred, so one pass lands the rows and a field that turns up later
    needs no change to the table: ``with_fields`` reads it from the rows that have it. Blank lines
    are no rows. A line that is no JSON ends the query; ``malformed="keep"`` leaves its VARIANT
    NULL and adds the line as ``_corrupt_record``, ``"null"`` only does the former.
    """
    if malformed not in ("fail", "keep", "null"):
        raise ValueError(f"malformed is fail, keep or null, not {malformed!r}")
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.filter(F.trim("value") != "")
    parse = F.parse_json if malformed == "fail" else F.try_parse_json
    parsed = parse(F.col("value")).alias(column)
    if malformed != "keep":
        return lines.select(parsed)
    # Once parsed, the JSON value null is a VARIANT too; only a line that is no JSON is NULL.
    broken = F.when(F.try_parse_json(F.col("value")).isNull(), F.col("value"))
    return lines.select(parsed, broken.alias(CORRUPT))


def fields_in(df: DataFrame, column: str = "raw") -> str:
    """The fields that the VARIANTs of a table have and their types, merged over all rows; a field
    of several types that have none in common is VARIANT itself. One pass."""
    return df.agg(F.schema_of_variant_agg(column)).first()[0]


def with_fields(
    df: DataFrame, fields: Mapping[str, str], column: str = "raw", strict: bool = False
) -> DataFrame:
    """``df`` without the VARIANT column and with ``fields`` (name -> type) read from it.

    A name may be a path, as ``detail.text``; the column is then called ``detail_text``. A row
    that lacks a field has NULL; so has one whose value does not fit the type, unless ``strict``,
    where it ends the query.
    """
    get = F.variant_get if strict else F.try_variant_get
    others = [name for name in df.columns if name != column]
    read = [
        get(F.col(column), f"$.{name}", kind).alias(name.replace(".", "_"))
        for name, kind in fields.items()
    ]
    return df.select(*others, *read)
