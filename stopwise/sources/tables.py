"""Scan of a table stored as a folder of files, and of temporary views."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from stopwise import storage

# Spark skips names that start with an underscore when it lists data files. A table has one
# such file from its first write, and one more from each append that added columns.
SCHEMA_FILE = "_stopwise_schema.json"
ADDED_SCHEMA = "_stopwise_schema."


class SchemaMismatch(ValueError):
    """The rows to be written do not fit the table."""


@dataclass(frozen=True)
class TableShape:
    """Declared columns of a folder table and the ones it is partitioned by."""

    schema: StructType
    partition_cols: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps(
            {"schema": self.schema.jsonValue(), "partition_cols": list(self.partition_cols)}
        )

    @classmethod
    def from_json(cls, text: str) -> TableShape:
        saved = json.loads(text)
        return cls(StructType.fromJson(saved["schema"]), tuple(saved["partition_cols"]))


def save_shape(spark: SparkSession, path: str, shape: TableShape, added: bool = False) -> str:
    """Declare the shape of a table; ``added`` leaves what others declared as it is. Returns the
    path of the declaration."""
    name = f"{ADDED_SCHEMA}{time.time_ns():020d}.{uuid.uuid4().hex}.json" if added else SCHEMA_FILE
    place = f"{path.rstrip('/')}/{name}"
    storage.write_text(spark, place, shape.to_json())
    return place


def claim_shape(spark: SparkSession, path: str, shape: TableShape) -> bool:
    """Declare the shape of a table that has none yet; False if another writer was first."""
    return storage.create_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", shape.to_json())


def saved_shape(spark: SparkSession, path: str) -> TableShape | None:
    """The declared shape of a table: that of its first write with the columns of all later
    ones, whichever of two writers came last."""
    folder = path.rstrip("/")
    names = [n for n in storage.names_in(spark, folder) if n.startswith(ADDED_SCHEMA)]
    if SCHEMA_FILE not in names:
        return None
    shapes = [
        TableShape.from_json(storage.read_text(spark, f"{folder}/{name}"))
        for name in sorted(names, key=lambda name: (name != SCHEMA_FILE, name))
    ]
    schema = shapes[0].schema
    for shape in shapes[1:]:
        schema = merged_type(schema, shape.schema, name_folding(spark))
    return TableShape(schema, shapes[0].partition_cols)


def name_folding(spark: SparkSession) -> Callable[[str], str]:
    """What two names must share to be one column's, by the session's case sensitivity."""
    sensitive = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return str if sensitive else str.lower


def same_type(one: DataType, other: DataType) -> bool:
    """Equal but for nullability."""
    return one.simpleString() == other.simpleString()


def merged_type(
    old: DataType, new: DataType, fold: Callable[[str], str], name: str = "row"
) -> DataType:
    """The old type with whatever fields the new one adds, at any depth."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        fields = []
        arriving = {fold(field.name): field for field in new.fields}
        for field in old.fields:
            match = arriving.pop(fold(field.name), None)
            kind = field.dataType
            if match:
                kind = merged_type(kind, match.dataType, fold, f"{name}.{field.name}")
            fields.append(StructField(field.name, kind, metadata=field.metadata))
        added = [StructField(f.name, f.dataType, metadata=f.metadata) for f in arriving.values()]
        return StructType([*fields, *added])
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merged_type(old.elementType, new.elementType, fold, f"{name}[]"))
    if isinstance(old, MapType) and isinstance(new, MapType) and same_type(old.keyType, new.keyType):
        return MapType(old.keyType, merged_type(old.valueType, new.valueType, fold, f"{name}[]"))
    if not same_type(old, new):
        raise SchemaMismatch(
            f"column {name.removeprefix('row.')} is {old.simpleString()} in the table but "
            f"{new.simpleString()} in the new rows"
        )
    return old


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """Load a table by path.

    A table written by this library carries its schema in a small file next to the data.
    Using it spares the pass over all file footers that ``mergeSchema`` costs, and keeps
    partition columns from being re-typed (text ``007`` would come back as 7). A folder
    from elsewhere is read with ``mergeSchema``. Columns that other programs add to a table
    of this library show when ``schema`` names them.
    """
    if fmt == "delta":
        return spark.read.format(fmt).load(path)
    if schema is None:
        shape = saved_shape(spark, path)
        schema = shape.schema if shape else None
    if schema is None:
        return spark.read.format(fmt).option("mergeSchema", "true").load(path)
    return spark.read.format(fmt).schema(schema).load(path).select(*map(quoted, schema.names))


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
