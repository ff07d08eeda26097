"""Writes of folder tables: save mode, partitioning, schema evolution or replacement.

With ``fmt="delta"`` the options of that writer are passed through. For plain file formats
the same rules are applied here: an evolving write keeps the table's old columns (as typed
NULLs where the new rows lack them) and adds the new ones; a changed type is an error.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from stopwise import storage
from stopwise.operators.expectations import failures, raise_on_failures, require_all
from stopwise.sources.tables import (
    SchemaMismatch,
    TableShape,
    claim_shape,
    merged_type,
    name_folding,
    quoted,
    read_table,
    same_type,
    save_shape,
    saved_shape,
)

log = logging.getLogger(__name__)

SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")
STREAM_LOG = "_spark_metadata"
# Folders and files in a table that readers do not see: rows on their way in, partitions on their
# way in and out, and the last batch of each stream.
ADDING = "_stopwise_adding."
REPLACING = "_stopwise_replacing."
RETIRED = "_stopwise_retired."
BATCH_DONE = "_stopwise_batch."
# Marks a folder whose rows are all there and may be moved in.
COMPLETE = "_stopwise_complete"

__all__ = [
    "SAVE_MODES",
    "SchemaMismatch",
    "batch_done",
    "finish_replacing",
    "replace_partitions",
    "write_batch",
    "write_table",
]


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_cols: Sequence[str] = (),
    merge_schema: bool = True,
    replace_schema: bool = False,
    fmt: str = "parquet",
    rebalance: bool = True,
    sort_cols: Sequence[str] = (),
    staged: bool = True,
    checks: Mapping[str, str] | None = None,
    _tag: str | None = None,
) -> DataFrame:
    """Write ``df`` to ``path`` and return the stored table.

    * ``replace_schema`` (overwrite only) forgets the old columns.
    * ``rebalance`` shuffles a partitioned write by its partition columns, so each value
      gets few files rather than one per task. AQE cuts a hot value into several writers
      and joins small ones. Turn it off for input that is already clustered.
    * ``sort_cols`` orders the rows of each file, so that a filter on them skips row groups.
    * An overwrite of a table that exists is written next to it and swapped in when
      complete: a failed job leaves the old rows in place, and the query may read the very
      table it replaces. The swap is two renames. Where a rename copies the data (object
      stores) use ``fmt="delta"``, or ``staged=False`` to write in place without that safety.
      A swap that was interrupted is undone by the next write.
    * An append is staged too, in a hidden folder of the table, and its files are then moved in
      one by one. ``staged=False`` has the job write straight into the table.
    * ``checks`` (name -> condition) must not be FALSE for any row. Rows that are staged are
      counted as they are written, and swapped or moved in only if all is well; other writes
      are preceded by one pass that counts all rules.

    Staged appends may run side by side, those that add columns and those that make the table
    too: whoever declares its schema first made it, the others add to it. An overwrite must be
    the only writer of its table. A folder that another program's stream writes carries a log of
    its files and shows no others, so an append to it, which would be invisible, raises.
    """
    spark = df.sparkSession
    if fmt == "delta":
        if checks:
            require_all(df, checks)
        df = _arranged(df, tuple(partition_cols), rebalance, sort_cols)
        _write_delta(df, path, mode, partition_cols, merge_schema, replace_schema)
        return read_table(spark, path, fmt)

    mode = mode.lower()
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    _undo_interrupted_swap(spark, path)
    present = storage.has_content(spark, path) or saved_shape(spark, path) is not None
    if present and mode == "ignore":
        return read_table(spark, path, fmt)
    if present and mode.startswith("error"):
        raise FileExistsError(f"{path} already exists")

    old = _shape_of(spark, path, fmt) if present else None
    if old is None or (replace_schema and mode == "overwrite"):
        shape = TableShape(df.schema, tuple(partition_cols))
        rows = df
    else:
        fold = name_folding(spark)
        shape = _evolve(old, df.schema, tuple(partition_cols), mode, merge_schema, fold)
        rows = _align(df, shape.schema, fold)

    rows = _arranged(rows, shape.partition_cols, rebalance, sort_cols)
    adds = mode != "overwrite"
    if (adds or not staged) and storage.exists(spark, f"{_folder(path)}/{STREAM_LOG}"):
        raise ValueError(f"{path} is written by a stream; what a batch adds would not be read")
    if checks and not staged:
        require_all(df, checks)
    if adds:
        folder = f"{_folder(path)}/{ADDING}{_tag or uuid.uuid4().hex}"
        if staged:
            _stage(rows, folder, shape, fmt, checks or {})
        try:
            declared = _declare(spark, path, shape, present)
        except BaseException:
            storage.delete(spark, folder)
            raise
        if not declared:
            # Another writer has made the table since it was looked for.
            storage.delete(spark, folder)
            return write_table(
                df, path, mode=mode, partition_cols=partition_cols, merge_schema=merge_schema,
                fmt=fmt, rebalance=rebalance, sort_cols=sort_cols, staged=staged, checks=checks,
                _tag=_tag,
            )
        if staged:
            storage.write_text(spark, f"{folder}/{COMPLETE}", "")
            storage.move_files(spark, folder, path)
            if _tag is None:
                storage.delete(spark, folder)
        else:
            _save(rows, path, "append", shape, fmt)
    elif staged and (present or checks):
        _replace(spark, rows, path, shape, fmt, checks or {})
    else:
        _save(rows, path, "overwrite", shape, fmt)
        save_shape(spark, path, shape)
    spark.catalog.refreshByPath(path)
    return read_table(spark, path, fmt, shape.schema)


def _declare(spark: SparkSession, path: str, shape: TableShape, present: bool) -> bool:
    """Make the shape of rows known before they land, so that older files read as NULL in new
    columns. False if the table was to be new and another writer has made it."""
    if not present:
        return claim_shape(spark, path, shape)
    known = saved_shape(spark, path)
    if known == shape or (known is None and claim_shape(spark, path, shape)):
        return True
    added = save_shape(spark, path, shape, added=True)
    try:
        saved_shape(spark, path)
    except SchemaMismatch:
        # Another writer has added a column of the same name and another type.
        storage.delete(spark, added)
        raise
    return True


def write_batch(
    df: DataFrame, path: str, stream: str, number: int, *, fmt: str = "parquet", **options
) -> bool:
    """Append batch ``number`` of ``stream`` to a table, once: False if that was done before.

    Numbers of a stream ascend, and only its last one is kept. Batches and the appends of
    ``write_table`` (whose ``options`` these are) may share a table. A batch that died while its
    files were moved in is finished by its next attempt, and not written again. A Delta table keeps
    such numbers in its own log (``txnAppId``, ``txnVersion``), where a repeated batch is left out
    unseen, and the call is always True.
    """
    spark = df.sparkSession
    if fmt == "delta":
        writer = df.write.format(fmt).mode("append").option("mergeSchema", "true")
        writer = writer.partitionBy(*options.get("partition_cols", ()))
        writer.option("txnAppId", stream).option("txnVersion", number).save(path)
        return True
    if batch_done(spark, path, stream, number):
        return False
    mark = _mark(stream, number)
    tag = mark.removeprefix(BATCH_DONE)
    staged = f"{_folder(path)}/{ADDING}{tag}"
    if storage.is_there(spark, f"{staged}/{COMPLETE}"):
        storage.move_files(spark, staged, path)
    else:
        storage.delete(spark, staged)
        write_table(df, path, mode="append", fmt=fmt, _tag=tag, **options)
    _set_mark(spark, path, mark)
    storage.delete(spark, staged)
    return True


def _mark(stream: str, number: int) -> str:
    if not stream.replace("-", "").isalnum():
        raise ValueError(f"the name of a stream has letters, digits and hyphens, not {stream!r}")
    return f"{BATCH_DONE}{stream}.{number:020d}"


def _marks(spark: SparkSession, path: str, stream: str) -> list[str]:
    first = _mark(stream, 0).rpartition(".")[0] + "."
    return [name for name in storage.names_in(spark, _folder(path)) if name.startswith(first)]


def _set_mark(spark: SparkSession, path: str, mark: str) -> None:
    """Record a batch as done, in place of those of its stream before it."""
    storage.write_text(spark, f"{_folder(path)}/{mark}", "")
    for name in _marks(spark, path, mark.removeprefix(BATCH_DONE).rpartition(".")[0]):
        if name < mark:
            storage.delete(spark, f"{_folder(path)}/{name}")


def batch_done(spark: SparkSession, path: str, stream: str, number: int) -> bool:
    """Whether a table has batch ``number`` of ``stream``, or a later one."""
    return any(name >= _mark(stream, number) for name in _marks(spark, path, stream))


def replace_partitions(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    sort_cols: Sequence[str] = (),
    checks: Mapping[str, str] | None = None,
    once: tuple[str, int] | None = None,
) -> DataFrame:
    """Replace the partitions of a table that ``df`` has rows of; files of others are not touched.

    ``df`` has the table's columns, and may be a query over the table itself. Its rows are staged
    in the table and the partitions swapped one by one, two renames each, so a reader may see some
    old and some new. A swap that was interrupted is finished by the next call. It must be the only
    writer of its table. With ``once``, a stream and a batch number as in ``write_batch``, a batch
    that the table has is not applied again.
    """
    spark = df.sparkSession
    finish_replacing(spark, path)
    if once and batch_done(spark, path, *once):
        return read_table(spark, path, fmt)
    shape = saved_shape(spark, path)
    if shape is None or not shape.partition_cols:
        raise ValueError(f"{path} is not a partitioned table of this library")
    fold = name_folding(spark)
    if not same_type(merged_type(shape.schema, df.schema, fold), shape.schema):
        raise SchemaMismatch(f"the rows have columns that {path} lacks")
    df = _arranged(_align(df, shape.schema, fold), shape.partition_cols, True, sort_cols)
    staged = f"{_folder(path)}/{REPLACING}{uuid.uuid4().hex}"
    _stage(df, staged, shape, fmt, checks or {})
    if once:
        storage.write_text(spark, f"{staged}/{_mark(*once)}", "")
    storage.write_text(spark, f"{staged}/{COMPLETE}", "")
    finish_replacing(spark, path)
    spark.catalog.refreshByPath(path)
    return read_table(spark, path, fmt, shape.schema)


def finish_replacing(spark: SparkSession, path: str) -> None:
    """Finish a replacement that was interrupted: swap in the partitions that are staged in full,
    drop those that are not."""
    folder = _folder(path)
    for name in storage.names_in(spark, folder):
        if not name.startswith(REPLACING):
            continue
        staged = f"{folder}/{name}"
        retired = f"{folder}/{RETIRED}{name.removeprefix(REPLACING)}"
        if storage.is_there(spark, f"{staged}/{COMPLETE}"):
            parts = {file.rpartition("/")[0] for file in storage.data_files(spark, staged)}
            for part in sorted(parts):
                if storage.is_there(spark, f"{folder}/{part}"):
                    storage.make_folder(spark, f"{retired}/{part}".rpartition("/")[0])
                    storage.rename(spark, f"{folder}/{part}", f"{retired}/{part}")
                storage.make_folder(spark, f"{folder}/{part}".rpartition("/")[0])
                storage.rename(spark, f"{staged}/{part}", f"{folder}/{part}")
            for mark in storage.names_in(spark, staged):
                if mark.startswith(BATCH_DONE):
                    _set_mark(spark, path, mark)
        storage.delete(spark, retired)
        storage.delete(spark, staged)


def _folder(path: str) -> str:
    return path.rstrip("/")


def _arranged(
    df: DataFrame, partition_cols: tuple[str, ...], rebalance: bool, sort_cols: Sequence[str]
) -> DataFrame:
    if partition_cols and rebalance:
        df = df.hint("rebalance", *[F.col(quoted(name)) for name in partition_cols])
    if sort_cols:
        # Partition columns first: the order the writer asks for, so it does not sort again.
        order = [*partition_cols, *sort_cols]
        df = df.sortWithinPartitions(*[F.col(quoted(name)) for name in order])
    return df


def _save(df: DataFrame, path: str, mode: str, shape: TableShape, fmt: str) -> None:
    # An overwrite replaces the whole table, whatever the session says about partitions.
    writer = df.write.format(fmt).mode(mode).option("partitionOverwriteMode", "static")
    if shape.partition_cols:
        writer = writer.partitionBy(*shape.partition_cols)
    writer.save(path)


def _stage(
    df: DataFrame, staged: str, shape: TableShape, fmt: str, checks: Mapping[str, str]
) -> None:
    """Write ``df`` to a new folder, or nothing if it fails a check. Jobs that write to one folder
    share a place in it for unfinished files, which the first to end deletes; so each has its own."""
    try:
        if checks:
            seen = Observation()
            _save(df.observe(seen, *failures(checks)), staged, "errorifexists", shape, fmt)
            raise_on_failures(checks, seen.get)
        else:
            _save(df, staged, "errorifexists", shape, fmt)
    except BaseException:
        storage.delete(df.sparkSession, staged)
        raise


def _replace(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    shape: TableShape,
    fmt: str,
    checks: Mapping[str, str],
) -> None:
    tag = uuid.uuid4().hex
    staged = f"{path.rstrip('/')}__new_{tag}"
    retired = f"{path.rstrip('/')}__old_{tag}"
    _stage(df, staged, shape, fmt, checks)
    save_shape(spark, staged, shape)
    there = storage.exists(spark, path)
    if there:
        storage.rename(spark, path, retired)
    try:
        storage.rename(spark, staged, path)
    except BaseException:
        if there and not storage.exists(spark, path):
            storage.rename(spark, retired, path)
        raise
    if there:
        storage.delete(spark, retired)


def _undo_interrupted_swap(spark: SparkSession, path: str) -> None:
    """Put back the rows that a swap had moved aside when its driver died."""
    folder = path.rstrip("/")
    if storage.exists(spark, folder):
        return
    parent, _, name = folder.rpartition("/")
    aside = [n for n in storage.names_in(spark, parent or ".") if n.startswith(f"{name}__old_")]
    if len(aside) > 1:
        raise ValueError(f"{path} is not there, but {aside} are: more than one swap was interrupted")
    if aside:
        log.warning("table %s: restored from %s, left by an interrupted write", path, aside[0])
        storage.rename(spark, f"{parent}/{aside[0]}" if parent else aside[0], folder)


def _write_delta(df, path, mode, partition_cols, merge_schema, replace_schema) -> None:
    writer = df.write.format("delta").mode(mode)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    elif merge_schema:
        writer = writer.option("mergeSchema", "true")
    writer.save(path)


def _shape_of(spark: SparkSession, path: str, fmt: str) -> TableShape:
    """Shape of a stored table; a folder of other origin is asked for its own."""
    shape = saved_shape(spark, path)
    if shape is None:
        found = read_table(spark, path, fmt)
        shape = TableShape(found.schema, _partition_cols(found, path))
    return shape


def _partition_cols(df: DataFrame, path: str) -> tuple[str, ...]:
    """Columns that stand as ``name=value`` folders between ``path`` and a file of ``df``."""
    some_file = df.select("_metadata.file_path").first()
    if some_file is None:
        return ()
    folders = storage.folders_below(df.sparkSession, path, some_file.file_path)
    names = [folder.partition("=")[0] for folder in folders if "=" in folder]
    return tuple(name for name in names if name in df.columns)


def _evolve(
    old: TableShape,
    incoming: StructType,
    partition_cols: tuple[str, ...],
    mode: str,
    merge_schema: bool,
    fold: Callable[[str], str],
) -> TableShape:
    if mode == "append" and partition_cols and partition_cols != old.partition_cols:
        raise SchemaMismatch(
            f"table is partitioned by {list(old.partition_cols)}, not {list(partition_cols)}"
        )
    merged = merged_type(old.schema, incoming, fold)
    if not merge_schema and not same_type(merged, old.schema):
        raise SchemaMismatch(
            f"merge_schema is off and the new rows would change the table from "
            f"{old.schema.simpleString()} to {merged.simpleString()}"
        )
    return TableShape(merged, partition_cols or old.partition_cols)


def _align(df: DataFrame, schema: StructType, fold: Callable[[str], str]) -> DataFrame:
    """Give ``df`` the columns of ``schema``; what it lacks is NULL of the right type."""
    have = {fold(field.name): field for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        match = have.get(fold(field.name))
        column = F.lit(None).cast(field.dataType)
        if match is not None:
            column = _fit(F.col(quoted(match.name)), match.dataType, field.dataType, fold)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _fit(value: Column, have: DataType, want: DataType, fold: Callable[[str], str]) -> Column:
    if same_type(have, want):
        return value
    if isinstance(want, ArrayType):
        return F.transform(
            value, lambda item: _fit(item, have.elementType, want.elementType, fold)
        )
    if isinstance(want, MapType):
        return F.transform_values(
            value, lambda _, item: _fit(item, have.valueType, want.valueType, fold)
        )
    inner = {fold(field.name): field for field in have.fields}
    parts = []
    for field in want.fields:
        match = inner.get(fold(field.name))
        part = F.lit(None).cast(field.dataType)
        if match is not None:
            part = _fit(value.getField(match.name), match.dataType, field.dataType, fold)
        parts.append(part.alias(field.name))
    return F.when(value.isNotNull(), F.struct(*parts))
