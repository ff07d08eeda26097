"""Shared scratch folders for tables that exist only to feed the next step.

Every folder lies under ``spark.checkpoint.dir``, which all executors can reach, so a lost
executor never takes intermediate data with it. Only a ``local`` master, where driver and
executors share one disk, may fall back to a temporary folder of its own. Folders live as
long as the driver, or until ``release_scratch``.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from stopwise import storage

_handed_out: list[str] = []


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="stopwise-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    raise ValueError(
        "spark.checkpoint.dir is not set; point it at a folder all executors can reach"
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet. The folder itself is made by whoever writes to it."""
    path = f"{scratch_root(spark)}/stopwise-{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def release_scratch(spark: SparkSession, folders: Sequence[str] | None = None) -> None:
    """Delete scratch folders this process handed out: ``folders``, or all."""
    for folder in list(_handed_out if folders is None else folders):
        if folder in _handed_out:
            _handed_out.remove(folder)
            storage.delete(spark, folder)


def handed_out() -> tuple[str, ...]:
    """The scratch folders that are not yet released, in the order they were handed out."""
    return tuple(_handed_out)


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _handed_out:
        release_scratch(spark)
