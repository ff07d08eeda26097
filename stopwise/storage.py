"""The few file-system calls a table write needs, on whatever file system the path names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return target.getFileSystem(conf), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything matches ``path``, which may be a glob as in a scan."""
    fs, target = _resolve(spark, path)
    return bool(fs.globStatus(target))


def has_content(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a file, or a folder with anything in it that readers see: what a
    killed job left under ``_temporary`` is no content."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return False
    if fs.getFileStatus(target).isFile():
        return True
    return any(not name.startswith(("_", ".")) for name in names_in(spark, path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if it does not exist."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def folders_below(spark: SparkSession, root: str, file_uri: str) -> list[str]:
    """The folders between ``root`` and a file somewhere below it."""
    fs, target = _resolve(spark, root)
    top = fs.makeQualified(target).toUri().getPath().rstrip("/") + "/"
    jvm = spark._jvm
    whole = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file_uri)).toUri().getPath()
    return whole.removeprefix(top).split("/")[:-1] if whole.startswith(top) else []


def is_there(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of exactly this name."""
    fs, target = _resolve(spark, path)
    return bool(fs.exists(target))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, destination: str) -> None:
    fs, origin = _resolve(spark, source)
    if not fs.rename(origin, spark._jvm.org.apache.hadoop.fs.Path(destination)):
        raise OSError(f"could not rename {source} to {destination}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _resolve(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that does not exist yet; False, and nothing written, if it does.

    Of several writers one wins, and nobody sees the file before all of it is there: it is written
    under another name and linked (on a local disk) or renamed, neither of which replaces a file.
    """
    fs, target = _resolve(spark, path)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_stopwise_draft.{uuid.uuid4().hex}")
    write_text(spark, draft.toString(), text)
    try:
        if fs.getUri().getScheme() != "file":
            return bool(not fs.exists(target) and fs.rename(draft, target))
        here, there = (jvm.java.io.File(fs.makeQualified(f).toUri().getPath()) for f in (draft, target))
        jvm.java.nio.file.Files.createLink(there.toPath(), here.toPath())
        return True
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    finally:
        fs.delete(draft, False)


def _is_hidden(name: str) -> bool:
    """Whether a scan passes over a name; the folder of a partition column is never hidden."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths, relative to ``folder``, of the files in and below it that readers see, sorted."""
    fs, target = _resolve(spark, folder)
    if not fs.exists(target):
        return []
    top = fs.makeQualified(target).toUri().getPath().rstrip("/") + "/"
    found, files = [], fs.listFiles(target, True)
    while files.hasNext():
        name = files.next().getPath().toUri().getPath().removeprefix(top)
        if not any(_is_hidden(part) for part in name.split("/")):
            found.append(name)
    return sorted(found)


def move_files(spark: SparkSession, source: str, destination: str) -> None:
    """Move the data files below ``source`` to the same places below ``destination``. What an
    interrupted call left behind is moved by the next."""
    fs, origin = _resolve(spark, source)
    made = set()
    for name in data_files(spark, source):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{destination.rstrip('/')}/{name}")
        parent = name.rpartition("/")[0]
        if parent not in made:
            fs.mkdirs(place.getParent())
            made.add(parent)
        rename(spark, f"{source.rstrip('/')}/{name}", place.toString())


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of some data file at ``path`` (file, folder or glob); None without one.

    Read by the driver without a job, decompressed by the file's suffix as a scan would.
    """
    fs, target = _resolve(spark, path)
    target = _some_data_file(fs, fs.globStatus(target) or [])
    if target is None:
        return None
    jvm = spark._jvm
    stream = fs.open(target)
    try:
        codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf())
        codec = codecs.getCodec(target)
        text = jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, "UTF-8"
        )
        return jvm.java.io.BufferedReader(text).readLine()
    finally:
        stream.close()


def _some_data_file(fs, matches):
    for match in matches:
        files = fs.listFiles(match.getPath(), True)
        while files.hasNext():
            status = files.next()
            name = status.getPath().getName()
            if status.getLen() > 0 and not name.startswith(("_", ".")):
                return status.getPath()
    return None
