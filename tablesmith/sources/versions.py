"""Published tables that readers never see half written, and numbers that are given out once.

A published table is a folder with one subfolder per version and a pointer file that names the current one. A version
is written in full before the pointer is replaced, by one rename of the file system; a job that is lost midway leaves
the old pointer and the old version. Numbers are claimed by creating a marker file that must not exist: of several
jobs that try the same number one succeeds, the others go on to the next.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join([parts[0].rstrip("/"), *parts[1:]]))


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path, text: str) -> None:
    out = _files(spark, path).create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _replace(spark: SparkSession, source, target) -> None:
    """Rename ``source`` over ``target`` in one step of the file system."""
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(source), context.makeQualified(target), options)


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the published version; None if there is none yet."""
    pointer = _path(spark, root, POINTER)
    if not _files(spark, pointer).exists(pointer):
        return None
    lines = spark._jvm.org.apache.commons.io.IOUtils.toString(_files(spark, pointer).open(pointer), "UTF-8")
    return f"{root.rstrip('/')}/{lines.strip()}"


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The table as last published; an error if nothing was."""
    found = current_version(spark, root)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.parquet(found)


def publish(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write ``df`` as a new version of ``root``, then make it the current one; returns its path.

    Versions before the last ``keep`` are removed, so that readers of the one before the current can finish. If the
    write fails nothing changes for readers; what it left behind is removed by the next publish.
    """
    if keep < 1:
        raise ValueError("the current version can't be removed")
    spark = df.sparkSession
    before = current_version(spark, root)
    name = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{root.rstrip('/')}/{name}")
    draft = _path(spark, root, f".{name}")
    _write_text(spark, draft, name)
    _replace(spark, draft, _path(spark, root, POINTER))
    folder = _path(spark, root)
    files = _files(spark, folder)
    found = [(s.getModificationTime(), s.getPath().getName()) for s in files.listStatus(folder)
             if s.getPath().getName().startswith("version-")]
    kept = [name] + ([before.rsplit("/", 1)[1]] if before else [])
    rest = [n for _, n in sorted(found, reverse=True) if n not in kept]
    for old in (kept[:keep] + rest)[keep:]:
        files.delete(_path(spark, root, old), True)
    return f"{root.rstrip('/')}/{name}"


def create_exclusive(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Atomic on local disks and wherever the file system's own
    create is (the name node's, a store's conditional put)."""
    target = _path(spark, path)
    files = _files(spark, target)
    files.mkdirs(target.getParent())
    jvm = spark._jvm
    try:
        if files.makeQualified(target).toUri().getScheme() == "file":
            none = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(target.toUri().getPath()).toPath(), none)
        else:
            files.create(target, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def claim_number(spark: SparkSession, folder: str, at_least: int = 1) -> int:
    """A number that no other caller gets: one above the highest marker in ``folder``, and not below ``at_least``;
    the next one, if another job claims it meanwhile."""
    path = _path(spark, folder)
    files = _files(spark, path)
    taken = [int(m.group(1)) for s in (files.listStatus(path) if files.exists(path) else [])
             if (m := re.fullmatch(r"number-(\d+)", s.getPath().getName()))]
    number = max([at_least, *(n + 1 for n in taken)])
    while not create_exclusive(spark, f"{folder.rstrip('/')}/number-{number}"):
        number += 1
    return number
