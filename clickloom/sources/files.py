"""Folder listings through the file system that Spark itself uses (local, HDFS, object store)."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=4)
def _path_class(jvm):
    return jvm.org.apache.hadoop.fs.Path


def _path(spark: SparkSession, path: str):
    return _path_class(spark._jvm)(path)


@lru_cache(maxsize=16)
def _file_system(jvm, configuration, root: str):
    return jvm.org.apache.hadoop.fs.Path(root or "/").getFileSystem(configuration)


def _at(spark: SparkSession, path: str):
    """The file system of a path, which is that of its scheme and authority, and the path."""
    root = "/".join([*path.split("/")[:3], ""]) if "://" in path else f"{path.split(':/')[0]}:/" if ":/" in path else ""
    return _file_system(spark._jvm, spark._jsc.hadoopConfiguration(), root), _path(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _at(spark, path)
    return fs.exists(location)


#: What the text of a file's status tells, as one call gives that of a whole folder.
STATUS = re.compile(r"FileStatus\{path=(?P<path>[^;]*); isDirectory=\w+;.*?modification_time=(?P<stamp>\d+);")


def stamps(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names of the entries of one folder and when each was last changed, by the file system's clock in milliseconds; a
    folder that cannot be listed is an error."""
    fs, location = _at(spark, folder)
    found = fs.listStatus(location)
    told = STATUS.findall(spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found).mkString("\n"))
    if len(told) != len(found):  # odd names: one by one
        told = [(status.getPath().toString(), status.getModificationTime()) for status in found]
    return {path.rsplit("/", 1)[-1]: int(stamp) for path, stamp in sorted(told)}


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of one folder."""
    return list(stamps(spark, folder))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, location = _at(spark, path)
    fs.mkdirs(location)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all."""
    fs, location = _at(spark, path)
    whole = _path(spark, f"{path}.part")
    out = fs.create(whole, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(whole, location):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, location = _at(spark, path)
    source = fs.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or a folder; it is fine if that was done before. A folder that is there already gets the files."""
    fs, new = _at(spark, target)
    old = _path(spark, source)
    there, waiting = fs.exists(new), fs.exists(old)
    if waiting and there and fs.getFileStatus(old).isDirectory():
        for name in names(spark, source):
            move(spark, f"{source}/{name}", f"{target}/{name}")
        return
    if waiting and not there:
        if fs.rename(old, new):
            return
        fs.mkdirs(new.getParent())
        if fs.rename(old, new):
            return
    if not fs.exists(new):
        raise OSError(f"cannot move {source} to {target}")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path``."""
    fs, location = _at(spark, path)
    return fs.getContentSummary(location).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all that is in it; nothing happens if it is not there."""
    fs, location = _at(spark, path)
    fs.delete(location, True)


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; whoever lists the folder finds one or the other."""
    fs, location = _at(spark, path)
    old = _path(spark, f"{path}.old")
    fs.delete(old, True)
    if fs.exists(location) and not fs.rename(location, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(_path(spark, new), location):
        raise OSError(f"cannot move {new} to {path}")
    fs.delete(old, True)
