"""Hadoop FileSystem helpers for metadata: listing folders, small marker files.

Everything here goes through the JVM's Hadoop ``FileSystem`` of the active
session, so the same code works for local paths, HDFS and object stores.
No row data passes through these helpers.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from fnmatch import fnmatchcase

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_CREATING = threading.Lock()


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    size: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _entry(status) -> Entry:
    p = status.getPath()
    return Entry(p.toString(), p.getName(), bool(status.isDirectory()), int(status.getLen()))


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def ls(spark: SparkSession, path: str) -> list[Entry]:
    """Children of ``path`` sorted by name; empty when the folder is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((_entry(s) for s in fs.listStatus(p)), key=lambda e: e.name)


def glob(spark: SparkSession, pattern: str) -> list[Entry]:
    """Hadoop glob (``*``, ``?``, ``[ab]``, ``{a,b}``) sorted by path."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    if found is None:
        return []
    return sorted((_entry(s) for s in found), key=lambda e: e.path)


def any_file(spark: SparkSession, folder: str, pattern: str) -> bool:
    """Whether a file named like ``pattern`` lies anywhere below ``folder``, in
    no hidden folder (``_`` or ``.``); the walk ends at the first one."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return False
    base, found = fs.makeQualified(p).toString(), fs.listFiles(p, True)
    while found.hasNext():
        below = found.next().getPath().toString()[len(base) :].strip("/").split("/")
        if fnmatchcase(below[-1], pattern) and not any(x.startswith(("_", ".")) for x in below):
            return True
    return False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a small UTF-8 file (commit records, markers)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, unless it exists; whether this call did.

    The text is written beside ``path`` and renamed without overwriting, which
    is atomic where the file system's rename is (HDFS).  The lock covers the
    threads of one application on file systems where it is not."""
    fs, p = _fs(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex[:12]}")
    write_text(spark, draft.toString(), text)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    with _CREATING:
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(p), options)
            return True
        except Py4JJavaError as e:
            if not e.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
                raise
            return False
        finally:
            fs.delete(draft, False)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form (``file:/…``, ``hdfs://…``) of ``path``."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()
