"""File-system helpers over the Hadoop client Spark already carries.

Paths may be on any file system Spark can read (HDFS, object stores,
local). Only metadata and small texts travel through the driver; data is
always read by Spark tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

PROBE_THREADS = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def delete(spark: SparkSession, path: str) -> None:
    _, fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    jvm, fs, hsrc = _fs(spark, src)
    return bool(fs.rename(hsrc, jvm.org.apache.hadoop.fs.Path(dst)))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of everything in a directory; none if there is no such directory."""
    _, fs, hpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def modified(spark: SparkSession, path: str) -> float:
    """When a file was written, in seconds."""
    _, fs, hpath = _fs(spark, path)
    return fs.getFileStatus(hpath).getModificationTime() / 1000


def sizes(spark: SparkSession, paths: Iterable[str]) -> list[int]:
    """The bytes in each directory (few: a table's partitions)."""
    def size(path: str) -> int:
        _, fs, hpath = _fs(spark, path)
        return fs.getContentSummary(hpath).getLength()

    with ThreadPoolExecutor(max_workers=PROBE_THREADS) as pool:
        return list(pool.map(size, paths))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    jvm, fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file in place of another (one writer); a reader sees the old text or the new."""
    draft = _drafted(spark, path, text)
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        jvm.org.apache.hadoop.fs.Path(path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(draft), jvm.org.apache.hadoop.fs.Path(path), over)


def _drafted(spark: SparkSession, path: str, text: str) -> str:
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    _, fs, hpath = _fs(spark, draft)
    stream = fs.create(hpath, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return draft


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole or not at all; an error if the file is there already."""
    draft = _drafted(spark, path, text)
    if exists(spark, path) or not rename(spark, draft, path):
        delete(spark, draft)
        raise FileExistsError(f"{path} is there already: another job wrote this version")


def list_dirs(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the sub-directories of ``path`` starting with ``prefix``."""
    _, fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)
                  if s.isDirectory() and s.getPath().getName().startswith(prefix))


def list_files(spark: SparkSession, root: str, suffixes: Sequence[str]) -> list[str]:
    """Data files under ``root`` (recursive); hidden ``_``/``.`` entries skipped."""
    return sorted(stamps(spark, root, suffixes))


def stamps(spark: SparkSession, root: str, suffixes: Sequence[str]) -> dict[str, str]:
    """Data files under ``root``, each with its size and modification time."""
    _, fs, hpath = _fs(spark, root)
    if not fs.exists(hpath):
        return {}
    base = fs.makeQualified(hpath).toString()
    out = {}
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        status = it.next()
        p = status.getPath()
        rel = p.toString()[len(base):]
        if any(seg.startswith(("_", ".")) for seg in rel.split("/") if seg):
            continue
        if p.getName().endswith(tuple(suffixes)):
            out[p.toString()] = f"{status.getLen()}:{status.getModificationTime()}"
    return out
