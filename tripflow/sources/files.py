"""Listing of folders through the file system Spark itself uses (local, HDFS, object store)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def open_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = open_path(spark, path)
    return fs.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path; none when it does not exist."""
    fs, target = open_path(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in a folder, hidden ones left out; none when it does not exist."""
    fs, target = open_path(spark, path)
    if not fs.exists(target):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(target) if not s.isDirectory()]
    return sorted(n for n in found if n[:1] not in ("_", "."))


def names_of(spark: SparkSession, folders: list[str], threads: int = 16) -> dict[str, list[str]]:
    """Names of the files in each of these folders."""
    with ThreadPoolExecutor(threads) as pool:
        return dict(zip(folders, pool.map(lambda folder: names(spark, folder), folders)))


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, last change in milliseconds) of what matches a pattern, sorted."""
    fs, target = open_path(spark, pattern)
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(target) or [])


def times_of_glob(spark: SparkSession, pattern: str) -> dict[str, list[int]]:
    """Last changes of the files in each folder that matches a pattern."""
    fs, _ = open_path(spark, pattern)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return {path: [s.getModificationTime() for s in fs.listStatus(path_of(path))
                   if s.getPath().getName()[:1] not in ("_", ".")] for path, _ in glob(spark, pattern)}


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, target = open_path(spark, path)
    return fs.getContentSummary(target).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file."""
    fs, target = open_path(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small UTF-8 file; what was there is replaced."""
    fs, target = open_path(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, target = open_path(spark, path)
    fs.create(target, True).close()


def list_files(spark: SparkSession, root: str, ending: str) -> list[str]:
    """Full paths of all files below a root with this ending (any case), sorted; none when it does not exist.

    Folder by folder: a listing that goes down by itself also asks where each file lies and who may read it, which on a
    local disk starts a process for every file.
    """
    fs, target = open_path(spark, root)
    if not fs.exists(target):
        return []
    found, folders = [], [target]
    while folders:
        for status in fs.listStatus(folders.pop()):
            path = status.getPath()
            if status.isDirectory():
                folders.append(path)
                continue
            text = path.toString()
            if text.rpartition("/")[2].lower().endswith(ending):
                found.append(text)
    return sorted(found)


def files_in(spark: SparkSession, folders: list[str], ending: str, threads: int = 16) -> dict[str, list[str]]:
    """Full paths of the files directly in each folder that Spark's readers would see; none without the folder."""
    def names(folder: str) -> tuple[str, list[str]]:
        fs, target = open_path(spark, folder)
        found = [s.getPath().toString() for s in fs.listStatus(target)] if fs.exists(target) else []
        return folder, sorted(p for p in found if p.lower().endswith(ending) and p.rpartition("/")[2][:1] not in ("_", "."))

    with ThreadPoolExecutor(threads) as pool:
        return dict(pool.map(names, folders))


def tail(spark: SparkSession, path: str, size: int) -> bytes:
    """The last bytes of a file, read by a seek."""
    fs, target = open_path(spark, path)
    length = fs.getFileStatus(target).getLen()
    stream = fs.open(target)
    try:
        stream.seek(max(0, length - size))
        got = [stream.read() for _ in range(min(size, length))]
        return bytes(b for b in got if b >= 0)
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; none is no error."""
    fs, target = open_path(spark, path)
    fs.delete(target, True)
