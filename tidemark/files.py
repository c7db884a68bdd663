"""Folders on whatever file system the cluster shares."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    hadoop, fs = _path(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in (fs.globStatus(hadoop) or []))


def read_text(spark: SparkSession, path: str) -> str:
    hadoop, fs = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    hadoop, fs = _path(spark, path)
    stream = fs.create(hadoop, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    hadoop, fs = _path(spark, path)
    return fs.getContentSummary(hadoop).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this job has made."""
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def list_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of all files below ``root``, relative to it."""
    hadoop, fs = _path(spark, root)
    base = str(fs.getFileStatus(hadoop).getPath().toUri().getPath()).rstrip("/") + "/"
    found, entries = [], fs.listFiles(hadoop, True)
    while entries.hasNext():
        found.append(str(entries.next().getPath().toUri().getPath()).removeprefix(base))
    return sorted(found)


def qualified(spark: SparkSession, path: str) -> str:
    hadoop, fs = _path(spark, path)
    return str(fs.makeQualified(hadoop).toString())


def copy_tree(spark: SparkSession, source: str, target: str, keep: Callable[[str], bool] = lambda p: True) -> int:
    """Copy a folder with the executors; the driver only lists names. Returns the number of files."""
    names = [n for n in list_files(spark, source) if keep(n)]
    if not names:
        return 0
    source, target = qualified(spark, source), qualified(spark, target)

    def copy(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for chunk in chunks:
            for name in chunk["name"]:
                from_fs, from_path = fs.FileSystem.from_uri(f"{source}/{name}")
                to_fs, to_path = fs.FileSystem.from_uri(f"{target}/{name}")
                to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
                fs.copy_files(from_path, to_path, source_filesystem=from_fs, destination_filesystem=to_fs)
            yield pd.DataFrame({"copied": [len(chunk)]})

    parts = max(1, min(len(names) // 8, spark.sparkContext.defaultParallelism * 4))
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(parts)
    return frame.mapInPandas(copy, "copied long").agg(F.sum("copied")).first()[0]
