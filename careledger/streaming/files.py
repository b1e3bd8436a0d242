"""Small files and folders of a shared store, through Spark's own file systems."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what lies in a folder; none if it is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_json(spark: SparkSession, path: str):
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, folder: str, content) -> int:
    """Put ``content`` as the folder's next numbered JSON file and return its number.

    The file is written under another name and renamed when whole, so a reader meets all of it or none. If another writer
    took the number, the next one is tried.
    """
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    _, draft = _fs(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    while True:
        number = 1 + max(numbers(spark, folder), default=0)
        _, target = _fs(spark, f"{folder}/{number:010d}.json")
        if not fs.exists(target) and fs.rename(draft, target):
            return number


def numbers(spark: SparkSession, folder: str) -> list[int]:
    return [int(n[:-5]) for n in names(spark, folder) if n.endswith(".json")]


def latest(spark: SparkSession, folder: str):
    """Content of the folder's last committed file, or None."""
    have = numbers(spark, folder)
    return read_json(spark, f"{folder}/{max(have):010d}.json") if have else None


def forget_older(spark: SparkSession, folder: str, keep: int) -> list:
    """Remove all but the last ``keep`` committed files; their contents are returned."""
    gone = []
    for n in sorted(numbers(spark, folder))[:-keep]:
        path = f"{folder}/{n:010d}.json"
        gone.append(read_json(spark, path))
        delete(spark, path)
    return gone
