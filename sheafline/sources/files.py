"""File system questions, asked through Hadoop so that any store works."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def literal(path: str) -> str:
    """The path for a reader that takes patterns, with nothing in it a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark reports it for files, scheme and all."""
    fs, p = _at(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below, sorted; hidden ones left out."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n[0] not in "._")


def files_at(spark: SparkSession, path: str) -> list[str]:
    """Files right at a folder, not those in folders below."""
    fs, p = _at(spark, path)
    found = [s.getPath() for s in fs.listStatus(p) if s.isFile()]
    return sorted(f.toString() for f in found if f.getName()[0] not in "._")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def modified(spark: SparkSession, folder: str) -> float:
    """When a folder's writer was done, or else when the folder last changed, in seconds; infinity where the
    store doesn't say."""
    fs, p = _at(spark, folder)
    mark = spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
    at = fs.getFileStatus(mark if fs.exists(mark) else p).getModificationTime() / 1000
    return at if at > 0 else float("inf")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares: the one in spark.checkpoint.dir, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
