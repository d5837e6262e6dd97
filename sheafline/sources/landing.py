"""Files in the landing folders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafline.settings import as_root
from sheafline.sources import files


def discover_categories(spark: SparkSession, root: str) -> list[str]:
    """Folders right below the root, empty ones too; files there are ignored."""
    return files.folders(spark, root)


def listing(
    spark: SparkSession,
    root: str,
    categories: Sequence[str] | None = None,
    modified_from: datetime | None = None,
) -> DataFrame:
    """Path, size and time of all files below the root. No file is opened: the
    content column is not part of the plan. Spark keeps the list of paths on the
    driver, whatever the time asked for, so a huge landing folder is listed some
    categories at a time."""
    return contents(spark, root, categories, modified_from).select("path", "modificationTime", "length")


def contents(
    spark: SparkSession,
    root: str,
    categories: Sequence[str] | None = None,
    modified_from: datetime | None = None,
) -> DataFrame:
    """Current bytes of files. ``modified_from`` reaches the scan, which then does
    not read older files at all."""
    found = _scan(spark, root, categories)
    if modified_from is not None:
        found = found.where(F.col("modificationTime") >= F.lit(modified_from))
    return found


def _scan(spark, root, categories) -> DataFrame:
    root = as_root(root)
    where = [root] if categories is None else [as_root(root + c) for c in categories]
    return _binary(spark, where)


def loose_files(spark: SparkSession, root: str) -> DataFrame | None:
    """Path, size and time of the files right at the root."""
    found = files.files_at(spark, root)
    if not found:
        return None
    return _binary(spark, found).select("path", "modificationTime", "length")


def _binary(spark: SparkSession, where: list[str]) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load([files.literal(p) for p in where])
