"""Tables as folders of parquet files.

One table per layer, partitioned by category: a category is a pruned read, all
categories together are one scan. Two kinds: appended by streams, and snapshots
that are replaced as a whole.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafline.operators import unify
from sheafline.sources import files

LEDGER = """source_file STRING, source_file_name STRING, file_size_bytes BIGINT,
    file_modified_at TIMESTAMP, ingested_at TIMESTAMP"""
BRONZE = """document_id STRING, source_file_name STRING, source_file STRING, content BINARY,
    file_size_bytes BIGINT, file_modified_at TIMESTAMP, ingested_at TIMESTAMP,
    bronze_layer STRING, batch BIGINT, category STRING"""
SILVER = """document_id STRING, source_file_name STRING, source_file STRING, full_text STRING,
    file_size_bytes BIGINT, file_modified_at TIMESTAMP, ingested_at TIMESTAMP,
    processed_at TIMESTAMP, silver_layer STRING, category STRING"""
CHUNKS = """document_id STRING, source_file_name STRING, source_file STRING, element_type STRING,
    element_page INT, element_idx INT, chunk_idx INT, chunk_content STRING, chunk_type STRING,
    chunked_at TIMESTAMP, category STRING"""
GOLD = """chunk_id STRING, document_id STRING, source_file_name STRING, source_file STRING,
    element_type STRING, element_page INT, element_idx INT, chunk_idx INT, chunk_content STRING,
    chunk_type STRING, chunked_at TIMESTAMP, embedding ARRAY<FLOAT>, metadata STRING, category STRING"""


@dataclass(frozen=True)
class Tables:
    """Where the tables of one pipeline lie: below one folder all executors see."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table as it is now, empty if nothing has been written yet."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A table as a stream of the rows appended to it."""
    files.make_folder(spark, path)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append what the stream has to give now, then stop. Files and checkpoint
    together make every row appear once, also after a failed run."""
    query = (
        rows.writeStream.format("parquet")
        .partitionBy("category")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def write_snapshot(rows: DataFrame, root: str, *partition_by: str) -> str:
    """Write a new version of a table next to the older ones, and return its
    folder. Readers see it once it is complete, so a table may be read to make
    its own next version and a failed write is never seen."""
    spark = rows.sparkSession
    taken = [int(n.split("=")[1]) for n in files.folders(spark, root) if n.startswith("version=")]
    path = f"{root}/version={max(taken, default=0) + 1}"
    rows.write.partitionBy(*partition_by).parquet(path)
    return path


def snapshot_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the latest complete version."""
    return next(iter(snapshot_paths(spark, root)), None)


def snapshot_paths(spark: SparkSession, root: str) -> list[str]:
    """Folders of all complete versions, the latest first."""
    names = [n for n in files.folders(spark, root) if n.startswith("version=")]
    names.sort(key=lambda n: -int(n.split("=")[1]))
    return [f"{root}/{n}" for n in names if files.exists(spark, f"{root}/{n}/_SUCCESS")]


KEEP_VERSIONS = 3
KEEP_SECONDS = 86_400.0


def expire_snapshots(spark: SparkSession, root: str, keep: int = KEEP_VERSIONS, seconds: float = KEEP_SECONDS) -> int:
    """Delete versions that are beyond the last ``keep`` complete ones and older than ``seconds``, and writes
    that failed before the latest version and are as old. A reader that began on a
    version has that long to finish. Returns the number of versions deleted."""
    if keep < 1:
        raise ValueError("at least one version stays")
    complete = snapshot_paths(spark, root)
    if not complete:
        return 0
    latest = int(complete[0].rpartition("=")[2])
    every = [n for n in files.folders(spark, root) if n.startswith("version=") and int(n.split("=")[1]) < latest]
    gone = [p for p in (f"{root}/{n}" for n in every) if p not in complete[:keep]]
    gone = [p for p in gone if time.time() - files.modified(spark, p) >= seconds]
    for path in gone:
        files.delete(spark, path)
    return len(gone)


def read_snapshot(spark: SparkSession, root: str, schema: str) -> DataFrame:
    path = snapshot_path(spark, root)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def copy_by_category(table: DataFrame, categories: DataFrame, root: str) -> DataFrame:
    """Copy a table into one folder per category, and say per category how many
    rows were copied. One write for all of them; the count reads the copy."""
    path = write_snapshot(table, root, "category")
    copied = table.sparkSession.read.schema(table.schema).parquet(path)
    status = unify.source_status(categories, copied)
    return status.withColumn("status", F.when(F.col("row_count") > 0, "copied").otherwise("empty"))
