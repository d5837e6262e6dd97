"""Listing of large landing folders by tasks, folder by folder.

Each round lists the folders of one level in tasks and writes what they hold; the
folders among it are the next round. Files go from the tasks to a table, so the driver
keeps neither files nor folders, however many there are. A folder is listed by one task, as
stores give the names of a folder in one sequence; its entries pass through one at a time.

How a folder is listed is a parameter: any picklable function from a folder to its
entries. The one given here knows local folders and the stores that Arrow opens by their
address.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafline.settings import as_root
from sheafline.sources import files

#: (name, whether it is a folder, bytes, time of its last change)
Entry = tuple[str, bool, int, datetime]
Lister = Callable[[str], Iterable[Entry]]

FOUND = "path STRING, is_folder BOOLEAN, length BIGINT, modificationTime TIMESTAMP"
BATCH = 10_000
#: Folders that one task lists.
FOLDERS_PER_TASK = 64


def by_arrow(folder: str) -> Iterator[Entry]:
    """Entries of a folder by Arrow's file system for its address. One that is gone meanwhile has none."""
    from pyarrow import fs

    address = "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder
    for scheme in ("s3a://", "s3n://"):
        address = address.replace(scheme, "s3://", 1) if address.startswith(scheme) else address
    if address.startswith("file://"):
        store, path = fs.LocalFileSystem(), address.removeprefix("file://")
    else:
        store, path = fs.FileSystem.from_uri(address)
    for found in store.get_file_info(fs.FileSelector(path.rstrip("/"), allow_not_found=True)):
        folder_ = found.type == fs.FileType.Directory
        yield found.base_name, folder_, 0 if folder_ else found.size, found.mtime


def listing(spark: SparkSession, root: str, lister: Lister = by_arrow, folders_per_task: int = FOLDERS_PER_TASK) -> DataFrame:
    """Path, size and time of all files below the root, as ``landing.listing`` gives them. Names that
    begin with a dot or an underscore are left out."""
    root = as_root(files.qualified(spark, root.rstrip("/")))
    at = files.shared_path(spark, "listing")
    level, folders = 0, spark.createDataFrame([(root,)], "path STRING")
    while True:
        _level(folders, lister, folders_per_task).write.parquet(f"{at}/level={level}")
        found = spark.read.schema(FOUND).parquet(f"{at}/level={level}")
        folders = found.where("is_folder").select("path")
        level += 1
        if folders.isEmpty():
            break
    every = spark.read.schema(f"{FOUND}, level INT").parquet(at)
    return every.where("NOT is_folder").select("path", "modificationTime", "length")


def _level(folders: DataFrame, lister: Lister, folders_per_task: int) -> DataFrame:
    """What the folders hold. They are dealt by hash, so neighbours with many files are in several tasks."""
    tasks = max(1, -(-folders.count() // folders_per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                seen = (e for e in lister(folder) if e[0][:1] not in (".", "_"))
                while some := list(islice(seen, BATCH)):
                    name, is_folder, length, changed = zip(*some, strict=True)
                    paths = [folder + n + ("/" if d else "") for n, d in zip(name, is_folder, strict=True)]
                    # To the millisecond, as Spark knows files: both listings give one arrival.
                    times = [t.astimezone(timezone.utc).replace(microsecond=t.microsecond // 1000 * 1000) for t in changed]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(paths), pa.array(is_folder), pa.array(length, pa.int64()), pa.array(times, pa.timestamp("us", "UTC"))],
                        names=["path", "is_folder", "length", "modificationTime"],
                    )

    return folders.repartition(tasks, F.xxhash64("path")).mapInArrow(run, FOUND)
