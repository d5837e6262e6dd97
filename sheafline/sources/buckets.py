"""Keyed tables in hash buckets, of which a change rewrites only the buckets it touches.

A commit has a number and up to three folders: ``changes/commit=N`` (which keys were inserted,
updated, deleted), ``data/commit=N/bucket=B`` (all rows of every touched bucket as they are then),
and a manifest that says for each bucket which commit holds it. The manifest counts once it
is complete, so readers see a commit whole or not at all, and one that failed is not seen.

The change folders are a feed: ``follow`` brings another table up to date with all commits it
has not seen. What a table has followed stands in its manifest, so a batch that comes again
after a failure changes nothing.

One writer at a time. ``expire`` takes away what no manifest within a number and an age
refers to; a reader may go on for that long.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheafline.operators import sync
from sheafline.sources import files, tables

#: Changed keys that are sent to the rows of the touched buckets, at most; more of them are shuffled with these rows.
SENT_KEYS = 1_000_000
MANIFEST = "bucket INT, commit BIGINT"
#: In a manifest, instead of a bucket: the commit it belongs to, and the commit of the feed that was followed.
COMMIT, FOLLOWED = -1, -2
KEEP_VERSIONS = 3
KEEP_SECONDS = 86_400.0


@dataclass(frozen=True)
class Keyed:
    """Where a table lies, its columns, its key, and the number of buckets it was made with."""

    root: str
    schema: str
    key: str = sync.KEY
    buckets: int = 64

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    @property
    def changes(self) -> str:
        return f"{self.key} STRING, op STRING, row_hash BIGINT, bucket INT"


@dataclass(frozen=True)
class Manifest:
    """The commit of each bucket that has rows; at most as many entries as buckets."""

    commit: int = 0
    followed: int = 0
    places: dict[int, int] = field(default_factory=dict)


def manifest(spark: SparkSession, table: Keyed) -> Manifest:
    return _manifest_at(spark, tables.snapshot_path(spark, f"{table.root}/manifests"))


def _manifest_at(spark: SparkSession, path: str | None) -> Manifest:
    if path is None:
        return Manifest()
    entries = dict(map(tuple, spark.read.schema(MANIFEST).parquet(path).collect()))
    return Manifest(entries.pop(COMMIT), entries.pop(FOLLOWED), entries)


def read(spark: SparkSession, table: Keyed, at: Manifest | None = None) -> DataFrame:
    """The rows, with ``row_hash`` and the partition columns ``commit`` and ``bucket``."""
    return rows_of(spark, table, (manifest(spark, table) if at is None else at).places)


def rows_of(spark: SparkSession, table: Keyed, places: dict[int, int]) -> DataFrame:
    """The rows of some buckets, each as a commit left it."""
    schema = f"{table.schema}, row_hash BIGINT, commit BIGINT, bucket INT"
    if not places:
        return spark.createDataFrame([], schema)
    folders = [files.literal(f"{table.root}/data/commit={c}/bucket={b}") for b, c in sorted(places.items())]
    return spark.read.schema(schema).option("basePath", f"{table.root}/data").parquet(*folders)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in files.folders(spark, path) if n.startswith("commit="))


def _next(spark: SparkSession, table: Keyed, now: Manifest) -> int:
    taken = [*_numbers(spark, f"{table.root}/data"), *_numbers(spark, f"{table.root}/changes")]
    return max([now.commit, *taken]) + 1


def merge(spark: SparkSession, table: Keyed, source: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Make the table equal ``source`` and return the changes. Keys and hashes are compared, never the
    values: the table keeps its rows' hashes as a column. Where keys repeat in the source, the
    last row by ``order`` counts."""
    now = manifest(spark, table)
    number = _next(spark, table, now)
    held = read(spark, table, now).select(table.key, F.col("row_hash").alias("_old"))
    found = sync.changes_to(source, held, _columns(spark, table), order, table.key)
    changes = _write_changes(spark, table, found, number)
    _apply(spark, table, now, number, changes, source, order, now.followed)
    return changes.drop("bucket")


def _columns(spark: SparkSession, table: Keyed) -> list[str]:
    return spark.createDataFrame([], table.schema).columns


def _write_changes(spark: SparkSession, table: Keyed, found: DataFrame, number: int) -> DataFrame:
    path = f"{table.root}/changes/commit={number}"
    rows = found.withColumn("bucket", table.bucket_of(F.col(table.key)))
    rows.select(table.key, "op", "row_hash", "bucket").write.parquet(path)
    return spark.read.schema(table.changes).parquet(path)


def _apply(spark, table: Keyed, now: Manifest, number: int, changes: DataFrame, source: DataFrame, order, followed: int) -> None:
    """Rewrite the touched buckets and commit. Rows that stay are read bucket by bucket and written as they come,
    without a shuffle, while the changed keys, which are counted, are few enough to be sent to them."""
    touched = sorted(r.bucket for r in changes.select("bucket").distinct().collect())
    if not touched:
        if followed != now.followed:
            _commit(spark, table, Manifest(now.commit, followed, now.places))
        return
    columns = _columns(spark, table)
    keys, came = changes.select(table.key), changes.where("op <> 'delete'").select(table.key, "row_hash")
    if changes.count() <= SENT_KEYS:
        keys, came = F.broadcast(keys), F.broadcast(came)
    hashed = source.withColumn("row_hash", sync.row_hash([c for c in columns if c != table.key]))
    taken = hashed.join(came, [table.key, "row_hash"], "left_semi").select(*columns, "row_hash")
    if order:
        taken = taken.dropDuplicates([table.key])
    taken = taken.withColumn("bucket", table.bucket_of(F.col(table.key))).repartition("bucket")
    stay = rows_of(spark, table, {b: c for b, c in now.places.items() if b in set(touched)})
    stay = stay.join(keys, table.key, "left_anti").select(*columns, "row_hash", "bucket")
    replace(spark, table, now, touched, stay.unionByName(taken), followed, number)


def replace(
    spark: SparkSession,
    table: Keyed,
    now: Manifest,
    touched: Sequence[int],
    rows: DataFrame,
    followed: int = 0,
    number: int | None = None,
) -> None:
    """Commit ``rows``, which have a ``bucket``, as all that the touched buckets hold."""
    number = _next(spark, table, now) if number is None else number
    path = f"{table.root}/data/commit={number}"
    rows.write.partitionBy("bucket").parquet(path)
    filled = {int(n.split("=")[1]): number for n in files.folders(spark, path) if n.startswith("bucket=")}
    untouched = {b: c for b, c in now.places.items() if b not in set(touched)}
    _commit(spark, table, Manifest(number, followed, untouched | filled))


def _commit(spark: SparkSession, table: Keyed, new: Manifest) -> None:
    entries = [(COMMIT, new.commit), (FOLLOWED, new.followed), *sorted(new.places.items())]
    tables.write_snapshot(spark.createDataFrame(entries, MANIFEST).coalesce(1), f"{table.root}/manifests")


def changes_since(spark: SparkSession, table: Keyed, commit: int, upto: int | None = None) -> DataFrame:
    """The feed after a commit: the key, op, row_hash, bucket and commit of every change, up to the last commit
    that counts."""
    upto = manifest(spark, table).commit if upto is None else upto
    schema = f"{table.changes}, commit BIGINT"
    if not _numbers(spark, f"{table.root}/changes"):
        return spark.createDataFrame([], schema)
    feed = spark.read.schema(schema).parquet(f"{table.root}/changes")
    return feed.where((F.col("commit") > commit) & (F.col("commit") <= upto))


def follow(spark: SparkSession, feed: Keyed, target: Keyed) -> int:
    """Bring ``target`` up to date with all commits of ``feed`` that it has not followed, and return
    the last of them. Of several changes to a key the last counts. Where the feed's older
    changes have expired, the tables are compared instead."""
    source_at, now = manifest(spark, feed), manifest(spark, target)
    if source_at.commit <= now.followed:
        return now.followed
    source = read(spark, feed, source_at)
    number = _next(spark, target, now)
    kept_from = min(_numbers(spark, f"{feed.root}/changes"), default=source_at.commit + 1)
    if now.followed + 1 < kept_from and kept_from > 1:
        held = read(spark, target, now).select(target.key, F.col("row_hash").alias("_old"))
        found = sync.changes_to(source, held, _columns(spark, target), (), target.key)
    else:
        last = F.max_by(F.struct("op", "row_hash"), "commit").alias("last")
        since = changes_since(spark, feed, now.followed, source_at.commit)
        found = since.groupBy(feed.key).agg(last).select(feed.key, "last.op", "last.row_hash")
    changes = _write_changes(spark, target, found, number)
    _apply(spark, target, now, number, changes, source, (), source_at.commit)
    return source_at.commit


def expire(spark: SparkSession, table: Keyed, keep: int = KEEP_VERSIONS, seconds: float = KEEP_SECONDS) -> int:
    """Delete manifests beyond the last ``keep`` that are older than ``seconds``, then the buckets' folders and
    changes that none of the others needs. Returns the number of folders deleted. A commit that is still being
    written is newer than all manifests and stays."""
    gone = tables.expire_snapshots(spark, f"{table.root}/manifests", keep, seconds)
    left = [_manifest_at(spark, p) for p in tables.snapshot_paths(spark, f"{table.root}/manifests")]
    if not left:
        return gone
    needed = {(c, b) for m in left for b, c in m.places.items()}
    newest, oldest = max(m.commit for m in left), min(m.commit for m in left)
    for number in _numbers(spark, f"{table.root}/data"):
        folder = f"{table.root}/data/commit={number}"
        if number > newest or time.time() - files.modified(spark, folder) < seconds:
            continue
        names = [n for n in files.folders(spark, folder) if n.startswith("bucket=")]
        unused = [n for n in names if (number, int(n.split("=")[1])) not in needed]
        for path in [folder] if len(unused) == len(names) else [f"{folder}/{n}" for n in unused]:
            files.delete(spark, path)
            gone += 1
    for number in _numbers(spark, f"{table.root}/changes"):
        folder = f"{table.root}/changes/commit={number}"
        if number < oldest and time.time() - files.modified(spark, folder) >= seconds:
            files.delete(spark, folder)
            gone += 1
    return gone
