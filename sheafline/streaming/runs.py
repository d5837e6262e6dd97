"""Triggered runs: take what arrived since the last run through all layers, stop.

The layers are the batch operators on streams. The ledger is appended by a
listing compared with itself, because a file stream knows files by path and never
gives an overwritten file again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheafline.functions import paths
from sheafline.functions.embedding import Embedder
from sheafline.operators import chunks, documents, gold, ledger, unify
from sheafline.settings import Settings
from sheafline.sources import buckets, files, landing, tables, walk
from sheafline.sources.tables import Tables

SMALL_BATCH = documents.MAX_BROADCAST_ARRIVALS


def landing_root(spark: SparkSession, settings: Settings) -> str:
    return files.qualified(spark, settings.landing_root.rstrip("/")).rstrip("/") + "/"


def append_ledger(
    spark: SparkSession,
    settings: Settings,
    at: Tables,
    now: Column | None = None,
    by_category: bool = False,
    lister: walk.Lister | None = None,
) -> None:
    """Record new and overwritten files. Running again adds nothing. Spark's own listing is
    held by the driver; ``by_category`` lists one category after the other, so
    that it holds the files of one category at a time. With a ``lister``, such as
    ``walk.by_arrow``, tasks list the folders and the driver holds none of it."""
    listings = _listings(spark, settings.landing_root, by_category)
    for found in listings if lister is None else [walk.listing(spark, settings.landing_root, lister)]:
        known = tables.read(spark, at.ledger, tables.LEDGER)
        new = ledger.ledger_increment(ledger.file_ledger(found, now), known)
        new.write.mode("append").parquet(at.ledger)


def _listings(spark: SparkSession, root: str, by_category: bool) -> Iterator[DataFrame]:
    if not by_category:
        yield landing.listing(spark, root)
        return
    for category in landing.discover_categories(spark, root):
        yield landing.listing(spark, root, [category])
    loose = landing.loose_files(spark, root)
    if loose is not None:
        yield loose


def run_bronze(spark: SparkSession, settings: Settings, at: Tables, files_per_batch: int | None = None) -> None:
    """Pair new arrivals with the bytes of their files."""
    root = landing_root(spark, settings)
    query = (
        tables.stream(spark, at.ledger, tables.LEDGER, files_per_batch)
        .writeStream.foreachBatch(lambda rows, n: _bronze_batch(rows, n, root, at))
        .option("checkpointLocation", at.checkpoint("bronze"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _bronze_batch(rows: DataFrame, number: int, root: str, at: Tables) -> None:
    """One batch of arrivals, paired with files by path: no time of a file, as it is
    now or was, can lose an arrival. The files are listed anew each time, as a listing
    made once would miss files that came later, in the batch's categories alone. A
    batch owns its folder, so that doing it again after a failure replaces it."""
    arrivals = rows.withColumn("category", paths.category(F.col("source_file"), root))
    arrivals = arrivals.where(F.col("category").isNotNull())
    seen = arrivals.agg(
        F.count("*").alias("rows"),
        F.min("ingested_at").alias("first_run"),
        F.max("ingested_at").alias("last_run"),
        F.collect_set("category").alias("categories"),
    ).first()
    if not seen.rows:
        return
    present = set(landing.discover_categories(rows.sparkSession, root))
    categories = sorted(present.intersection(seen.categories))
    if not categories:
        return
    spark = rows.sparkSession
    current = landing.contents(spark, root, categories)
    if seen.rows <= SMALL_BATCH:
        bronze = documents.bronze_documents(arrivals, current, small_arrivals=True)
    else:
        listed = landing.listing(spark, root, categories)
        bronze = _large_bronze(arrivals, listed, current, root, seen.first_run == seen.last_run)
    bronze.write.mode("overwrite").partitionBy("category").parquet(f"{at.bronze}/batch={number}")


def _large_bronze(arrivals: DataFrame, listed: DataFrame, current: DataFrame, root: str, one_run: bool) -> DataFrame:
    """Pair many arrivals with their files without shuffling the bytes, where that
    can be had. Comparing arrivals and listing moves paths, times and sizes only.
    In a large load nearly every file is just as its one arrival says; few are not of
    this load, and few arrivals belong to files that have changed since or are there
    twice. If either is not few, or the load mixes ledger runs, both sides are
    shuffled by path."""
    as_listed = ledger.file_ledger(listed, F.lit(None)).select(*ledger.ARRIVAL)
    once = arrivals.groupBy(*ledger.ARRIVAL).count().where("count = 1").select(*ledger.ARRIVAL)
    others = as_listed.join(once, ledger.ARRIVAL, "left_anti")
    changed = arrivals.join(as_listed.join(once, ledger.ARRIVAL), ledger.ARRIVAL, "left_anti")
    limit = documents.MAX_BROADCAST_ARRIVALS
    if not one_run or others.count() > limit or changed.count() > limit:
        return documents.bronze_documents(arrivals, current)
    # As a number: a time of day in Python would depend on the driver's time zone.
    run_at = F.timestamp_micros(F.lit(arrivals.agg(F.unix_micros(F.max("ingested_at"))).first()[0]))
    skip = others.select(F.col("source_file").alias("path"))
    same = documents.bronze_of_scan(current, skip, run_at)
    same = same.withColumn("category", paths.category(F.col("source_file"), root))
    return same.unionByName(documents.bronze_documents(changed, current, small_arrivals=True))


def silver_layer(bronze: DataFrame, settings: Settings, now: Column | None = None) -> DataFrame:
    return documents.silver_documents(bronze.drop("batch"), now)


def chunk_layer(silver: DataFrame, settings: Settings, now: Column | None = None) -> DataFrame:
    if settings.chunk_rules is not None:
        return chunks.chunk_by_strategy(silver, settings.chunk_rules, chunked_at=now).drop("chunk_mode")
    return chunks.chunk_documents(silver, settings.chunking, chunked_at=now)


def gold_layer(chunk_rows: DataFrame, settings: Settings, embedder: Embedder, base: str | None = None) -> DataFrame:
    keyed = gold.keyed_chunks(
        chunk_rows, settings.id_scope, settings.agents, settings.default_agent, base
    )
    return gold.embed_chunks(keyed, embedder, settings.embed_batch, settings.embed_tasks)


def _base(spark: SparkSession, settings: Settings) -> str | None:
    return files.qualified(spark, settings.path_base) if settings.path_base else None


def run(
    spark: SparkSession,
    settings: Settings,
    at: Tables,
    embedder: Embedder,
    now: Column | None = None,
    files_per_batch: int | None = None,
    by_category: bool = False,
) -> None:
    """One triggered run through all layers. ``files_per_batch`` cuts a large
    backlog into batches, so that a failure costs one batch."""
    append_ledger(spark, settings, at, now, by_category)
    run_bronze(spark, settings, at, files_per_batch)
    bronze = tables.stream(spark, at.bronze, tables.BRONZE, files_per_batch)
    tables.append_stream(silver_layer(bronze, settings, now), at.silver, at.checkpoint("silver"))
    silver = tables.stream(spark, at.silver, tables.SILVER, files_per_batch)
    tables.append_stream(chunk_layer(silver, settings, now), at.chunks, at.checkpoint("chunks"))
    cut = tables.stream(spark, at.chunks, tables.CHUNKS, files_per_batch)
    rows = gold_layer(cut, settings, embedder, _base(spark, settings))
    tables.append_stream(rows, at.gold, at.checkpoint("gold"))
    refresh_versions(spark, at)


def full_refresh(spark: SparkSession, settings: Settings, at: Tables, embedder: Embedder, **kw) -> None:
    """Build everything again from the landing folders, into a root of its own:
    readers move over when it is done, and later runs carry on from there."""
    if files.exists(spark, at.ledger):
        raise ValueError(f"{at.root} already holds tables; a full refresh needs a new root")
    run(spark, settings, at, embedder, **kw)


VERSIONS = f"{tables.LEDGER}, version_number INT, total_versions INT, is_latest_version BOOLEAN"


def refresh_versions(spark: SparkSession, at: Tables) -> DataFrame:
    """Compute the version history again from the whole ledger."""
    rows = ledger.document_versions(tables.read(spark, at.ledger, tables.LEDGER))
    tables.write_snapshot(rows, at.versions)
    tables.expire_snapshots(spark, at.versions)
    return tables.read_snapshot(spark, at.versions, VERSIONS)


def versions_table(at: Tables) -> buckets.Keyed:
    return buckets.Keyed(f"{at.versions}_by_file", VERSIONS, "source_file")


def run_versions(spark: SparkSession, at: Tables, files_per_batch: int | None = None) -> None:
    """Bring the version history up to date with the arrivals since the last run. Only files that
    arrived are numbered anew, and only their buckets are written."""
    query = (
        tables.stream(spark, at.ledger, tables.LEDGER, files_per_batch)
        .writeStream.foreachBatch(lambda rows, n: _versions_batch(rows, n, at))
        .option("checkpointLocation", at.checkpoint("versions"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _versions_batch(rows: DataFrame, number: int, at: Tables) -> None:
    """The manifest says how many batches it holds, so one that comes again is left alone. The table has all of the
    ledger's columns: the earlier arrivals of a file come from its bucket, not from the ledger. Late
    arrivals find their place among them."""
    spark, table = rows.sparkSession, versions_table(at)
    now = buckets.manifest(spark, table)
    if number < now.followed:
        return
    bucket = table.bucket_of(F.col("source_file"))
    touched = sorted(r.bucket for r in rows.select(bucket.alias("bucket")).distinct().collect())
    held = buckets.rows_of(spark, table, {b: c for b, c in now.places.items() if b in set(touched)})
    came = rows.select(F.col("source_file").alias("_came")).distinct()
    again = held["source_file"].eqNullSafe(came["_came"])
    stay = held.join(came, again, "left_anti")
    earlier = held.join(came, again, "left_semi").select(*ledger.LEDGER)
    numbered = ledger.document_versions(earlier.unionByName(rows.select(*ledger.LEDGER)))
    columns = numbered.columns
    after = stay.select(*columns).unionByName(numbered).withColumn("bucket", bucket)
    buckets.replace(spark, table, now, touched, after, followed=number + 1)


def read_versions(spark: SparkSession, at: Tables) -> DataFrame:
    return buckets.read(spark, versions_table(at)).drop("row_hash", "commit", "bucket")


def refresh_unified(
    spark: SparkSession,
    settings: Settings,
    at: Tables,
    embedder: Embedder | None = None,
    dimension: int | None = None,
) -> DataFrame:
    """Replace the table of all categories' gold rows. With an embedder, rows
    whose vector is missing or not of that dimension are embedded once more."""
    rows = tables.read(spark, at.gold, tables.GOLD)
    if embedder is not None:
        rows = gold.embed_missing(rows, embedder, dimension, settings.embed_batch, settings.embed_tasks)
    categories = landing.discover_categories(spark, settings.landing_root)
    tables.write_snapshot(unify.unify_partitions(rows, categories), at.unified, "category")
    tables.expire_snapshots(spark, at.unified)
    return tables.read_snapshot(spark, at.unified, tables.GOLD)


INDEX = """chunk_id STRING, document_id STRING, chunk_content STRING, source_file_name STRING,
    chunk_idx INT, chunk_type STRING, metadata STRING, embedding ARRAY<FLOAT>"""


def index_table(at: Tables) -> buckets.Keyed:
    return buckets.Keyed(at.index, INDEX)


def refresh_index(spark: SparkSession, at: Tables, source: DataFrame) -> DataFrame:
    """Bring the index up to date with gold rows, and return the changes made. Of rows
    with the same key the latest counts. Only buckets with a change are written anew."""
    changes = buckets.merge(spark, index_table(at), source, ["chunked_at"])
    buckets.expire(spark, index_table(at))
    return changes


def read_index(spark: SparkSession, at: Tables) -> DataFrame:
    return buckets.read(spark, index_table(at)).select(*gold.INDEX)
