"""The given tables seen as landing files, arrivals, parsed documents and so on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafline import fixed_values as fv
from sheafline.functions import paths
from sheafline.functions.embedding import CharacterCounts
from sheafline.operators import chunks, documents, gold, ledger

ROOT = "s3://lake/보험/"
CATEGORIES = list(fv.CATEGORY_SLUGS)
EMPTY_CATEGORY = "Archive"
UNDERWRITING = ["단체언더라이팅", "개인언더라이팅", "언더_공통"]
STRATEGY_FOLDERS = ["summaries", "raw_text", "contracts", "other"]
AGENTS = [*fv.AGENT_PATHS, fv.DEFAULT_AGENT]
DIMENSION = 64
EMBEDDER = CharacterCounts(DIMENSION)
SMALL_SPLIT = 4 << 20
FIRST_DAY = "timestamp_ntz'2024-01-01 00:00:00'"
LAST_RUN = "timestamp_ntz'2024-01-20 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str, spread: str | None = None) -> DataFrame:
    """A given table. ``spread`` is for costly rows: a small file is often one row
    group and so one task, and is spread over the cores by that key first. Inputs of more
    than a few megabytes per core already come in enough splits and are left
    where they are read."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if _bytes(df) < cores * SMALL_SPLIT:
            df = df.repartition(cores, spread)
    return df


def _bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _pick(names: list[str], number) -> F.Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number + 1).cast("int"))


def landing(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Documents as files (path, modificationTime, length, content)."""
    d = table(spark, sf_dir, "documents", "doc_id" if wide else None)
    kind = F.col("doc_id") % len(CATEGORIES)
    sub = _pick(UNDERWRITING, F.floor(F.col("doc_id") / len(CATEGORIES)) % 3)
    folder = F.concat(
        _pick(CATEGORIES, kind), F.when(kind == 7, F.concat(F.lit("/"), sub)).otherwise("")
    )
    return d.select(
        F.concat(F.lit(ROOT), folder, F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"),
        F.expr(f"{FIRST_DAY} + make_dt_interval(0, 0, 0, doc_id)").alias("modificationTime"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.col("text").cast("binary").alias("content"),
        "doc_id",
    )


def arrivals_of_files(spark, sf_dir, wide=False) -> DataFrame:
    return ledger.file_ledger(landing(spark, sf_dir, wide), F.col("modificationTime"))


def bronze(spark, sf_dir) -> DataFrame:
    """The landing files as a bronze table. In a stored table the bytes are next
    to their arrival already; ``bronze_documents`` in the queries does the join."""
    files = landing(spark, sf_dir, wide=True)
    return documents.label_bronze(
        files.select(
            F.col("path").alias("source_file"),
            paths.file_name(F.col("path")).alias("source_file_name"),
            "content",
            F.col("length").alias("file_size_bytes"),
            F.col("modificationTime").alias("file_modified_at"),
            F.col("modificationTime").alias("ingested_at"),
            paths.category(F.col("path"), ROOT).alias("category"),
        )
    )


def silver(spark, sf_dir) -> DataFrame:
    return documents.silver_documents(bronze(spark, sf_dir), F.col("ingested_at"))


def chunk_rows(spark, sf_dir) -> DataFrame:
    return chunks.chunk_documents(silver(spark, sf_dir)).drop("chunked_at")


def keyed(spark, sf_dir) -> DataFrame:
    """Gold without vectors."""
    return gold.keyed_chunks(chunk_rows(spark, sf_dir))


def gold_rows(spark, sf_dir) -> DataFrame:
    return keyed(spark, sf_dir).withColumn(
        "embedding", gold.em.embed(F.col("chunk_content"), EMBEDDER)
    )


def arrivals(spark, sf_dir) -> DataFrame:
    """Events as uploads of one file per user: many arrivals per file."""
    e = table(spark, sf_dir, "events")
    path = F.concat(F.lit(ROOT + "CRM/user_"), F.col("user_id").cast("string"), F.lit(".md"))
    return e.select(
        path.alias("source_file"),
        paths.file_name(path).alias("source_file_name"),
        F.col("event_id").alias("file_size_bytes"),
        F.col("ts").alias("file_modified_at"),
        F.col("ts").alias("ingested_at"),
        "event_id",
    )


def strategy_silver(spark, sf_dir, wide=True) -> DataFrame:
    """Documents in folders that are cut in different ways."""
    d = table(spark, sf_dir, "documents", "doc_id" if wide else None)
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    folder = _pick(STRATEGY_FOLDERS, F.col("doc_id") % 4)
    return d.select(
        paths.document_id(name).alias("document_id"),
        name.alias("source_file_name"),
        F.concat(F.lit("s3://lake/landing/documents/"), folder, F.lit("/"), name).alias("source_file"),
        F.col("text").alias("full_text"),
    )


def snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """An index (documents that have a label) and its source as of later (no
    toxic documents; those of low quality got a new text): keys come and go,
    rows change."""
    k = keyed(spark, sf_dir).withColumn(
        "doc_id", F.regexp_extract("document_id", "[0-9]+$", 0).cast("bigint")
    )
    labels = table(spark, sf_dir, "labels")
    columns = [c for c in gold.INDEX if c != "embedding"]
    index = k.join(labels, "doc_id", "left_semi").select(*columns)
    reworded = F.concat(F.lit("[v2] "), F.col("chunk_content"))
    source = (
        k.join(labels, "doc_id", "left")
        .where(F.coalesce("toxic", F.lit(0)) == 0)
        .withColumn("chunk_content", F.when(F.col("quality") == 0, reworded).otherwise(F.col("chunk_content")))
        .select(*columns)
    )
    return index, source


def parsed(spark, sf_dir) -> DataFrame:
    """Documents as a parser would return them: a line is an element, every
    fourth a figure; very short documents could not be read."""
    d = table(spark, sf_dir, "documents", "doc_id")
    lines = F.split("text", "\n")
    element = F.transform(
        lines,
        lambda line, i: F.struct(
            F.when(i % 4 == 3, "figure").when(i % 4 == 2, "table").otherwise("text").alias("type"),
            F.floor(i / 10).cast("int").alias("page"),
            F.when(i % 8 == 7, F.lit(None)).when(
                i % 4 == 2, F.concat(F.lit("<table><tr><td>"), line, F.lit("</td></tr></table>"))
            ).otherwise(line).alias("content"),
            F.when(i % 8 == 7, line).alias("description"),
        ),
    )
    pages = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 10))
    status = F.when(F.col("n_chars") < 100, "unreadable")
    text = F.to_json(
        F.struct(
            F.struct(element.alias("elements"), pages.alias("pages")).alias("document"),
            status.alias("error_status"),
        )
    )
    return d.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("document_id"),
        F.parse_json(text).alias("parsed_content"),
    )


def query_texts(spark, sf_dir) -> DataFrame:
    """Benchmark passages as search texts, each with the agent it asks."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(
        F.col("item_id").alias("query_id"), "text", _pick(AGENTS, F.col("item_id") % len(AGENTS)).alias("agent_id")
    )


def label_centres(spark, sf_dir) -> DataFrame:
    """The mean vector of every label, as query vectors."""
    e = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("at", "value"))
    means = e.groupBy("label", "at").agg(F.avg(F.col("value").cast("double")).alias("value"))
    pairs = F.array_sort(F.collect_list(F.struct("at", "value")))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(pairs, lambda p: p["value"]).alias("embedding")
    )
