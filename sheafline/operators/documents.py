"""From arrivals and file bytes to clean document texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheafline.functions import elements, paths, text

BRONZE = [
    "document_id", "source_file_name", "source_file", "content",
    "file_size_bytes", "file_modified_at", "ingested_at", "bronze_layer",
]
SILVER = [
    "document_id", "source_file_name", "source_file", "full_text",
    "file_size_bytes", "file_modified_at", "ingested_at", "processed_at", "silver_layer",
]

MAX_BROADCAST_ARRIVALS = 200_000


def in_category(arrivals: DataFrame, root: str, category: str) -> DataFrame:
    return arrivals.where(paths.below(F.col("source_file"), root, category))


def bronze_documents(
    arrivals: DataFrame, files: DataFrame, small_arrivals: bool = False
) -> DataFrame:
    """Arrivals with the current bytes of their files; arrivals whose file is
    gone drop out. Every metadata column comes from the arrival, only the bytes
    from the file. ``small_arrivals`` says that the caller has checked the
    arrivals to be at most ``MAX_BROADCAST_ARRIVALS``: then they are sent to the
    bytes, which stay where they were read. Otherwise both sides are shuffled by
    path, and a path with very many arrivals is split by the skew join."""
    bytes_ = files.select(F.col("path").alias("source_file"), "content")
    if small_arrivals:
        arrivals = F.broadcast(arrivals)
    return label_bronze(arrivals.join(bytes_, "source_file"))


def bronze_of_scan(files: DataFrame, skip: DataFrame, ingested_at: Column) -> DataFrame:
    """Files that are their own arrivals, all of one ledger run: what they are
    called, their size and time come with the bytes, so nothing is joined to them
    and nothing shuffled. ``skip`` are the paths to leave out, checked by the
    caller to be at most ``MAX_BROADCAST_ARRIVALS``."""
    wanted = files.join(F.broadcast(skip.select("path")), "path", "left_anti")
    return label_bronze(
        wanted.select(
            F.col("path").alias("source_file"),
            paths.file_name(F.col("path")).alias("source_file_name"),
            "content",
            F.col("length").alias("file_size_bytes"),
            F.col("modificationTime").alias("file_modified_at"),
            ingested_at.alias("ingested_at"),
        )
    )


def label_bronze(rows: DataFrame) -> DataFrame:
    """Arrivals with bytes, given their document id and layer."""
    return (
        rows.withColumn("document_id", paths.document_id(F.col("source_file_name")))
        .withColumn("bronze_layer", F.lit("bronze"))
        .select(*BRONZE, *[c for c in rows.columns if c not in BRONZE])
    )


def silver_documents(
    bronze: DataFrame, processed_at: Column | None = None, repair: bool = False
) -> DataFrame:
    """Decoded, tidied texts; documents without text are left out. Tidying never
    removes the last character that is not a space, so the test is made on the
    decoded bytes: pushed down, it would otherwise repeat the tidying. Narrow: no
    shuffle, every step inside generated code."""
    decoded = text.decode(F.col("content"), repair)
    return (
        bronze.where(text.has_text(decoded))
        .withColumn("full_text", text.tidy(decoded))
        .withColumn("processed_at", F.current_timestamp() if processed_at is None else processed_at)
        .withColumn("silver_layer", F.lit("silver"))
        .select(*SILVER, *[c for c in bronze.columns if c not in [*BRONZE, *SILVER]])
    )


def parsed_silver(parsed: DataFrame, column: str = "parsed_content") -> DataFrame:
    """What parsed documents say and show: the text of their elements, tables as text and runs of
    empty lines cut, what their figures describe, and their pages. Documents that could not
    be read are left out."""
    whole = F.col(column)
    return parsed.where(elements.error_status(whole).isNull()).select(
        *[c for c in parsed.columns if c != column],
        text.html_document(elements.element_text(whole)).alias("full_text"),
        elements.figure_text(whole).alias("figure_descriptions"),
        elements.page_count(whole).alias("page_count"),
    )
