"""The arrival ledger: one row per file arrival, and its version history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sheafline.functions import paths
from sheafline.operators import numbering

ARRIVAL = ["source_file", "file_modified_at", "file_size_bytes"]
LEDGER = ["source_file", "source_file_name", "file_size_bytes", "file_modified_at", "ingested_at"]


def file_ledger(listing: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Ledger rows of a file listing (path, length, modificationTime). The
    content column is not touched, so a binary scan reads no bytes."""
    return listing.select(
        F.col("path").alias("source_file"),
        paths.file_name(F.col("path")).alias("source_file_name"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("file_modified_at"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def ledger_increment(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Arrivals that the ledger does not hold yet. An overwritten file differs in
    time or size and so counts as a new arrival; running twice adds nothing."""
    return found.join(ledger.select(*ARRIVAL), ARRIVAL, "left_anti").select(*found.columns)


def document_versions(
    ledger: DataFrame,
    ties: Sequence[str] = (),
    ranges: int | None = None,
    copies_per_block: int = numbering.COPIES_PER_BLOCK,
) -> DataFrame:
    """Number the arrivals of every file by time, with the total and a flag on
    the latest. Equal times are ordered by size, then by ``ties``."""
    order = ["file_modified_at", "ingested_at", "file_size_bytes", *ties]
    numbered = numbering.number_rows(
        ledger.select(*LEDGER, *ties),
        "source_file",
        order,
        "version_number",
        "total_versions",
        ranges,
        copies_per_block,
    )
    return numbered.select(
        *LEDGER,
        "version_number",
        "total_versions",
        (F.col("version_number") == F.col("total_versions")).alias("is_latest_version"),
    )


def latest_documents(ledger: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Only the latest arrival of every file. A grouped maximum, reduced before
    the shuffle, so no file's history is ever gathered or sorted whole."""
    order = F.struct("file_modified_at", "ingested_at", "file_size_bytes", *ties, "source_file_name")
    return (
        ledger.groupBy("source_file")
        .agg(F.max(order).alias("_last"), F.count("*").cast("int").alias("total_versions"))
        .select(
            "source_file",
            *[F.col("_last." + c).alias(c) for c in LEDGER[1:]],
            F.col("total_versions").alias("version_number"),
            "total_versions",
            F.lit(True).alias("is_latest_version"),
        )
    )
