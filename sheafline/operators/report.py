"""Figures for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DETAIL = ["document_id", "source_file_name", "chunk_idx", "chunk_type", "chunked_at"]


def counters(chunks: DataFrame, gold: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """Documents and source files of the chunk table, chunks of gold (the same
    table unless given), and rows altogether. ``approximate`` estimates the
    distinct counts from sketches, which need no shuffle of the names."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    files = [
        distinct("document_id").alias("document_count"),
        distinct("source_file_name").alias("source_file_count"),
    ]
    rows = [F.count("chunk_id").alias("chunk_count"), F.count("*").alias("row_count")]
    if gold is None:
        return chunks.agg(*files, *rows)
    # Two one-row tables side by side.
    left = chunks.agg(*files).withColumn("_one", F.lit(1))
    right = gold.agg(*rows).withColumn("_one", F.lit(1))
    return left.join(right, "_one").drop("_one")


def chunks_per_document(gold: DataFrame) -> DataFrame:
    return gold.groupBy("document_id").agg(F.count("chunk_id").alias("chunk_count"))


def chunk_detail(gold: DataFrame) -> DataFrame:
    return gold.select(*[c for c in DETAIL if c in gold.columns])
