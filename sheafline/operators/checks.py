"""Keys and vectors that break the tables' declared rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def pk_violations(table: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row, with the number of rows. NULL is
    a matter of ``not_null_violations``."""
    return (
        table.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("row_count"))
        .where("row_count > 1")
    )


def not_null_violations(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, how many rows are NULL in it; all columns in one pass."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counts.select(F.inline(pairs))


def fk_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent and how many child rows hold them. Children
    are counted per key first, so a key with very many of them is one row by the
    time of the join."""
    held = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return held.join(parent.select(key).distinct(), key, "left_anti")


def embedding_health(table: DataFrame, dimension: int, column: str = "embedding") -> DataFrame:
    """Vectors that are there, missing, or of another length."""
    size = F.size(column)
    return table.agg(
        F.count("*").alias("total_count"),
        F.count_if(F.col(column).isNull()).alias("missing_count"),
        F.count_if(F.col(column).isNotNull() & (size != dimension)).alias("wrong_dimension_count"),
        F.count_if(F.col(column).isNotNull() & (size == dimension)).alias("healthy_count"),
    )


def to_embed_again(gold: DataFrame, dimension: int) -> DataFrame:
    """Chunks whose vector is missing or of another length."""
    bad = F.col("embedding").isNull() | (F.size("embedding") != dimension)
    return gold.where(bad).drop("embedding")
