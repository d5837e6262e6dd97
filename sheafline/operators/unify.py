"""Bringing the categories together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sheafline.functions import paths


def category_list(files: DataFrame, root: str, column: str = "source_file") -> DataFrame:
    """Names of the folders right below the root, sorted."""
    name = paths.category(F.col(column), root)
    return files.select(name.alias("category")).where("category IS NOT NULL").distinct().orderBy("category")


def rows_per_category(table: DataFrame) -> DataFrame:
    return table.groupBy("category").agg(F.count("*").alias("row_count"))


def source_status(categories: DataFrame, table: DataFrame) -> DataFrame:
    """Every category with its number of rows and whether it takes part
    (``unified``) or is empty or missing (``skipped``). One aggregation over the
    partitioned table instead of a count per category."""
    counted = categories.join(rows_per_category(table), "category", "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0))
    )
    return counted.select(
        "category",
        paths.table_slug(F.col("category")).alias("table_slug"),
        "row_count",
        F.when(F.col("row_count") > 0, "unified").otherwise("skipped").alias("status"),
    )


def unify_partitions(gold: DataFrame, categories: Sequence[str]) -> DataFrame:
    """All rows of the categories out of one table partitioned by category: a
    pruned scan, duplicates kept."""
    rows = gold.where(F.col("category").isin(list(categories)))
    if rows.isEmpty():
        raise ValueError("no category has any rows to unify")
    return rows


def unify_tables(tables: Mapping[str, DataFrame | None], columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """UNION ALL of one table per category, by column name, and the names of the
    categories left out for being missing (None) or empty."""
    used = {n: t for n, t in tables.items() if t is not None and not t.isEmpty()}
    if not used:
        raise ValueError("no category has any rows to unify")
    union = reduce(DataFrame.unionByName, (t.select(*columns) for t in used.values()))
    return union, [n for n in tables if n not in used]
