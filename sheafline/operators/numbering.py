"""Numbering rows inside groups, whatever share of the table one group has.

``row_number()`` over a key sorts each key's rows in one task. Here the whole table is cut into
ranges of (key, order): even ones, as Spark draws the cuts from a sample of all rows, so a key with
most of the rows lies in most ranges and a rare key shares one. Rows are numbered inside their range;
a key that lies in several adds the rows it has in earlier ranges, a prefix sum over keys at the
ranges' edges. Exact copies are counted before anything is shuffled
and become rows again at the end. Where the cuts lie is only a hint: any choice gives
the same numbers. As another sample would cut elsewhere, rows are written with their range once and
read back, so a lost executor can't move any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sheafline.sources import files

#: A row with more copies is cut in blocks, which the ranges tell apart.
COPIES_PER_BLOCK = 10_000


def number_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    number: str,
    total: str,
    ranges: int | None = None,
    copies_per_block: int = COPIES_PER_BLOCK,
) -> DataFrame:
    """Add ``number`` = place of a row in its key's ``order`` (1, 2, …, NULLs
    first) and ``total`` = rows of that key. The columns must be sortable."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*order, *[c for c in df.columns if c != key and c not in order], "_block"]
    placed = _with_ranges(_counted(df, copies_per_block), [key, *by], ranges)

    # The range comes with the key, so ranges of many keys are dealt to many tasks.
    here = Window.partitionBy("_range", key)
    upto = here.orderBy(*[F.asc_nulls_first(c) for c in by]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = placed.select(
        *df.columns,
        "_range",
        "_copies",
        F.sum("_copies").over(upto).alias("_end"),
        F.sum("_copies").over(here).alias("_rows"),
    )
    earlier = F.broadcast(_earlier(placed, key))
    same = (ends["_range"] == earlier["_of_range"]) & ends[key].eqNullSafe(earlier["_of_key"])
    last = F.coalesce("_before", F.lit(0)) + F.col("_end")
    numbered = ends.join(earlier, same, "left").select(
        *[ends[c] for c in df.columns],
        F.explode(F.sequence(last - F.col("_copies") + 1, last)).alias("_number"),
        F.coalesce("_all", "_rows").cast("int").alias(total),
    )
    return numbered.select(*df.columns, F.col("_number").cast("int").alias(number), total)


def _counted(df: DataFrame, copies_per_block: int) -> DataFrame:
    """Each distinct row once, with its copies; blocks of them where they are many."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(copies_per_block).cast("bigint"))
    cut = counted.select("*", F.explode(blocks).alias("_block"))
    return cut.withColumn("_copies", F.least(F.col("_n") - F.col("_block"), F.lit(copies_per_block))).drop("_n")


def _with_ranges(counted: DataFrame, by: Sequence[str], ranges: int) -> DataFrame:
    """The rows with their range, from a written table: (columns, _block, _copies, _range)."""
    path = files.shared_path(counted.sparkSession, "ranges")
    dealt = counted.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    return counted.sparkSession.read.schema(dealt.schema).parquet(path)


def _earlier(placed: DataFrame, key: str) -> DataFrame:
    """For keys at an edge of a range, which are the ones that may lie in several: rows in earlier ranges, and in all.
    There are two such keys for each range at most, and each range in between holds one key alone."""
    edges = placed.groupBy("_range").agg(F.min(F.struct(key)).alias("_a"), F.max(F.struct(key)).alias("_b"))
    edges = edges.select(F.explode(F.array("_a", "_b")).alias("_edge")).distinct().select(F.col(f"_edge.{key}").alias("_of_key"))
    edges = F.broadcast(edges)
    parts = placed.join(edges, placed[key].eqNullSafe(edges["_of_key"]))
    parts = parts.groupBy("_of_key", "_range").agg(F.sum("_copies").alias("_here"))
    of_key = Window.partitionBy("_of_key")
    before = of_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "_of_key",
        F.col("_range").alias("_of_range"),
        F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_before"),
        F.sum("_here").over(of_key).alias("_all"),
    )
