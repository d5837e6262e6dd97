"""Vectors by what they are of: equal texts are embedded once, ever.

The store is a table of (digest, embedding) that runs append to. A run takes the distinct
digests of its texts, leaves out those the store has, embeds one text for each of the rest,
and joins the vectors back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheafline import fixed_values as fv
from sheafline.functions import embedding as em
from sheafline.sources import tables

STORE = "digest BINARY, embedding ARRAY<FLOAT>"


def digest(text: Column) -> Column:
    """SHA-256 of a text; NULL is embedded as the empty text and shares its digest."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def unseen(texts: DataFrame, store: DataFrame, text: str) -> DataFrame:
    """(digest, text): one text for each digest that the store lacks. Copies are reduced before the shuffle."""
    keyed = texts.select(digest(F.col(text)).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return keyed.groupBy("digest").agg(F.first("text").alias("text")).join(store.select("digest"), "digest", "left_anti")


def fill(
    spark: SparkSession,
    texts: DataFrame,
    path: str,
    embedder: em.Embedder,
    text: str = "chunk_content",
    batch: int = fv.EMBED_BATCH,
    halve: bool = False,
) -> DataFrame:
    """Append the vectors that the store at ``path`` lacks for these texts, and return the store. Texts whose call
    failed are not stored, so the next run tries them again."""
    new = unseen(texts, tables.read(spark, path, STORE), text)
    made = new.select("digest", em.embed(F.col("text"), embedder, batch, halve).alias("embedding"))
    made.where("embedding IS NOT NULL").write.mode("append").parquet(path)
    return tables.read(spark, path, STORE)


def attach(rows: DataFrame, store: DataFrame, text: str = "chunk_content") -> DataFrame:
    """The rows with the vectors of their texts, NULL where the store has none. A digest that two runs stored at
    the same time has one vector."""
    one = store.groupBy("digest").agg(F.first("embedding").alias("embedding"))
    keyed = rows.withColumn("_digest", digest(F.col(text)))
    out = keyed.join(one.withColumnRenamed("digest", "_digest"), "_digest", "left")
    return out.select(*rows.columns, "embedding")
