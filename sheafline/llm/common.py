"""Tables staged in the folder that the cluster shares, and small helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text in an Arrow batch. Python sees a batch at a time, so this bounds its memory.
TEXT_ROWS = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Have Arrow batches of at most `rows` rows, as texts may be long; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; the warehouse, which the cluster shares too, where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more, by Spark's own file system for it."""
    spark = df.sparkSession
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remainder_of_id(doc_id, n: int):
    """crc32 of the id as text, mod n: the fixed split into training and held-out rows."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def about(df: DataFrame, most: int, key: str) -> DataFrame:
    """All rows if there are at most `most`; else about as many, those with the least hashes of `key`."""
    n = df.count()
    if n <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(key), F.lit(1_000_003)) < F.lit(int(most / n * 1_000_003)))


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, mark): mark is a hash of the text, by which rows that repeat an identifier are told apart."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))


#: Rows of 16 bytes that are sent to all tasks, at most; more of them are shuffled with the documents.
SENT_ROWS = 1_000_000


def without(docs: DataFrame, gone: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with their own columns, whose (doc_id, mark) isn't in `gone`. While `gone` is small, which is
    counted, no text is shuffled."""
    gone = stage(gone.select(F.col("doc_id").alias("__doc_id"), F.col("mark").alias("__mark")).distinct(), name)
    sent = F.broadcast(gone) if gone.count() <= SENT_ROWS else gone
    same = docs[id_col].cast("long").eqNullSafe(sent["__doc_id"])
    return docs.join(sent, same & (F.xxhash64(docs[text_col].cast("string")) == sent["__mark"]), "left_anti")
