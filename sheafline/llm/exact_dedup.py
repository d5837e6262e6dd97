"""Exact deduplication as a stateful stream.

Rows arrive on a stream of (digest, identifier, content locator). The state, kept in
RocksDB on disk and never expired, holds for each digest the row that stays (largest
identifier, then largest locator) and the number of rows. Spark reduces each batch before
it is shuffled, so a text that fills a third of the input is one row of each task.

A digest alone proves nothing: the rows of every digest that was met more than once are
found again by their locators, and their full bytes are compared. Texts that differ under
one digest are told apart and grouped by their bytes.

Nulls and odd input: a null text is the empty text; a null identifier is smaller than any
other; rows that repeat an identifier are rows of their own, and of equal ones the largest
locator stays; an empty table gives an empty result; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm import common

STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "160",
    # A store takes some MB of local disk while open, however little it holds: close it after its task.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # In a folder of the local file system, Hadoop starts a process for each file made and eight for a file renamed by
    # FileContext; each has the executor's memory as its own for a moment. Renames by FileSystem start none. Checksum
    # files would double the files; Hadoop's own checksums stay.
    "spark.sql.streaming.checkpointFileManagerClass": (
        "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
    ),
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, their columns named c0, c1 and so on so that no name can clash, with `doc_id`, `text`, and `__file` and
    `__row`, where each lies. Rows that do not come straight from files are written to the shared folder first,
    as their place must be the same at each reading."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    named = dict(zip(docs.columns, own, strict=True))
    extra = lambda df, names: [df[names[id_col]].alias("doc_id"), df[names[text_col]].alias("text")]
    place = lambda df: [
        df.metadataColumn("_metadata")["file_path"].alias("__file"), df.metadataColumn("_metadata")["row_index"].alias("__row")
    ]
    quoted = {c: f"`{c}`" for c in docs.columns}
    columns = [docs[quoted[c]].alias(n) for c, n in named.items()]
    try:
        return docs.select(*columns, *extra(docs, quoted), *place(docs))
    except AnalysisException:
        staged = common.stage(docs.select(*columns), "located")
        return staged.select("*", *extra(staged, named), *place(staged))


def arrivals(placed: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    keep = F.struct(F.col(id_col).alias("doc_id"), F.col("__file").alias("file"), F.col("__row").alias("row"))
    return placed.select(digest(text).alias("digest"), keep.alias("keep"))


def groups_of_stream(rows: DataFrame) -> DataFrame:
    """Streaming: for each digest met, the row that stays so far and the rows so far."""
    return rows.groupBy("digest").agg(F.max("keep").alias("keep"), F.count(F.lit(1)).alias("n"))


def run_stream(spark: SparkSession, source: str, schema, state: str, files_per_batch: int | None = None) -> DataFrame:
    """Feed all files below `source` that the state has not seen; the groups as they are afterwards. Staged.

    `state` keeps the stream's state and its output. Calling again after more files arrive goes on
    from there; a call that was cut off repeats its last batch, which replaces what it had written.
    """
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        groups = groups_of_stream(reader.parquet(source))

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{state}/out/batch={batch_id}")

        query = (
            groups.writeStream.outputMode("update")
            .option("checkpointLocation", f"{state}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    columns = T.StructType([*groups.schema.fields, T.StructField("batch", T.LongType())])
    try:
        changes = spark.read.schema(columns).parquet(f"{state}/out")
    except AnalysisException:  # no file has arrived so far, so there is no output
        changes = spark.createDataFrame([], columns)
    if changes.select("batch").distinct().limit(2).count() < 2:  # a batch has one row for each digest
        return changes.drop("batch")
    last = F.max_by(F.struct("keep", "n"), "batch").alias("last")
    return common.stage(changes.groupBy("digest").agg(last).select("digest", "last.keep", "last.n"), "groups")


def compare_bytes(placed: DataFrame, rows: DataFrame, groups: DataFrame, text_col: str) -> DataFrame:
    """Of every digest with more than one row: each distinct text, its rows and the row of it that stays."""
    hits = rows.join(groups.filter("n > 1").select("digest"), "digest")
    hits = hits.select("digest", "keep", F.col("keep.file").alias("__file"), F.col("keep.row").alias("__row"))
    texts = placed.select("__file", "__row", F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (
        texts.join(hits, ["__file", "__row"])
        .groupBy("digest", "text")
        .agg(F.max("keep").alias("keep"), F.count(F.lit(1)).alias("n"))
    )


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A row for each row of `docs`: doc_id, keep_id, group_size, kept, digest, file, row."""
    return assign_located(located(docs, id_col, text_col), digest, files_per_batch)


def assign_located(
    placed: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same of rows that have their place already."""
    id_col, text_col = "doc_id", "text"
    spark = placed.sparkSession
    source = common.new_path(spark, "arrivals")
    arriving = arrivals(placed, id_col, text_col, digest)
    arriving.write.parquet(source)
    rows = spark.read.schema(arriving.schema).parquet(source)
    groups = run_stream(spark, source, arriving.schema, common.new_path(spark, "dedup-state"), files_per_batch)

    by_text = compare_bytes(placed, rows, groups, text_col)
    # One row for each text; the texts themselves are only kept where a digest has several.
    per_digest = by_text.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("rows"))
    collided = common.stage(per_digest.filter("texts > 1"), "collided").select("digest")

    def result(joined: DataFrame, stays: Column, n: Column) -> DataFrame:
        return joined.select(
            F.col("keep.doc_id").alias("doc_id"),
            stays["doc_id"].alias("keep_id"),
            n.alias("group_size"),
            (F.col("keep") == stays).alias("kept"),
            "digest",
            F.col("keep.file").alias("file"),
            F.col("keep.row").alias("row"),
        )

    of_digest = groups.select("digest", F.col("keep").alias("stays"), "n")
    out = result(rows.join(of_digest, "digest"), F.col("stays"), F.col("n"))
    if collided.isEmpty():
        return out
    texts = placed.select("__file", "__row", F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    several = by_text.join(collided, "digest", "left_semi")
    several = several.select("digest", "text", F.col("keep").alias("stays"), "n")
    members = rows.join(collided, "digest", "left_semi")
    members = members.select("*", F.col("keep.file").alias("__file"), F.col("keep.row").alias("__row"))
    members = members.join(texts, ["__file", "__row"]).join(several, ["digest", "text"])
    return out.join(collided, "digest", "left_anti").unionByName(result(members, F.col("stays"), F.col("n")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stay, with their own columns."""
    placed = located(docs, id_col, text_col)
    gone = assign_located(placed, **options).filter(~F.col("kept"))
    gone = common.stage(gone.select(F.col("file").alias("__file"), F.col("row").alias("__row")), "dropped")
    sent = F.broadcast(gone) if gone.count() <= common.SENT_ROWS // 8 else gone
    left = placed.join(sent, ["__file", "__row"], "left_anti")
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the equal one that stays."""
    found = assign(common.documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
