"""Keyed, routed and embedded chunks: the source of the search index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sheafline import fixed_values as fv
from sheafline.functions import embedding as em, paths
from sheafline.operators.chunks import CHUNK
from sheafline.settings import AgentRule

GOLD = ["chunk_id", *CHUNK, "embedding", "metadata"]
INDEX = [
    "chunk_id", "document_id", "chunk_content", "source_file_name",
    "chunk_idx", "chunk_type", "metadata", "embedding",
]


def chunk_id(scope: str = "name") -> Column:
    """MD5 of document, element and chunk number. Files of one name in several
    folders share their ids; scope ``path`` adds the file's path to tell them
    apart."""
    parts = [F.col("document_id"), F.col("element_idx").cast("string"), F.col("chunk_idx").cast("string")]
    if scope == "path":
        parts.insert(0, F.col("source_file"))
    joined = parts[0]
    for p in parts[1:]:
        joined = F.concat(joined, F.lit("_"), p)
    return F.md5(joined)


def metadata(
    path: Column,
    agents: Sequence[AgentRule] | None = None,
    default: str = fv.DEFAULT_AGENT,
    base: str | None = None,
) -> Column:
    """JSON text with the folder path of a file and the agent it belongs to."""
    where = paths.doc_path(path, base)
    return F.to_json(
        F.struct(where.alias("doc_path"), paths.agent(where, agents, default).alias("agent_id"))
    )


def meta(column: Column, name: str) -> Column:
    """One field of the metadata JSON."""
    return F.get_json_object(column, f"$.{name}")


def keyed_chunks(
    chunks: DataFrame,
    id_scope: str = "name",
    agents: Sequence[AgentRule] | None = None,
    default_agent: str = fv.DEFAULT_AGENT,
    base: str | None = None,
) -> DataFrame:
    """Chunks with id and metadata, everything of gold but the vectors."""
    return chunks.withColumn("chunk_id", chunk_id(id_scope)).withColumn(
        "metadata", metadata(F.col("source_file"), agents, default_agent, base)
    )


def embed_chunks(
    keyed: DataFrame,
    embedder: em.Embedder,
    batch: int = fv.EMBED_BATCH,
    tasks: int | None = None,
) -> DataFrame:
    """Gold rows. ``tasks`` spreads the chunks over that many tasks first: it
    bounds the calls made at once and breaks up the chunks of long documents."""
    if tasks:
        keyed = keyed.repartition(tasks)
    out = keyed.withColumn("embedding", em.embed(F.col("chunk_content"), embedder, batch))
    return out.select(*GOLD, *[c for c in out.columns if c not in GOLD])


def embed_missing(
    gold: DataFrame,
    embedder: em.Embedder,
    dimension: int,
    batch: int = fv.EMBED_BATCH,
    tasks: int | None = None,
) -> DataFrame:
    """Gold with the rows embedded again whose vector is missing or of another
    length; the others go through untouched."""
    good = F.coalesce(F.size("embedding") == dimension, F.lit(False))
    again = embed_chunks(gold.where(~good).drop("embedding"), embedder, batch, tasks)
    return gold.where(good).unionByName(again.select(*gold.columns))


def index_rows(gold: DataFrame, columns: Sequence[str] = INDEX) -> DataFrame:
    """The columns that are kept in the index."""
    return gold.select(*columns)


def clustered(gold: DataFrame, ranges: int | None = None) -> DataFrame:
    """Index rows with the metadata's fields as columns of their own, in ranges of them: written as
    parquet, files and row groups hold few agents and folders each, and the least and greatest
    values kept with them let a filtered read skip the others. The chunk id in the key cuts an agent
    or folder that has much of the table into many ranges."""
    fields = [meta(F.col("metadata"), name).alias(name) for name in ("agent_id", "doc_path")]
    by = ["agent_id", "doc_path", "chunk_id"]
    rows = gold.select(*[c for c in gold.columns if c not in by[:2]], *fields)
    dealt = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by)
