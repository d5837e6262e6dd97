"""From document texts to chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sheafline.functions import elements as el, paths, text as tx, windows
from sheafline.settings import ChunkRule, ChunkSpec, default_chunk_rules

ELEMENT = ["element_type", "element_page", "element_idx"]
CHUNK = [
    "document_id", "source_file_name", "source_file", *ELEMENT,
    "chunk_idx", "chunk_content", "chunk_type", "chunked_at",
]


def whole_documents(silver: DataFrame) -> DataFrame:
    """Every document as one text element numbered 0."""
    return silver.select(
        "*",
        F.lit("text").alias("element_type"),
        F.lit(None).cast("int").alias("element_page"),
        F.lit(0).alias("element_idx"),
        F.col("full_text").alias("element_text"),
    ).drop("full_text")


def parsed_ok(parsed: DataFrame, column: str = "parsed_content") -> DataFrame:
    """Documents whose parser reported no error."""
    return parsed.where(el.error_status(F.col(column)).isNull())


def explode_elements(parsed: DataFrame, column: str = "parsed_content") -> DataFrame:
    """One row per element of a parsed document that has content (or else a
    description). Elements are numbered before blank ones go, so numbers may
    have gaps. HTML tables become text."""
    keep = [c for c in parsed.columns if c != column]
    # The outer form keeps the optimizer from adding a copy of the array
    # expression as a size filter; the NULL row it gives for none is dropped.
    rows = parsed.select(
        *keep, F.posexplode_outer(el.elements(F.col(column))).alias("element_idx", "_e")
    ).where(F.col("_e").isNotNull())
    e = F.col("_e")
    raw = F.coalesce(el.field(e, "content"), el.field(e, "description"))
    return (
        rows.select(
            *keep,
            el.field(e, "type").alias("element_type"),
            el.field(e, "page", "int").alias("element_page"),
            "element_idx",
            raw.alias("element_text"),
        )
        .where(tx.has_text(F.col("element_text")))
        .withColumn("element_text", tx.html_element(F.col("element_text")))
    )


def _explode(df: DataFrame, array: Column) -> DataFrame:
    rest = [c for c in df.columns if c != "element_text"]
    out = df.withColumn("_chars", F.length("element_text")).select(
        *rest, "_chars", F.posexplode_outer(array).alias("_pos", "_w")
    )
    return out.where(F.col("_w").isNotNull())


def _finish(rows: DataFrame, idx: Column, single: Column, chunked_at: Column | None) -> DataFrame:
    """Trim spaces, drop what is then empty, label, and order the columns."""
    out = (
        rows.withColumn("chunk_idx", idx)
        .withColumn("chunk_content", F.trim("_w"))
        .where(F.col("chunk_content") != "")
        .withColumn("chunk_type", F.when(single, F.lit("single")).otherwise(F.lit("overlap")))
        .withColumn("chunked_at", F.current_timestamp() if chunked_at is None else chunked_at)
    )
    extra = [c for c in out.columns if c not in CHUNK and not c.startswith("_")]
    return out.select(*CHUNK, *extra)


def chunk_elements(
    elements: DataFrame,
    spec: ChunkSpec = ChunkSpec(),
    positional: bool = False,
    chunked_at: Column | None = None,
) -> DataFrame:
    """Cut elements into windows. Blank windows take no number; with
    ``positional`` every window is numbered, so that numbers have gaps.

    Narrow and free of Python. Elements that are NULL or hold only spaces give
    no chunk, so they need no filter of their own. A chunk is ``single`` if its element is no longer
    than the chunk size, even where the overlap makes two windows of it."""
    cut = windows.texts if positional else windows.kept_texts
    rows = _explode(elements, cut(F.col("element_text"), spec))
    single = F.lit(True) if spec.mode == "none" else F.col("_chars") <= spec.size
    return _finish(rows, F.col("_pos"), single, chunked_at)


def _needed(silver: DataFrame) -> DataFrame:
    return silver.select(
        "document_id", "source_file_name", "source_file", "full_text",
        *[c for c in ("category",) if c in silver.columns],
    )


def chunk_documents(silver: DataFrame, spec: ChunkSpec = ChunkSpec(), **kw) -> DataFrame:
    """Chunks of whole documents, in the table's column order."""
    return chunk_elements(whole_documents(_needed(silver)), spec, **kw)


def chunk_strategy(path: Column, rules: Sequence[ChunkRule] | None = None) -> Column:
    """Which rule a file falls under, as struct<rule, mode, size, overlap>. The
    rules are compiled to one CASE of regexes; ``rule`` counts from 1, 0 is the
    default (whole text)."""
    case = F
    for n, r in enumerate(default_chunk_rules() if rules is None else rules, 1):
        case = case.when(path.rlike(paths.glob_regex(r.glob)), _strategy(n, r.spec))
    fallback = _strategy(0, ChunkSpec("none"))
    return fallback if case is F else case.otherwise(fallback)


def _strategy(n: int, spec: ChunkSpec) -> Column:
    cut = spec.mode != "none"
    return F.struct(
        F.lit(n).alias("rule"),
        F.lit(spec.mode).alias("mode"),
        F.lit(spec.size if cut else None).cast("int").alias("size"),
        F.lit(spec.shared if cut else None).cast("int").alias("overlap"),
    )


def chunk_by_strategy(
    silver: DataFrame,
    rules: Sequence[ChunkRule] | None = None,
    chunked_at: Column | None = None,
) -> DataFrame:
    """Cut every document the way its path asks for. A CASE picks among the
    rules' window expressions, of which only the chosen one is evaluated."""
    rules = default_chunk_rules() if rules is None else rules
    docs = whole_documents(_needed(silver)).withColumn("_strategy", chunk_strategy(F.col("source_file"), rules))
    array = F
    for n, r in enumerate(rules, 1):
        array = array.when(
            F.col("_strategy.rule") == n, windows.kept_texts(F.col("element_text"), r.spec)
        )
    whole = windows.kept_texts(F.col("element_text"), ChunkSpec("none"))
    rows = _explode(docs, whole if array is F else array.otherwise(whole))
    rows = rows.withColumn("chunk_mode", F.col("_strategy.mode"))
    single = (F.col("chunk_mode") == "none") | (F.col("_chars") <= F.col("_strategy.size"))
    return _finish(rows, F.col("_pos"), single, chunked_at)
