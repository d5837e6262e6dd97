"""Every operator as a query over the given tables: name -> (spark, dir) -> rows.

Times of day (``processed_at``, ``chunked_at``) are left out of the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheafline.functions import elements as el, embedding, paths, text as tx, windows
from sheafline.operators import (
    ann, checks, chunks, documents, gold, ledger, report, routing, search, sync, unify, vectors,
)
from sheafline.operators.search import Scoring
from sheafline.plans import views as v
from sheafline.settings import ChunkSpec
from sheafline.sources import files

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# --- ledger -----------------------------------------------------------------


@query
def file_ledger(spark, d) -> DataFrame:
    return v.arrivals_of_files(spark, d)


@query
def ledger_increment(spark, d) -> DataFrame:
    found = v.arrivals(spark, d)
    seen = found.where(F.col("ingested_at") < F.expr(v.LAST_RUN))
    return ledger.ledger_increment(found, seen).select(*ledger.LEDGER)


@query
def document_versions(spark, d) -> DataFrame:
    return ledger.document_versions(v.arrivals(spark, d), ties=["event_id"])


@query
def latest_documents(spark, d) -> DataFrame:
    return ledger.latest_documents(v.arrivals(spark, d), ties=["event_id"])


# --- names and routing ------------------------------------------------------


@query
def category_list(spark, d) -> DataFrame:
    return unify.category_list(v.arrivals_of_files(spark, d), v.ROOT)


@query
def category_slug(spark, d) -> DataFrame:
    files = v.arrivals_of_files(spark, d)
    name = paths.category(F.col("source_file"), v.ROOT)
    return files.select("source_file", name.alias("category"), paths.table_slug(name).alias("table_slug"))


@query
def category_fanout(spark, d) -> DataFrame:
    """The tables of every category, with the number of files they take in."""
    files = v.arrivals_of_files(spark, d)
    named = files.select(paths.category(F.col("source_file"), v.ROOT).alias("category"))
    per = named.where("category IS NOT NULL").groupBy("category").agg(F.count("*").alias("file_count"))
    slug = paths.table_slug(F.col("category"))
    suffixes = ["_bronze_documents", "_silver_documents", "_silver_document_chunks", "_gold_document_embeddings"]
    names = F.array(*[F.concat(slug, F.lit(s)) for s in suffixes])
    return per.select("category", "file_count", F.explode(names).alias("table_name"))


@query
def category_filter(spark, d) -> DataFrame:
    return documents.in_category(v.arrivals_of_files(spark, d), v.ROOT, "CRM")


@query
def document_id(spark, d) -> DataFrame:
    files = v.arrivals_of_files(spark, d)
    return files.select("source_file", paths.document_id(F.col("source_file_name")).alias("document_id"))


@query
def doc_path(spark, d) -> DataFrame:
    files = v.arrivals_of_files(spark, d)
    return files.select("source_file", paths.doc_path(F.col("source_file")).alias("doc_path"))


@query
def agent_route(spark, d) -> DataFrame:
    files = v.arrivals_of_files(spark, d)
    where = paths.doc_path(F.col("source_file"))
    return files.select("source_file", where.alias("doc_path"), paths.agent(where).alias("agent_id"))


@query
def agent_route_table(spark, d) -> DataFrame:
    """Line items as files in folders nation > supplier > part; rules for each part of a supplier that came back, and behind
    them one for each nation."""
    items = v.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus")
    homes = v.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    folder = F.concat_ws(">", F.col("s_nationkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"))
    filed = items.join(homes, "l_suppkey").withColumn("doc_path", folder)
    back = filed.where("l_returnflag = 'R'").groupBy(F.col("doc_path").alias("prefix"))
    back = back.agg(F.min("l_linestatus").alias("agent_id"), F.min("l_orderkey").alias("rule_no"))
    nations = v.table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("prefix"), F.col("n_name").alias("agent_id"),
        (F.lit(1 << 40) + F.col("n_nationkey")).alias("rule_no"),
    )
    named = nations.where("rule_no % 5 <> 0")
    return routing.route(filed.select("l_orderkey", "l_linenumber", "doc_path"), back.unionByName(named))


@query
def chunk_metadata(spark, d) -> DataFrame:
    files = v.arrivals_of_files(spark, d)
    return files.select("source_file", gold.metadata(F.col("source_file")).alias("metadata"))


# --- texts ------------------------------------------------------------------


@query
def bronze_documents(spark, d) -> DataFrame:
    joined = documents.bronze_documents(v.arrivals_of_files(spark, d), v.landing(spark, d))
    return joined.withColumn("content_md5", F.md5("content")).drop("content")


@query
def silver_documents(spark, d) -> DataFrame:
    return v.silver(spark, d).drop("processed_at", "category")


@query
def text_preview(spark, d) -> DataFrame:
    return v.silver(spark, d).select("document_id", tx.preview(F.col("full_text")).alias("text_preview"))


@query
def html_table_text(spark, d) -> DataFrame:
    p = v.table(spark, d, "pages", "page_id")
    return p.select("page_id", tx.html_document(F.col("html")).alias("page_text"))


@query
def html_element_text(spark, d) -> DataFrame:
    p = v.table(spark, d, "pages", "page_id")
    return p.select("page_id", tx.html_element(F.col("html")).alias("page_text"))


# --- parsed documents -------------------------------------------------------


@query
def parsed_ok(spark, d) -> DataFrame:
    return chunks.parsed_ok(v.parsed(spark, d)).select("document_id")


@query
def element_text(spark, d) -> DataFrame:
    return v.parsed(spark, d).select("document_id", el.element_text(F.col("parsed_content")).alias("full_text"))


@query
def figure_text(spark, d) -> DataFrame:
    p = v.parsed(spark, d)
    return p.select("document_id", el.figure_text(F.col("parsed_content")).alias("figure_descriptions"))


@query
def page_count(spark, d) -> DataFrame:
    return v.parsed(spark, d).select("document_id", el.page_count(F.col("parsed_content")).alias("page_count"))


@query
def elements_explode(spark, d) -> DataFrame:
    return chunks.explode_elements(v.parsed(spark, d))


@query
def parsed_silver(spark, d) -> DataFrame:
    """The silver table of parsed documents: those that could be read, with what they say and show."""
    return documents.parsed_silver(v.parsed(spark, d))


@query
def element_chunks(spark, d) -> DataFrame:
    """Chunks of every element, with their ids; the page stays with them."""
    elements = chunks.explode_elements(chunks.parsed_ok(v.parsed(spark, d)))
    name = F.concat("document_id", F.lit(".pdf"))
    cut = chunks.chunk_elements(elements.withColumns({"source_file_name": name, "source_file": name}))
    return cut.withColumn("chunk_id", gold.chunk_id()).drop("chunked_at")


# --- chunks -----------------------------------------------------------------


@query
def chunks_overlap(spark, d) -> DataFrame:
    return v.chunk_rows(spark, d).drop("category")


@query
def chunk_windows(spark, d) -> DataFrame:
    """The windows of every text with their places in it."""
    cut = F.posexplode(windows.chunks(F.col("full_text"), ChunkSpec())).alias("n", "w")
    return v.silver(spark, d).select("document_id", cut).select(
        "document_id", "w.chunk_index", "w.start_offset", "w.end_offset", F.md5(F.col("w.chunk_text").cast("binary")).alias("chunk_md5")
    )


@query
def chunks_positional(spark, d) -> DataFrame:
    cut = chunks.chunk_documents(v.silver(spark, d), ChunkSpec(), positional=True)
    return cut.drop("chunked_at", "category")


@query
def chunk_strategy(spark, d) -> DataFrame:
    files = v.strategy_silver(spark, d, wide=False)
    return files.select("source_file", chunks.chunk_strategy(F.col("source_file")).alias("s")).select(
        "source_file",
        F.col("s.mode").alias("chunk_mode"),
        F.col("s.size").alias("chunk_size"),
        F.col("s.overlap").alias("chunk_overlap"),
    )


@query
def chunks_by_strategy(spark, d) -> DataFrame:
    cut = chunks.chunk_by_strategy(v.strategy_silver(spark, d))
    return cut.select("document_id", "source_file", "chunk_mode", "chunk_idx", "chunk_content", "chunk_type")


# --- gold -------------------------------------------------------------------


@query
def chunk_id(spark, d) -> DataFrame:
    k = v.chunk_rows(spark, d).withColumn("chunk_id", gold.chunk_id())
    return k.select("document_id", "element_idx", "chunk_idx", "chunk_id")


@query
def metadata_filter(spark, d) -> DataFrame:
    """Chunks per folder of the documents that one agent owns."""
    owned = v.keyed(spark, d).where(gold.meta(F.col("metadata"), "agent_id") == "개인신계약")
    where = gold.meta(F.col("metadata"), "doc_path").alias("doc_path")
    return owned.groupBy(where).agg(F.count("*").alias("chunk_count"))


@query
def embed_chunks(spark, d) -> DataFrame:
    g = gold.embed_chunks(v.keyed(spark, d).withColumn("chunked_at", F.lit(None)), v.EMBEDDER)
    numbers = F.transform("embedding", lambda x: x.cast("int").cast("string"))
    return g.select("chunk_id", F.size("embedding").alias("dimension"), F.array_join(numbers, ",").alias("vector"))


class RefusesShort:
    """An embedder that fails on texts of under 200 characters."""

    def __init__(self, embedder):
        self.embedder = embedder

    def __call__(self, texts):
        if min(map(len, texts)) < 200:
            raise ValueError("text too short")
        return self.embedder(texts)


@query
def embed_once(spark, d) -> DataFrame:
    """Every chunk's vector out of a store that was filled in two runs: short chunks first, then whatever it lacked."""
    k, path = v.keyed(spark, d).select("chunk_id", "chunk_type", "chunk_content"), files.shared_path(spark, "vectors")
    vectors.fill(spark, k.where("chunk_type = 'single'"), path, v.EMBEDDER)
    store = vectors.fill(spark, k, path, v.EMBEDDER)
    numbers = F.transform("embedding", lambda x: x.cast("int").cast("string"))
    out = vectors.attach(k, store)
    return out.select("chunk_id", F.size("embedding").alias("dimension"), F.array_join(numbers, ",").alias("vector"))


@query
def embed_outcome(spark, d) -> DataFrame:
    vector = embedding.embed(F.col("chunk_content"), RefusesShort(v.EMBEDDER), batch=1)
    g = v.keyed(spark, d).select("chunk_type", vector.alias("embedding"))
    return g.groupBy("chunk_type").agg(
        F.count("*").alias("total_count"),
        F.count_if(F.col("embedding").isNotNull()).alias("embedded_count"),
        F.count_if(F.col("embedding").isNull()).alias("failed_count"),
    )


@query
def embedding_health(spark, d) -> DataFrame:
    return checks.embedding_health(v.table(spark, d, "embeddings"), v.DIMENSION)


@query
def index_projection(spark, d) -> DataFrame:
    return gold.index_rows(v.keyed(spark, d), [c for c in gold.INDEX if c != "embedding"])


# --- unify ------------------------------------------------------------------


@query
def rows_per_category(spark, d) -> DataFrame:
    return unify.rows_per_category(v.keyed(spark, d))


@query
def unify_sources(spark, d) -> DataFrame:
    """The categories of all files and one whose folder has no file, over all of gold."""
    categories = unify.category_list(v.arrivals_of_files(spark, d), v.ROOT)
    empty = categories.limit(1).select(F.lit(v.EMPTY_CATEGORY).alias("category"))
    return unify.source_status(categories.union(empty), v.keyed(spark, d))


@query
def unified_gold(spark, d) -> DataFrame:
    return unify.unify_partitions(v.keyed(spark, d), v.CATEGORIES).drop("category")


@query
def run_tally(spark, d) -> DataFrame:
    return sync.tally(unify_sources(spark, d), ["unified"])


# --- index ------------------------------------------------------------------


@query
def index_sync_changes(spark, d) -> DataFrame:
    index, source = v.snapshots(spark, d)
    return sync.index_changes(source, index, source.columns).select("chunk_id", "op")


@query
def index_sync_apply(spark, d) -> DataFrame:
    index, source = v.snapshots(spark, d)
    changes = sync.index_changes(source, index, source.columns)
    return sync.apply_changes(index, source, changes, source.columns)


# --- search -----------------------------------------------------------------


@query
def vector_topk(spark, d) -> DataFrame:
    vectors = v.table(spark, d, "embeddings", "vec_id")
    return search.top_k(vectors, v.label_centres(spark, d), Scoring(k=10), id_column="vec_id")


@query
def vector_topk_dirty(spark, d) -> DataFrame:
    """Every label's mean vector over rows of which some labels' are missing, short, or hold NULL, NaN or infinity."""
    vector = F.col("embedding")
    tail = F.slice(vector, 2, v.DIMENSION)
    spoilt = lambda first: F.concat(F.array(F.lit(first).cast("float")), tail)
    dirty = (
        F.when(F.col("label") == 0, None)
        .when(F.col("label") == 1, tail)
        .when(F.col("label") == 2, spoilt(float("nan")))
        .when(F.col("label") == 3, spoilt(None))
        .when(F.col("label") == 4, spoilt(float("inf")))
        .otherwise(vector)
    )
    vectors = v.table(spark, d, "embeddings", "vec_id").withColumn("embedding", dirty)
    return search.top_k(vectors, v.label_centres(spark, d), Scoring(k=10), id_column="vec_id")


@query
def text_topk(spark, d) -> DataFrame:
    texts = v.query_texts(spark, d).drop("agent_id")
    return search.search_texts(v.gold_rows(spark, d), texts, v.EMBEDDER)


@query
def vector_topk_filtered(spark, d) -> DataFrame:
    corpus = v.gold_rows(spark, d).withColumn("agent_id", gold.meta(F.col("metadata"), "agent_id"))
    return search.search_texts(corpus, v.query_texts(spark, d), v.EMBEDDER, group_column="agent_id")


@query
def vector_topk_ann(spark, d) -> DataFrame:
    """As vector_topk, from an inverted file over all vectors. As many cells are probed as find 97 % of the exact neighbours of
    some hundred rows; the given vectors have hardly any clusters, so these are more than half of all cells."""
    vectors = v.table(spark, d, "embeddings", "vec_id")
    centres = ann.train(vectors, v.DIMENSION, ann.Cells(cells=64), "vec_id")
    path = files.shared_path(spark, "vector-cells")
    ann.write_index(vectors.select("vec_id", "embedding"), centres, path, "vec_id")
    index, best = spark.read.parquet(path), Scoring(k=10)
    share = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, index.count() // 200))) == 0
    asked = index.where(share).select(F.col("vec_id").alias("query_id"), "embedding")
    probes = ann.probes_for(index, asked, centres, 0.97, best, "vec_id")
    return ann.top_k(index, v.label_centres(spark, d), centres, probes, best, "vec_id")


@query
def vector_topk_clustered(spark, d) -> DataFrame:
    """Search among one agent's rows, in an index written in ranges of agent and folder: the filter reaches the scan."""
    path = files.shared_path(spark, "clustered")
    gold.clustered(v.gold_rows(spark, d)).write.parquet(path)
    owned = spark.read.parquet(path).where(F.col("agent_id") == "개인신계약")
    return search.search_texts(owned, v.query_texts(spark, d).drop("agent_id"), v.EMBEDDER)


@query
def vector_topk_overfetch(spark, d) -> DataFrame:
    corpus = v.gold_rows(spark, d).withColumn("agent_id", gold.meta(F.col("metadata"), "agent_id"))
    texts = v.query_texts(spark, d).withColumn("embedding", embedding.embed(F.col("text"), v.EMBEDDER))
    return search.over_fetch(corpus, texts, Scoring(), "agent_id")


# --- reports and checks -----------------------------------------------------


@query
def report_counters(spark, d) -> DataFrame:
    return report.counters(v.keyed(spark, d))


@query
def chunks_per_document(spark, d) -> DataFrame:
    return report.chunks_per_document(v.keyed(spark, d))


@query
def chunk_detail(spark, d) -> DataFrame:
    return report.chunk_detail(v.keyed(spark, d))


@query
def pk_violations(spark, d) -> DataFrame:
    """Files as documents, were conversations' turns each a file of its name."""
    turns = v.table(spark, d, "conversations")
    name = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit(".md"))
    return checks.pk_violations(turns.select(paths.document_id(name).alias("document_id")), "document_id")


@query
def not_null_violations(spark, d) -> DataFrame:
    """Gold columns, with the labels of documents that may have none."""
    k = v.keyed(spark, d).withColumn("doc_id", F.regexp_extract("document_id", "[0-9]+$", 0).cast("bigint"))
    labelled = k.join(v.table(spark, d, "labels"), "doc_id", "left")
    return checks.not_null_violations(labelled, ["chunk_id", "document_id", "element_page", "quality"])


@query
def fk_orphans(spark, d) -> DataFrame:
    """Chunks of documents that are not among the labelled ones."""
    labels = v.table(spark, d, "labels")
    known = labels.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("document_id"))
    return checks.fk_orphans(v.keyed(spark, d), known, "document_id")
