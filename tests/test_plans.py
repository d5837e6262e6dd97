import io
import os
import re
import tempfile
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sheafline.operators import ledger, search
from sheafline.plans.queries import QUERIES
from sheafline.plans import views as v
from sheafline.sources import landing, tables

SMALL = "/root/testdata/sf0.001"
IN_PYTHON = {
    "embed_chunks", "embed_outcome", "text_topk", "vector_topk", "vector_topk_dirty", "vector_topk_ann", "vector_topk_clustered", "vector_topk_filtered", "vector_topk_overfetch",
}


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows_go_to_python_but_for_vectors(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert ("Python" in text or "MapInArrow" in text) == (name in IN_PYTHON)


def test_window_regex_is_worked_out_once(spark):
    text = plan(v.chunk_rows(spark, SMALL).select("chunk_content"))
    assert text.count("Generate (") >= 1
    generate = [b for b in text.split("\n\n") if "Arguments: posexplode" in b]
    assert len(generate) == 1 and "regexp_extract_all" in generate[0]
    assert "size(" not in text


def test_silver_tests_for_text_without_the_regex(spark):
    text = plan(v.silver(spark, SMALL))
    conditions = [line for line in text.split("\n") if line.startswith("Condition")]
    assert conditions and not any("regexp_replace" in c for c in conditions)


def test_ledger_reads_no_bytes(spark):
    root = tempfile.mkdtemp(prefix="run-")
    os.makedirs(root + "/A")
    with open(root + "/A/x.md", "w") as f:
        f.write("x")
    text = plan(ledger.file_ledger(landing.listing(spark, root)))
    assert "ReadSchema" in text and "content" not in text.split("ReadSchema")[1].split("\n")[0]
    newest = landing.listing(spark, root).first().modificationTime
    assert "GreaterThanOrEqual(modificationTime" in plan(landing.contents(spark, root, modified_from=newest))


def test_category_is_a_pruned_read(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/t"
    v.keyed(spark, SMALL).write.partitionBy("category").parquet(path)
    text = plan(spark.read.parquet(path).where(F.col("category") == "CRM").select("chunk_id"))
    assert "PartitionFilters: [isnotnull(category" in text
    assert "ReadSchema: struct<chunk_id:string>" in text


def test_versions_shuffle_rows_once_to_count_and_once_to_number(spark):
    """Whatever share of the rows one file has. The other exchanges are of samples and of ranges' sums, and are broadcast."""
    df = ledger.document_versions(v.arrivals(spark, SMALL), ties=["event_id"])
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(_range#\d+, source_file#\d+,", text)) == 1
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text and "NestedLoop" not in text
    assert "BroadcastHashJoin" in text


def test_changes_shuffle_hashes_only(spark):
    text = plan(entry.queries()["index_sync_changes"](spark, SMALL))
    joins = [b for b in text.split("\n\n") if "SortMergeJoin" in b and "FullOuter" in b]
    exchanges = [b for b in text.split("\n\n") if b.strip().split("\n")[0].endswith("Exchange") and "chunk_id" in b]
    assert joins or "FullOuter" in text
    assert exchanges and all("chunk_content" not in b for b in exchanges)


def test_search_does_not_shuffle_the_corpus(spark):
    corpus = spark.read.parquet(SMALL + "/embeddings.parquet")
    hits = search.top_k(corpus, v.label_centres(spark, SMALL), id_column="vec_id")
    text = plan(hits)
    tree = [line.strip(" +-:*") for line in text.split("\n\n")[0].split("\n")]
    nodes = [line.split("(")[0].strip() for line in tree if line]
    assert nodes[nodes.index("MapInArrow") :] == ["MapInArrow", "Coalesce", "Filter", "Scan parquet"]
    assert "WindowGroupLimit" in nodes


def test_entry_schema(spark):
    assert tables.GOLD.count(",") == 13
    assert entry.entry(spark).dtypes == [("document_id", "string"), ("chunk_count", "bigint")]
