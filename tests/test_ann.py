import os
import re
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafline.operators import ann, gold, search
from sheafline.operators.search import Scoring
from sheafline.plans import views as v
from sheafline.plans.queries import QUERIES

RNG = np.random.default_rng(3)
N, DIM = 6000, 12


@pytest.fixture(scope="module")
def corpus(spark):
    """Uneven clusters, a third of all rows in one, and rows without a usable vector."""
    centres = RNG.normal(size=(30, DIM))
    of = np.where(RNG.random(N) < 1 / 3, 0, RNG.integers(0, 30, N))
    vectors = (centres[of] + 0.4 * RNG.normal(size=(N, DIM))).round(4)
    rows = [(f"c{i:05}", vectors[i].tolist(), "k") for i in range(N)]
    bad = [("none", None, "k"), ("short", [1.0], "k"), ("nan", [float("nan")] * DIM, "k"), ("zero", [0.0] * DIM, "k")]
    return spark.createDataFrame(rows + bad, "chunk_id string, embedding array<float>, cell_name string").repartition(5).cache()


@pytest.fixture(scope="module")
def queries(corpus):
    """Every twentieth row asks for its neighbours."""
    own = corpus.where("chunk_id like 'c%'").where(F.substring("chunk_id", 2, 5).cast("int") % 20 == 0)
    return own.select(F.substring("chunk_id", 2, 5).cast("bigint").alias("query_id"), "embedding")


@pytest.fixture(scope="module")
def index(spark, corpus):
    centres = ann.train(corpus, DIM, ann.Cells(cells=40))
    path = tempfile.mkdtemp(prefix="run-") + "/cells"
    ann.write_index(corpus, centres, path)
    return spark.read.parquet(path), centres


def hits(df):
    return {(r.query_id, r.rank, r.chunk_id, r.score) for r in df.collect()}


def recall(found, exact):
    pair = lambda rows: {(q, i) for q, _, i, _ in rows}
    return len(pair(found) & pair(exact)) / len(pair(exact))


def test_all_rows_are_in_the_index(corpus, index):
    rows, centres = index
    assert rows.count() == corpus.count() and len(centres) == 40
    assert {r.chunk_id for r in rows.where("cell = -1").collect()} >= {"none", "short", "nan"}


def test_recall_and_exact_way(corpus, index, queries):
    rows, centres = index
    exact = hits(search.top_k(corpus, queries, Scoring(10)))
    assert recall(hits(ann.top_k(rows, queries, centres, 8, Scoring(10))), exact) >= 0.9
    assert hits(ann.top_k(rows, queries, centres, len(centres), Scoring(10))) == exact


def test_probes_follow_the_recall_asked_for(corpus, index, queries):
    rows, centres = index
    few = queries.where("query_id % 100 = 0")
    exact = hits(search.top_k(corpus, few))
    least = [ann.probes_for(rows, few, centres, r) for r in (0.5, 0.9, 1.0)]
    assert least == sorted(least) and least[-1] <= len(centres)
    assert recall(hits(ann.top_k(rows, few, centres, least[1])), exact) >= 0.9
    assert least[1] == 1 or recall(hits(ann.top_k(rows, few, centres, least[1] - 1)), exact) < 0.9
    assert recall(hits(ann.top_k(rows, few, centres, least[2])), exact) == 1


def test_reads_probed_cells_only(index, queries):
    rows, centres = index
    few = queries.where("query_id < 60")
    plan = ann.top_k(rows, few, centres, 1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[cell#\d+ IN \([0-9,]+\)\]", plan)
    asked = ann.with_cells(few, centres, 1).select("cell").distinct().count()
    assert asked <= 3


def test_query_without_usable_vector_finds_nothing(spark, index):
    rows, centres = index
    bad = spark.createDataFrame([(1, [float("inf")] * DIM)], "query_id bigint, embedding array<float>")
    assert ann.top_k(rows, bad, centres).count() == 0


def test_empty_and_tiny_corpus(spark, queries):
    for rows in ([], [("a", [1.0] * DIM)], [("a", [1.0] * DIM), ("b", [-1.0] * DIM)]):
        corpus = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
        centres = ann.train(corpus, DIM)
        path = tempfile.mkdtemp(prefix="run-") + "/cells"
        ann.write_index(corpus, centres, path)
        index = spark.read.schema("chunk_id string, embedding array<float>, cell int").parquet(path)
        assert hits(ann.top_k(index, queries, centres, 40)) == hits(search.top_k(corpus, queries))


def test_registered_query_against_the_exact_one(spark):
    near = {(r.query_id, r.vec_id) for r in QUERIES["vector_topk_ann"](spark, "/root/testdata/sf0.01").collect()}
    exact = {(r.query_id, r.vec_id) for r in QUERIES["vector_topk"](spark, "/root/testdata/sf0.01").collect()}
    assert len(near & exact) / len(exact) >= 0.9


def test_clustered_index_reads_less(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/clustered"
    rows = v.gold_rows(spark, "/root/testdata/sf0.01")
    gold.clustered(rows, 16).write.parquet(path)
    index = spark.read.parquet(path)
    owned = index.where(F.col("agent_id") == "개인신계약")
    plan = owned._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(agent_id,개인신계약)" in plan
    held = owned.select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < held < len([f for f in os.listdir(path) if f.startswith("part")]) / 2
    old = rows.where(gold.meta(F.col("metadata"), "agent_id") == "개인신계약").select("chunk_id")
    assert sorted(r.chunk_id for r in owned.collect()) == sorted(r.chunk_id for r in old.collect())
    find = lambda i: [tuple(r) for r in search.similarity_search(i, "보험 문서", v.EMBEDDER, ["chunk_id"], 5, {"agent_id": "개인신계약"}).collect()]
    assert find(index) == find(rows)
