import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafline.functions.embedding import CharacterCounts, embed
from sheafline.operators import search
from sheafline.operators.search import Scoring

RNG = np.random.default_rng(5)
GROUPS = ["x", "y", None]
ROWS = [(f"c{i:03}", RNG.normal(size=6).round(3).tolist(), GROUPS[i % 3]) for i in range(300)]
ROWS += [(f"twin{i:03}", ROWS[0][1], "x") for i in range(40)] + [("zero", [0.0] * 6, "y")]
QUERIES = [(q, RNG.normal(size=6).round(3).tolist(), GROUPS[q % 2]) for q in range(9)] + [(9, ROWS[0][1], "x")]


@pytest.fixture(scope="module")
def corpus(spark):
    bad = [("short", [1.0], "x"), ("none", None, "x")]
    return spark.createDataFrame(ROWS + bad, "chunk_id string, embedding array<float>, grp string").repartition(5)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id bigint, embedding array<float>, grp string")


def brute(k, metric="cosine", grouped=False, rows=ROWS):
    out = set()
    f32 = lambda v: np.array(v, dtype=np.float32).astype(float)
    for q, qv, qg in QUERIES:
        a, scored = f32(qv), []
        for cid, cv, cg in rows:
            if grouped and cg != qg:
                continue
            b = f32(cv)
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            score = {"dot": a @ b, "l2": -np.linalg.norm(a - b), "cosine": a @ b / norm if norm else 0.0}[metric]
            scored.append((-round(float(score), 5) + 0.0, cid))
        out |= {(q, n, cid, -s + 0.0) for n, (s, cid) in enumerate(sorted(scored)[:k], 1)}
    return out


def as_set(df):
    rows = df.collect()
    return {(r.query_id, r.rank, r.chunk_id, r.score + 0.0) for r in rows}


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("max_queries", [100, 3])
def test_equals_brute_force(corpus, queries, metric, grouped, max_queries):
    got = search.top_k(
        corpus, queries, Scoring(7, metric, 5), group_column="grp" if grouped else None,
        max_queries=max_queries, bucket_rows=60,
    )
    assert as_set(got) == brute(7, metric, grouped)


def test_fewer_rows_than_k(corpus, queries):
    few = corpus.where("chunk_id < 'c003' or chunk_id = 'none'")
    got = search.top_k(few, queries, Scoring(7, decimals=5))
    assert as_set(got) == brute(7, rows=ROWS[:3])


def test_over_fetch_keeps_those_that_pass(corpus, queries):
    got = search.over_fetch(corpus, queries, Scoring(4, decimals=5), "grp", times=6)
    groups = {cid: g for cid, _, g in ROWS}
    wide = sorted(brute(24))
    want = set()
    for q, _, g in QUERIES:
        passing = [h for h in wide if h[0] == q and groups[h[2]] == g][:4]
        want |= {(q, n, h[2], h[3]) for n, h in enumerate(passing, 1)}
    assert as_set(got) == want


def test_attach_columns(corpus, queries):
    hits = search.top_k(corpus, queries, Scoring(3))
    full = search.attach(hits, corpus, ["grp"])
    assert full.count() == hits.count() and set(full.columns) == {"chunk_id", "query_id", "rank", "score", "grp"}


def test_no_queries_or_rows(corpus, queries):
    assert search.top_k(corpus, queries.limit(0)).count() == 0
    assert search.top_k(corpus.limit(0), queries).count() == 0


def test_queries_of_mixed_length_are_refused(corpus, queries):
    mixed = queries.withColumn("embedding", F.when(F.col("query_id") == 1, F.array(F.lit(1.0).cast("float"))).otherwise(F.col("embedding")))
    with pytest.raises(ValueError):
        search.top_k(corpus, mixed)


def test_search_by_text(spark):
    texts = spark.createDataFrame([("a", "apples"), ("b", "zzz"), ("c", "apple")], "chunk_id string, text string")
    corpus = texts.withColumn("embedding", embed(F.col("text"), CharacterCounts(32)))
    asked = spark.createDataFrame([(1, "appel")], "query_id int, text string")
    got = search.search_texts(corpus, asked, CharacterCounts(32), Scoring(2)).orderBy("rank").collect()
    assert [(r.chunk_id, r.score) for r in got][0] == ("c", 1.0) and got[1].chunk_id == "a"


def test_similarity_search_with_filter(spark):
    rows = [("a", "apples", '{"agent_id":"x"}'), ("b", "apple", '{"agent_id":"y"}'), ("c", "zzz", '{"agent_id":"x"}')]
    index = spark.createDataFrame(rows, "chunk_id string, chunk_content string, metadata string")
    index = index.withColumn("embedding", embed(F.col("chunk_content"), CharacterCounts(32)))
    wanted = ["chunk_id", "chunk_content"]
    found = search.similarity_search(index, "apple", CharacterCounts(32), wanted, 2)
    assert [tuple(r)[:2] for r in found.collect()] == [("b", "apple"), ("a", "apples")]
    own = search.similarity_search(index, "apple", CharacterCounts(32), wanted, filters={"agent_id": "x"})
    assert [r.chunk_id for r in own.collect()] == ["a", "c"] and own.columns == [*wanted, "score"]


def test_many_scores_are_taken_in_parts(corpus, queries, monkeypatch):
    monkeypatch.setattr(search, "MAX_SCORES", 30)
    assert as_set(search.top_k(corpus, queries, Scoring(7, decimals=5))) == brute(7)


def test_scoring_is_checked():
    for bad in ({"metric": "other"}, {"k": 0}):
        with pytest.raises(ValueError):
            Scoring(**bad)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("max_queries", [100, 3])
def test_bad_vectors_leave_only_themselves_out(spark, corpus, queries, metric, max_queries):
    """NULL, NaN and infinite numbers, on either side; NULL groups match nothing."""
    nan, inf = float("nan"), float("inf")
    bad = [("nan", [nan] * 6, "x"), ("inf", [inf] + [0.0] * 5, "x"), ("null", [None] + [1.0] * 5, "y")]
    schema = "chunk_id string, embedding array<float>, grp string"
    dirty = corpus.union(spark.createDataFrame(bad, schema)).coalesce(1)
    asks = [(50, [nan] + [1.0] * 5, "x"), (51, [inf] * 6, "x"), (52, [None] * 6, "y"), (53, None, "y")]
    asked = queries.union(spark.createDataFrame(asks, queries.schema))
    want = brute(7, metric)
    assert as_set(search.top_k(dirty, asked, Scoring(7, metric, 5), max_queries=max_queries)) == want
    nobody = spark.createDataFrame([(60, QUERIES[0][1], None)], queries.schema)
    got = search.top_k(dirty, asked.union(nobody), Scoring(7, metric, 5), group_column="grp", max_queries=max_queries)
    assert as_set(got) == brute(7, metric, grouped=True)


def test_lengths_are_checked_over_all_queries(spark, corpus, queries):
    odd = spark.createDataFrame([(q, [1.0], "x") for q in range(70, 76)], queries.schema)
    with pytest.raises(ValueError):
        search.top_k(corpus, queries.union(odd), Scoring(3), max_queries=3)
