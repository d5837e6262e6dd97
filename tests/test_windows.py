import pytest
from hypothesis import HealthCheck, given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from sheafline.functions import windows
from sheafline.operators import chunks
from sheafline.settings import ChunkRule, ChunkSpec, default_chunk_rules


def brute(text, size, step):
    """Windows by slicing, blank ones dropped before numbering."""
    starts = range(0, len(text or ""), step)
    kept = [(s, text[s : s + size]) for s in starts if text[s : s + size].strip()]
    return [(i, t, s, s + len(t)) for i, (s, t) in enumerate(kept)]


def cut(spark, texts, spec):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = df.select("id", windows.chunks(F.col("text"), spec).alias("c")).orderBy("id").collect()
    return [[tuple(c) for c in r.c] for r in rows]


EDGES = [
    None, "", " ", "\n\n", "　 \u001c", "x", "a" * 800, "a" * 801, "a" * 1000, "a" * 1001,
    "가" * 1801, "😀" * 1001, "a" * 900 + " " * 2600 + "b" * 100, "  \n" + "é\r\n" * 700, "\x85 " * 900 + "z",
]


@pytest.mark.parametrize(
    "size,overlap", [(1000, 200), (500, 100), (500, 0), (10, 9), (7, 3), (1000, 900)]
)
def test_windows_equal_slicing(spark, size, overlap):
    got = cut(spark, EDGES, ChunkSpec("overlap", size, overlap))
    assert got == [brute(t, size, size - overlap) for t in EDGES]


@hyp(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.text(st.sampled_from("ab \n\t가😀é　"), max_size=60), min_size=1, max_size=20),
    st.integers(1, 12),
    st.integers(0, 11),
)
def test_windows_equal_slicing_on_any_text(spark, texts, size, overlap):
    overlap = min(overlap, size - 1)
    got = cut(spark, texts, ChunkSpec("overlap", size, overlap))
    assert got == [brute(t, size, size - overlap) for t in texts]


def test_untrimmed_chunks_put_together_give_the_text(spark):
    text = "".join(chr(97 + i % 26) for i in range(5000))
    (got,) = cut(spark, [text], ChunkSpec())
    joined = "".join(t[: 800 if i + 1 < len(got) else None] for i, t, *_ in got)
    assert joined == text


def test_whole_text_is_one_chunk(spark):
    assert cut(spark, ["abc" * 900, " \n", None], ChunkSpec("none")) == [[(0, "abc" * 900, 0, 2700)], [], []]


def test_schema_of_chunks(spark):
    df = spark.createDataFrame([("a",)], "text string").select(windows.chunks(F.col("text"), ChunkSpec()).alias("c"))
    fields = df.schema["c"].dataType.elementType
    assert [(f.name, f.dataType.simpleString()) for f in fields] == [
        ("chunk_index", "int"), ("chunk_text", "string"), ("start_offset", "int"), ("end_offset", "int"),
    ]


@pytest.mark.parametrize("size,overlap", [(100, 100), (100, 101), (0, 0), (10, -1)])
def test_overlap_not_below_size_is_refused(size, overlap):
    with pytest.raises(ValueError):
        ChunkSpec("overlap", size, overlap)


def silver(spark, *texts, folder="s3://b/k"):
    rows = [(f"d{i}", f"d{i}.md", f"{folder}/d{i}.md", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "document_id string, source_file_name string, source_file string, full_text string")


def test_long_text_is_linear_work(spark):
    text = "abcdé 😀fgh 한글 " * 200_000
    got = chunks.chunk_documents(silver(spark, text)).agg(F.count("*"), F.max("chunk_idx")).first()
    n = -(-len(text) // 800)
    assert tuple(got) == (n, n - 1)


def test_chunk_rows(spark):
    gap = "a" * 900 + " " * 2600 + "b" * 100
    dense = chunks.chunk_documents(silver(spark, gap)).orderBy("chunk_idx").collect()
    assert [r.chunk_idx for r in dense] == [0, 1, 2]
    assert [r.chunk_content for r in dense] == ["a" * 900, "a" * 100, "b" * 100]
    gaps = chunks.chunk_documents(silver(spark, gap), positional=True).orderBy("chunk_idx").collect()
    assert [r.chunk_idx for r in gaps] == [0, 1, 4]
    assert {(r.element_type, r.element_page, r.element_idx, r.chunk_type) for r in dense} == {("text", None, 0, "overlap")}


def test_newlines_stay_and_spaces_go(spark):
    (row,) = chunks.chunk_documents(silver(spark, " \n a \n ")).collect()
    assert row.chunk_content == "\n a \n"
    assert chunks.chunk_documents(silver(spark, "\n\n", "   ", None)).isEmpty()


def test_text_of_900_is_two_single_chunks(spark):
    rows = chunks.chunk_documents(silver(spark, "x" * 900)).orderBy("chunk_idx").collect()
    assert [(len(r.chunk_content), r.chunk_type) for r in rows] == [(900, "single"), (100, "single")]


def test_strategy_by_path(spark):
    paths = {
        "s3://bucket/landing/documents/summaries/a.pdf": (1, "none"),
        "s3://bucket/landing/documents/raw_text/a.pdf": (2, "fixed"),
        "s3://bucket/landing/documents/raw_text/x/y/a.pdf": (2, "fixed"),
        "s3://bucket/landing/documents/raw_text/a.md": (0, "none"),
        "s3://bucket/landing/documents/contracts/a.pdf": (3, "overlap"),
        "s3://bucket/contracts.pdf": (0, "none"),
    }
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select("p", chunks.chunk_strategy(F.col("p")).alias("s")).collect()
    assert {r.p: (r.s.rule, r.s["mode"]) for r in got} == paths


def test_strategy_overlap_everywhere_equals_plain_chunks(spark):
    docs = silver(spark, "q" * 5000, "w" * 900, "", None)
    everywhere = [ChunkRule("**", ChunkSpec())]
    a = chunks.chunk_by_strategy(docs, everywhere).drop("chunk_mode", "chunked_at").collect()
    b = chunks.chunk_documents(docs).drop("chunked_at").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_no_rules_means_whole_texts(spark):
    rows = chunks.chunk_by_strategy(silver(spark, "q" * 5000), []).collect()
    assert [(len(r.chunk_content), r.chunk_mode, r.chunk_type) for r in rows] == [(5000, "none", "single")]


def test_default_rules_in_order():
    assert [r.spec.mode for r in default_chunk_rules()] == ["none", "fixed", "overlap"]
