import pytest
from pyspark.sql import functions as F

from sheafline import fixed_values as fv
from sheafline.functions import elements as el, paths, text as tx
from sheafline.operators import chunks, documents, gold, unify
from sheafline.settings import AgentRule, Settings


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").coalesce(1)
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_document_id(spark):
    cases = {"agreement_v1.md": "agreement_v1", "a.tar.gz": "a.tar", ".env": "", "noext": "noext", "a.": "a."}
    assert apply(spark, cases, paths.document_id) == list(cases.values())


def test_file_name(spark):
    assert apply(spark, ["s3://b/k/x y.md", "x", "a/", None], paths.file_name) == ["x y.md", "x", "", None]


def test_doc_path(spark):
    cases = {
        "s3://b/보험/상품/개인/x.md": "보험>상품>개인", "s3://b/x.md": "x.md", "s3a://b/k/x.md": "k",
        "s3://b/k/": "k>", "k/l/x": "k>l", None: None,
    }
    assert apply(spark, cases, paths.doc_path) == list(cases.values())
    local = lambda c: paths.doc_path(c, "file:/tmp/land")
    assert apply(spark, ["file:/tmp/land/보험/상품/a.md"], local) == ["보험>상품"]


def test_agent(spark):
    cases = {
        "보험>상품": "상품", "보험>상품>개인": "상품", "보험>상품권": "Default", "보험>상품권>a": "Default",
        "보험>언더라이팅>개인언더라이팅>x": "개인신계약", "보험>언더라이팅>언더_공통": "단체신계약",
        "보험>변경": "Default", "보험>변경>단체변경>a>b": "단체신계약", "보험>사고보험금": "사고보험금",
        "": "Default", None: "Default",
    }
    assert apply(spark, cases, paths.agent) == list(cases.values())


def test_first_agent_rule_wins(spark):
    rules = [AgentRule("deep", "a>b"), AgentRule("wide", "a"), AgentRule("late", "a>b")]
    got = apply(spark, ["a>b>c", "a>x", "b"], lambda c: paths.agent(c, rules, "none"))
    assert got == ["deep", "wide", "none"]
    assert apply(spark, ["a"], lambda c: paths.agent(c, [], "none")) == ["none"]


def test_slug(spark):
    names = {**fv.CATEGORY_SLUGS, "Other": "other", None: None}
    assert apply(spark, names, paths.table_slug) == list(names.values())


def test_category_needs_a_folder_below_the_root(spark):
    cases = {
        "s3://l/r/CRM/a.md": "CRM", "s3://l/r/CRM/x/a.md": "CRM", "s3://l/r/a.md": None,
        "s3://l/r2/CRM/a.md": None, "s3://l/r//a.md": None,
    }
    for root in ("s3://l/r/", "s3://l/r"):
        assert apply(spark, cases, lambda c: paths.category(c, root)) == list(cases.values())


def test_category_filter_does_not_take_longer_names(spark):
    df = spark.createDataFrame([("s3://l/r/CRM/a",), ("s3://l/r/CRM2/a",)], "source_file string")
    assert documents.in_category(df, "s3://l/r", "CRM").collect()[0][0] == "s3://l/r/CRM/a"
    assert documents.in_category(df, "s3://l/r", "CRM").count() == 1


@pytest.mark.parametrize(
    "glob,yes,no",
    [
        ("**/a/**/*", ["x/a/b", "a/b", "x/y/a/z/b"], ["a", "xa/b", "x/a"]),
        ("*.md", ["x.md", ".md"], ["a/x.md", "xmd"]),
        ("a?c/**", ["abc/", "abc/d/e"], ["a/c/d", "abc"]),
        ("[x]+(y)", ["[x]+(y)"], ["x"]),
    ],
)
def test_globs(spark, glob, yes, no):
    got = apply(spark, yes + no, lambda c: c.rlike(paths.glob_regex(glob)))
    assert got == [True] * len(yes) + [False] * len(no)


def test_tidy(spark):
    cases = {"a\n\n\n\nb": "a\n\nb", "a\n\nb": "a\n\nb", "  a ": "a", "\n\n\n": "\n\n",
             " \n a \n": "\n a \n", "a\r\n\r\n\r\nb": "a\r\n\r\n\r\nb", None: None}
    assert apply(spark, cases, tx.tidy) == list(cases.values())


def bronze(spark, contents):
    rows = [(f"d{i}.md", f"s3://b/d{i}.md", c, 1) for i, c in enumerate(contents)]
    df = spark.createDataFrame(rows, "source_file_name string, source_file string, content binary, file_size_bytes bigint")
    df = df.withColumn("file_modified_at", F.current_timestamp()).withColumn("ingested_at", F.current_timestamp())
    return documents.label_bronze(df)


def test_silver_drops_texts_of_spaces_only(spark):
    got = documents.silver_documents(bronze(spark, [b"a", b"", b"   ", b"\n\n\n", None, "가\n\n\n나 ".encode()]))
    assert got.columns == documents.SILVER
    assert [(r.document_id, r.full_text) for r in got.collect()] == [("d0", "a"), ("d3", "\n\n"), ("d5", "가\n\n나")]


def test_invalid_utf8(spark):
    bad = bronze(spark, [b"a\xffb"])
    text = documents.silver_documents(bad).select(F.is_valid_utf8("full_text")).first()[0]
    assert text is False
    assert documents.silver_documents(bad, repair=True).first().full_text == "a\ufffdb"


def test_bronze_keeps_arrivals_and_takes_current_bytes(spark):
    arrivals = spark.sql(
        "select 'a.md' source_file_name, 's3://b/a.md' source_file, 3L file_size_bytes, timestamp'2024-01-01' file_modified_at,"
        " timestamp'2024-01-02' ingested_at union all select 'a.md', 's3://b/a.md', 4L, timestamp'2024-02-01', timestamp'2024-02-02'"
        " union all select 'gone.md', 's3://b/gone.md', 1L, timestamp'2024-02-01', timestamp'2024-02-02'"
    )
    files = spark.createDataFrame([("s3://b/a.md", b"new", 99), ("s3://b/other.md", b"x", 1)], "path string, content binary, length bigint")
    for small in (False, True):
        got = documents.bronze_documents(arrivals, files, small)
        assert got.columns == documents.BRONZE
        assert sorted((r.file_size_bytes, bytes(r.content)) for r in got.collect()) == [(3, b"new"), (4, b"new")]


def test_html_tables(spark):
    table = "<table><tr><td>a</td><th>b</th></tr><tr><td>c</td></tr></table>"
    assert apply(spark, [table], tx.html_element) == ["a | b\nc\n"]
    rows = "<tr><td rowspan=2>a</td></tr>\n\n\n<p>x</p>   "
    assert apply(spark, [rows], tx.html_document) == ["a\n\nx"]
    assert apply(spark, [rows], tx.html_element) == ["a\n\n\n\nx"]


def test_preview(spark):
    assert apply(spark, ["가" * 600, "a", None], tx.preview) == ["가" * 500, "a", None]


DOC = """{"document": {"elements": [
  {"type": "text", "page": 1, "content": "one"},
  {"type": "text", "page": 1, "content": "  "},
  {"type": "table", "page": "2", "content": "<tr><td>x</td><td>y</td></tr>"},
  {"type": "figure", "page": 2, "description": "drawn", "content": "seen"},
  {"type": "figure", "page": 3, "content": "only content"},
  {"type": "figure", "page": 3, "description": " "},
  {"page": 3, "content": "no type"},
  {"type": "text", "page": "p", "content": 5}
], "pages": [{}, {}, {}]}}"""
FAILED = '{"document": {"elements": "none"}, "error_status": "unreadable"}'


@pytest.fixture
def parsed(spark):
    df = spark.createDataFrame([("ok", DOC), ("failed", FAILED), ("odd", "3")], "document_id string, j string")
    return df.select("document_id", F.parse_json("j").alias("parsed_content")).coalesce(1)


def test_parsed_documents(parsed):
    p = F.col("parsed_content")
    rows = parsed.select(
        "document_id", el.element_text(p).alias("t"), el.figure_text(p).alias("f"), el.page_count(p).alias("n")
    ).collect()
    assert rows[0].t == "one\n\n<tr><td>x</td><td>y</td></tr>\n\n5"
    assert rows[0].f == "drawn\n\nonly content"
    assert rows[0].n == 3
    assert [(r.t, r.f, r.n) for r in rows[1:]] == [("", "", None), ("", "", None)]
    assert [r.document_id for r in chunks.parsed_ok(parsed).collect()] == ["ok", "odd"]


def test_elements_keep_their_numbers(parsed):
    rows = chunks.explode_elements(parsed).collect()
    assert [(r.element_idx, r.element_type, r.element_page, r.element_text) for r in rows] == [
        (0, "text", 1, "one"), (2, "table", 2, "x | y\n"), (3, "figure", 2, "seen"),
        (4, "figure", 3, "only content"), (6, None, 3, "no type"), (7, "text", None, "5"),
    ]


def test_elements_can_be_chunked(parsed):
    named = parsed.withColumn("source_file_name", F.lit("f")).withColumn("source_file", F.lit("s3://b/f"))
    rows = chunks.chunk_elements(chunks.explode_elements(named)).collect()
    assert [(r.element_idx, r.chunk_idx, r.element_type) for r in rows][:2] == [(0, 0, "text"), (2, 0, "table")]


def test_chunk_ids_and_metadata(spark):
    import hashlib

    df = spark.sql("select 'd' document_id, 's3://b/보험/상품/d.md' source_file, 0 element_idx, 7 chunk_idx"
                   " union all select null, 's3://b/보험/상품/d.md', 0, 7")
    a, b = gold.keyed_chunks(df).collect()
    assert a.chunk_id == hashlib.md5(b"d_0_7").hexdigest() and b.chunk_id is None
    assert a.metadata == '{"doc_path":"보험>상품","agent_id":"상품"}'
    scoped = gold.keyed_chunks(df, id_scope="path").first().chunk_id
    assert scoped == hashlib.md5("s3://b/보험/상품/d.md_d_0_7".encode()).hexdigest()
    none = df.withColumn("source_file", F.lit(None).cast("string"))
    assert gold.keyed_chunks(none).first().metadata == '{"agent_id":"Default"}'


def test_unify(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    union, skipped = unify.unify_tables({"a": a, "gone": None, "b": b, "empty": a.limit(0)}, ["n", "s"])
    assert sorted(map(tuple, union.collect())) == [(1, "x"), (1, "x"), (2, "y")]
    assert skipped == ["gone", "empty"]
    with pytest.raises(ValueError):
        unify.unify_tables({"gone": None, "empty": a.limit(0)}, ["n", "s"])
    table = a.withColumn("category", F.lit("A"))
    assert unify.unify_partitions(table, ["A", "B"]).count() == 2
    with pytest.raises(ValueError):
        unify.unify_partitions(table, ["B"])


def test_settings(spark):
    assert Settings("s3://b/r").landing_root == "s3://b/r/"
    assert Settings.from_session(spark, "s3://b/d").landing_root == "s3://b/d/"
    spark.conf.set("s3_landing_path", "s3://other/r")
    try:
        assert Settings.from_session(spark, "s3://b/d").landing_root == "s3://other/r/"
    finally:
        spark.conf.unset("s3_landing_path")
    with pytest.raises(ValueError):
        Settings("x", id_scope="other")
