from sheafline.operators import checks, report, sync

KIND = "chunk_id string, a string, b string, at int"
OLD = [("same", "x", None, 1), ("moved", None, "x", 1), ("text", "x", "y", 1), ("gone", "x", "y", 1)]
NEW = [("same", "x", None, 2), ("moved", "x", None, 2), ("text", "z", "y", 2), ("fresh", None, None, 2)]
COLUMNS = ["chunk_id", "a", "b"]


def changes(source, index):
    return sync.index_changes(source, index, COLUMNS)


def test_changes_and_their_application(spark):
    old, new = spark.createDataFrame(OLD, KIND), spark.createDataFrame(NEW, KIND)
    ops = changes(new, old)
    assert dict(ops.select("chunk_id", "op").collect()) == {"moved": "update", "text": "update", "gone": "delete", "fresh": "insert"}
    after = sync.apply_changes(old, new, ops, COLUMNS)
    want = {t[:3] for t in NEW}
    assert {tuple(r) for r in after.collect()} == want and after.count() == 4
    assert changes(new, after).isEmpty()
    again = sync.apply_changes(after, new, ops, COLUMNS)
    assert {tuple(r) for r in again.collect()} == want and again.count() == 4


def test_repeated_source_keys_count_once(spark):
    rows = [("k", "old", "z", 1), ("k", "new", "a", 2), ("k", "new", "a", 3), ("k", "new", "a", 3), ("l", None, None, None)]
    source, index = spark.createDataFrame(rows * 20, KIND), spark.createDataFrame(OLD, KIND)
    ops = sync.index_changes(source, index, COLUMNS, ["at"])
    assert ops.count() == 6
    after = sync.apply_changes(index, source, ops, COLUMNS, ["at"])
    assert sorted(tuple(r) for r in after.collect()) == [("k", "new", "a"), ("l", None, None)]
    assert sync.index_changes(source, after, COLUMNS, ["at"]).isEmpty()


def test_first_and_last_sync(spark):
    new = spark.createDataFrame(NEW, KIND)
    none = new.limit(0)
    assert {r.op for r in changes(new, none).collect()} == {"insert"}
    assert {r.op for r in changes(none, new).collect()} == {"delete"}


def test_latest_row_of_a_key(spark):
    rows = [("k", "old", "z", 1), ("k", "new", "a", 2), ("k", "new", "b", 2), ("k", "new", "b", 2), ("l", None, None, None)]
    got = sync.latest_per_key(spark.createDataFrame(rows * 50, KIND), ["at"])
    assert got.columns == ["chunk_id", "a", "b", "at"]
    assert {tuple(r) for r in got.collect()} == {("k", "new", "b", 2), ("l", None, None, None)}


def test_tally(spark):
    df = spark.createDataFrame([("ok",), ("ok",), ("failed",), (None,)], "status string")
    assert tuple(sync.tally(df, ["ok"]).first()) == (2, 2, 4)
    assert tuple(sync.tally(df.limit(0), ["ok"]).first()) == (0, 0, 0)


def test_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, None), (None, 1)], "k string, v int")
    assert [tuple(r) for r in checks.pk_violations(df, "k").collect()] == [("a", 2)]
    assert dict(checks.not_null_violations(df, ["k", "v"]).collect()) == {"k": 2, "v": 2}
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert [tuple(r) for r in checks.fk_orphans(df, parent, "k").collect()] == [("b", 1)]


def test_counters(spark):
    chunks = spark.createDataFrame([("d", "f", "c1"), ("d", "f", "c2"), ("e", "f", None)], "document_id string, source_file_name string, chunk_id string")
    assert report.counters(chunks).first().asDict() == {
        "document_count": 2, "source_file_count": 1, "chunk_count": 2, "row_count": 3}
    gold = chunks.limit(1)
    both = report.counters(chunks, gold).first()
    assert (both.document_count, both.chunk_count, both.row_count) == (2, 1, 1)
    assert report.counters(chunks, approximate=True).first().document_count == 2
    assert dict(report.chunks_per_document(chunks).collect()) == {"d": 2, "e": 0}
