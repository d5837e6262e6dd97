import pytest

from sheafline.llm import common


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_without_is_the_same_sent_or_shuffled(table, odd_rows, monkeypatch, most):
    monkeypatch.setattr(common, "SENT_ROWS", most)
    docs = table(odd_rows)
    gone = common.marked(docs).filter("doc_id is null or doc_id in (1, 9)").filter("text like 'a b%' or text = 'x'")
    left = common.without(docs, gone, "test")
    assert left.columns == docs.columns
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in left.collect())
    lost = {(1, "a b c d e f g"), (-1, "a b c d e f g"), (9, "x")}
    want = sorted((-1 if i is None else i, t or "") for i, t in odd_rows)
    assert got == [r for r in want if r not in lost]


def test_shared_folder_is_one_that_the_cluster_shares(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert common.new_path(spark, "x").startswith(base.rstrip("/"))
