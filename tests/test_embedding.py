import numpy as np
from pyspark.sql import functions as F

from sheafline.functions.embedding import CharacterCounts, embed
from sheafline.operators import checks


def vectors(spark, texts, embedder, batch=32):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    rows = df.select("id", embed(F.col("text"), embedder, batch).alias("v")).orderBy("id").collect()
    return [r.v for r in rows]


def test_counts_of_characters(spark):
    a, b, c = vectors(spark, ["aab", None, "가"], CharacterCounts(8))
    assert a == [0, 2, 1, 0, 0, 0, 0, 0]
    assert b == [0] * 8
    assert c[ord("가") % 8] == 1 and sum(c) == 1


def test_texts_come_in_sub_batches(spark):
    def sizes(texts):
        return [[float(len(texts))] for _ in texts]

    got = [v[0] for v in vectors(spark, ["x"] * 65, sizes)]
    assert got == [32.0] * 64 + [1.0]


def test_a_failed_call_loses_its_sub_batch_only(spark):
    def picky(texts):
        if "bad" in texts:
            raise RuntimeError("down")
        return [[1.0, 2.0] for _ in texts]

    got = vectors(spark, ["x"] * 5 + ["bad"] + ["x"] * 6, picky, batch=4)
    assert got == [[1, 2]] * 4 + [None] * 4 + [[1, 2]] * 4


def test_a_reply_of_the_wrong_length_is_a_failure(spark):
    got = vectors(spark, ["a", "b", "c"], lambda texts: [[3.0]], batch=2)
    assert got == [None, None, [3.0]]
    assert vectors(spark, ["a", "b"], lambda texts: [[1.0]]) == [None, None]


def test_replies_may_be_arrays_or_hold_none(spark):
    assert vectors(spark, ["a", "b"], lambda t: np.ones((len(t), 3))) == [[1, 1, 1]] * 2
    assert vectors(spark, ["a", "b"], lambda t: [None, [1.0]]) == [None, [1.0]]
    assert vectors(spark, ["a", "b"], lambda t: 1 / 0) == [None, None]


def test_health(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [])], "chunk_id int, embedding array<float>")
    assert tuple(checks.embedding_health(df, 2).first()) == (4, 1, 2, 1)
    assert [r.chunk_id for r in checks.to_embed_again(df, 2).collect()] == [2, 3, 4]


def test_only_a_sub_batch_of_texts_is_taken_out_of_arrow(spark, monkeypatch):
    """A worker holds the texts of one sub-batch as strings, not those of the Arrow batch."""
    import pyarrow as pa

    udf = {}
    monkeypatch.setattr(F, "arrow_udf", lambda run, kind, f=F.arrow_udf: udf.update(run=run) or f(run, kind))
    embed(F.lit("a"), CharacterCounts(4), 3)

    class Texts:
        def __init__(self, texts):
            self.texts = texts

        def __len__(self):
            return len(self.texts)

        def slice(self, at, n):
            return Texts(self.texts[at : at + n])

        def to_pylist(self):
            assert len(self) <= 3
            return self.texts

    ten, none = udf["run"](iter([Texts(["a", None, "bb"] * 3 + ["c"]), Texts([])]))
    assert ten.to_pylist() == [CharacterCounts(4)([t])[0].tolist() for t in ["a", "", "bb"] * 3 + ["c"]]
    assert len(none) == 0 and none.type == ten.type == pa.list_(pa.float32())
