import os
import tempfile

from pyspark.sql import functions as F

from sheafline.functions import embedding as em
from sheafline.operators import vectors


def noting(folder):
    """An embedder that writes down the texts it is given, and fails on sub-batches with a bad one."""

    class Writes(em.CharacterCounts):
        def __call__(self, texts):
            if "bad" in texts:
                raise ValueError("bad")
            with open(f"{folder}/{os.getpid()}", "a") as f:
                f.writelines(t + "\n" for t in texts)
            return em.CharacterCounts.__call__(self, texts)

    return Writes(8)


def noted(folder):
    return sorted(line for name in os.listdir(folder) for line in open(f"{folder}/{name}").read().splitlines())


def test_equal_texts_cost_one_call(spark):
    folder, path = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="run-") + "/store"
    rows = spark.createDataFrame([(n, f"text {n % 5}") for n in range(100)] + [(200, None), (201, "")], "n int, chunk_content string")
    vectors.fill(spark, rows.where("n < 50"), path, noting(folder))
    store = vectors.fill(spark, rows, path, noting(folder))
    assert noted(folder) == ["", *[f"text {n}" for n in range(5)]]
    out = vectors.attach(rows, store)
    assert out.columns == ["n", "chunk_content", "embedding"] and out.count() == 102
    want = em.CharacterCounts(8)
    assert all(list(r.embedding) == list(want([r.chunk_content or ""])[0]) for r in out.collect())


def test_failed_sub_batches_whole_or_halved(spark):
    rows = spark.createDataFrame([(n, "bad" if n == 13 else f"t{n}") for n in range(40)], "n int, chunk_content string").coalesce(1)
    for halve, lost in ((False, 10), (True, 1)):
        folder, path = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="run-") + "/store"
        made = rows.select("n", em.embed(F.col("chunk_content"), noting(folder), 10, halve).alias("v"))
        assert sum(r.v is None for r in made.collect()) == lost
        store = vectors.fill(spark, rows, path, noting(folder), batch=10, halve=halve)
        missing = {r.n for r in vectors.attach(rows, store).where("embedding IS NULL").collect()}
        assert 13 in missing and (missing == {13}) == halve


def test_text_that_failed_is_tried_again(spark):
    folder, path = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="run-") + "/store"
    rows = spark.createDataFrame([("bad",), ("good",)], "chunk_content string")
    assert vectors.fill(spark, rows, path, noting(folder), batch=1).count() == 1
    assert vectors.fill(spark, rows, path, em.CharacterCounts(8)).count() == 2
