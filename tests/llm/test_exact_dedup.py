import hashlib
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sheafline.llm import common, exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    low = lambda x: -1 if x is None else x
    return sorted((low(i), low(max(groups[t or ""], key=low)), len(groups[t or ""])) for i, t in rows)


def told(df):
    low = lambda x: -1 if x is None else x
    return sorted((low(r.doc_id), low(r.keep_id), r.group_size) for r in df.collect())


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.length(t).cast("string")])
def test_equals_brute_force_also_when_digests_collide(table, odd_rows, digest):
    rows = odd_rows + [(20, "ab"), (21, "cd"), (22, "ab"), (23, "cd"), (24, "ef")]
    docs = table(rows)
    out = exact_dedup.assign(docs, digest=digest)
    assert told(out) == brute(rows)
    assert out.filter("kept").count() == len({t or "" for _, t in rows})


def test_keeps_one_row_with_its_columns(table, odd_rows):
    out = exact_dedup.deduplicate(table(odd_rows))
    assert out.columns == table(odd_rows).columns
    texts = [r.text or "" for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in odd_rows})
    assert {r.doc_id for r in out.collect() if r.text == "a b c d e f g"} == {1}


def test_empty_table(table):
    assert exact_dedup.assign(table([])).count() == 0
    assert exact_dedup.deduplicate(table([])).count() == 0


def test_stream_goes_on_from_its_state(spark, table):
    source, state = common.new_path(spark, "in"), common.new_path(spark, "state")

    def arrive(rows):
        placed = exact_dedup.located(table(rows))
        arriving = exact_dedup.arrivals(placed, "doc_id", "text", exact_dedup.sha256)
        arriving.write.mode("append").parquet(source)
        groups = exact_dedup.run_stream(spark, source, arriving.schema, state, files_per_batch=1)
        return {r.digest: (r.keep.doc_id, r.n) for r in groups.collect()}

    a, b = (hashlib.sha256(x).hexdigest() for x in (b"a", b"b"))
    assert arrive([(1, "a"), (2, "b")]) == {a: (1, 1), b: (2, 1)}
    assert arrive([(5, "a"), (3, "a")]) == {a: (5, 3), b: (2, 1)}
    assert arrive([(4, "b")]) == {a: (5, 3), b: (4, 2)}


def test_state_has_few_files_and_one_batch_is_not_written_again(spark, table):
    source, state = common.new_path(spark, "in"), common.new_path(spark, "state")
    arriving = exact_dedup.arrivals(
        exact_dedup.located(table([(1, "a"), (2, "b"), (3, "a")])), "doc_id", "text", exact_dedup.sha256
    )
    arriving.write.parquet(source)
    before = {k: spark.conf.get(k, None) for k in exact_dedup.STATE}
    groups = exact_dedup.run_stream(spark, source, arriving.schema, state)
    assert sorted((r.keep.doc_id, r.n) for r in groups.collect()) == [(2, 1), (3, 2)]
    assert all("/out/batch=0/" in f for f in groups.inputFiles())
    assert {k: spark.conf.get(k, None) for k in exact_dedup.STATE} == before
    made = [p.name for p in Path(state.removeprefix("file:"), "checkpoint").rglob("*") if p.is_file()]
    # Beside Hadoop's own, which are hidden, no checksum of a file.
    assert any(n.endswith(".zip") for n in made)
    assert not [n for n in made if n.endswith(".crc") and not n.startswith(".")]


@pytest.mark.parametrize("from_files", [False, True])
def test_columns_with_inner_names(spark, table, odd_rows, from_files):
    names = ["_metadata", "__file", "__row", "c0", "keep", "digest", "a b", "x.y"]
    docs = table(odd_rows).select("doc_id", "text", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    if from_files:
        path = common.new_path(spark, "clash")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    assert told(exact_dedup.assign(docs)) == brute(odd_rows)
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert {tuple(r)[2:] for r in out.collect()} == {tuple(range(8))} and out.count() == len({t or "" for _, t in odd_rows})
