import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sheafline.operators import ledger, numbering

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "source_file string, source_file_name string, file_size_bytes bigint, file_modified_at timestamp, ingested_at timestamp"


def arrivals(spark, rows):
    data = [(f, f"{f}.md", size, None if m is None else DAY + dt.timedelta(microseconds=m), DAY + dt.timedelta(seconds=i))
            for f, size, m, i in rows]
    return spark.createDataFrame(data, SCHEMA)


def crowded_rows(seed=3):
    """One file with most of the rows, many of them at one moment, some with no time."""
    rng = random.Random(seed)
    rows = [("hot", n, rng.choice([5, 5, 5, rng.randrange(10**6), None]), rng.randrange(50)) for n in range(3000)]
    rows += [(f"cold{n % 40}", n, rng.randrange(1000), n) for n in range(400)]
    rows += [(None, n, n, n) for n in range(5)]
    rng.shuffle(rows)
    return rows


def brute(rows):
    first = -(10**9)
    files = {}
    for r in rows:
        files.setdefault(r[0], []).append(r)
    out = set()
    for name, group in files.items():
        group.sort(key=lambda r: (first if r[2] is None else r[2], r[3], r[1]))
        out |= {(name, r[1], n, len(group), n == len(group)) for n, r in enumerate(group, 1)}
    return out


def as_set(df):
    got = df.select("source_file", "file_size_bytes", "version_number", "total_versions", "is_latest_version").collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


@pytest.mark.parametrize("ranges", [None, 100, 8, 1])
def test_versions_are_the_same_however_rows_are_cut(spark, ranges):
    rows = crowded_rows()
    assert as_set(ledger.document_versions(arrivals(spark, rows), ranges=ranges)) == brute(rows)


def test_crowd_without_a_name_is_one_file(spark):
    rows = [(None, n, n % 7, 0) for n in range(2000)] + [("a", 1, 1, 1), ("b", 1, 1, 1)]
    assert as_set(ledger.document_versions(arrivals(spark, rows), ranges=16)) == brute(rows)


def test_ranges_are_even_also_inside_one_file(spark):
    """Nine rows of ten are one file's, all of one moment; they differ in a later column only."""
    rows = [("hot", n, 7, 0) for n in range(9000)] + [(f"f{n}", n, n, n) for n in range(1000)]
    df = arrivals(spark, rows)
    order = ["file_modified_at", "ingested_at", "file_size_bytes"]
    counted = numbering._counted(df, numbering.COPIES_PER_BLOCK)
    placed = numbering._with_ranges(counted, ["source_file", *order, "source_file_name", "_block"], 16)
    sizes = [r["count"] for r in placed.groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 10_000 / 16
    hot = {r["_range"] for r in placed.where("source_file = 'hot'").select("_range").distinct().collect()}
    assert len(hot) >= 14
    assert numbering._earlier(placed, "source_file").count() <= 2 * 16
    assert as_set(ledger.document_versions(df, ranges=16)) == brute(rows)


def test_window_is_dealt_by_range_and_file(spark):
    plan = ledger.document_versions(arrivals(spark, crowded_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_range" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("block", [10_000, 7])
def test_exact_copies_are_all_kept(spark, block):
    rows = [("hot", 1, 5, 0)] * 500 + [("hot", 2, 5, 0)] * 3 + [("hot", 1, 4, 0)]
    got = ledger.document_versions(arrivals(spark, rows), ranges=4, copies_per_block=block)
    pairs = sorted((r.version_number, r.file_size_bytes, r.total_versions) for r in got.collect())
    assert pairs == [(n, 2 if 501 < n else 1, 504) for n in range(1, 505)]


def test_many_copies_of_one_row_are_many_rows_to_deal(spark):
    df = arrivals(spark, [("hot", 1, 5, 0)] * 4000)
    order = ["file_modified_at", "ingested_at", "file_size_bytes"]
    placed = numbering._with_ranges(numbering._counted(df, 10), ["source_file", *order, "_block"], 8)
    assert placed.select("_range").distinct().count() == 8
    assert placed.agg(F.sum("_copies")).first()[0] == 4000


def test_latest_equals_flagged_versions(spark):
    rows = [r for r in crowded_rows(8) if r[0] is not None]
    df = arrivals(spark, rows)
    latest = ledger.latest_documents(df)
    flagged = ledger.document_versions(df).where("is_latest_version").select(*latest.columns)
    assert sorted(map(str, latest.collect())) == sorted(map(str, flagged.collect()))


def test_increment_sees_new_and_overwritten_files_once(spark):
    old = arrivals(spark, [("a", 1, 1, 0), ("b", 1, 1, 0)])
    found = arrivals(spark, [("a", 1, 1, 9), ("b", 2, 1, 9), ("c", 1, 1, 9), ("a", 1, 2, 9)])
    new = ledger.ledger_increment(found, old)
    assert sorted((r.source_file, r.file_size_bytes) for r in new.collect()) == [("a", 1), ("b", 2), ("c", 1)]
    assert ledger.ledger_increment(found, old.unionByName(new)).isEmpty()
