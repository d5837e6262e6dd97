import datetime as dt
import random
import tempfile

import pytest

from sheafline.operators import ledger
from sheafline.sources import buckets, tables
from sheafline.streaming import runs

DAY = dt.datetime(2024, 1, 1)


def arrivals(spark, rng, n, run):
    rows = []
    for i in range(n):
        name = rng.choice(["hot", "hot", *[f"f{k}" for k in range(30)], None])
        changed = DAY + dt.timedelta(seconds=rng.randrange(1000))  # late ones among them
        rows.append((name, f"{name}.md", run * 1000 + i, changed, DAY + dt.timedelta(days=run)))
    return spark.createDataFrame(rows, tables.LEDGER)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_batches_equal_the_full_history(spark, files_per_batch):
    at, rng = tables.Tables(tempfile.mkdtemp(prefix="run-") + "/t"), random.Random(files_per_batch)
    for run in range(3):
        arrivals(spark, rng, 40, run).coalesce(2).write.mode("append").parquet(at.ledger)
        runs.run_versions(spark, at, files_per_batch)
        whole = ledger.document_versions(spark.read.schema(tables.LEDGER).parquet(at.ledger))
        assert rows_of(runs.read_versions(spark, at)) == rows_of(whole)
    runs.run_versions(spark, at)
    assert rows_of(runs.read_versions(spark, at)) == rows_of(whole)


def test_only_buckets_of_arrived_files_are_written_and_a_batch_counts_once(spark):
    at, rng = tables.Tables(tempfile.mkdtemp(prefix="run-") + "/t"), random.Random(7)
    first = arrivals(spark, rng, 80, 0)
    runs._versions_batch(first, 0, at)
    table = runs.versions_table(at)
    before = buckets.manifest(spark, table)
    one = first.where("source_file = 'f3'").limit(1)
    runs._versions_batch(one, 1, at)
    after = buckets.manifest(spark, table)
    assert sum(after.places[b] != before.places.get(b) for b in after.places) == 1
    rows = rows_of(runs.read_versions(spark, at))
    runs._versions_batch(one, 1, at)  # comes again after a failure
    assert buckets.manifest(spark, table) == after and rows_of(runs.read_versions(spark, at)) == rows
