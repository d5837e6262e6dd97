import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from sheafline.settings import Settings
from sheafline.sources import landing, tables, walk
from sheafline.streaming import runs

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def write(root, name, text):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "w") as f:
        f.write(text)


def seen(df):
    return sorted((r.path, r.length, r.modificationTime) for r in df.collect())


def test_lists_what_spark_lists(spark):
    root = tempfile.mkdtemp(prefix="run-")
    for name in ("A/x.md", "A/b/c/y [1].md", "보험/문서 1.md", "loose.md", "A/_hidden.md", "A/.crc", "_tmp/z.md"):
        write(root, name, name)
    os.makedirs(root + "/empty")
    got = walk.listing(spark, root)
    assert seen(got) == seen(landing.listing(spark, root)) and got.count() == 4
    assert walk.listing(spark, root + "/empty").count() == 0


def invented(root):
    """A store of 100 folders in 10 groups, 10,000 files in each."""
    base, day = root.rstrip("/").count("/"), DAY

    def entries(folder):
        if folder.rstrip("/").count("/") - base < 2:
            return ((f"f{n}", True, 0, day) for n in range(10))
        return ((f"doc{n}.md", False, n, day + dt.timedelta(seconds=n)) for n in range(10_000))

    return entries


def test_a_million_files(spark):
    root = "file:/nowhere/landing"
    found = walk.listing(spark, root, invented(root), folders_per_task=8)
    assert found.inputFiles() and len(found.inputFiles()) < 200  # a table, not an index of a million files
    one = found.agg(F.count("*").alias("n"), F.count_distinct("path").alias("paths"), F.sum("length").alias("size")).first()
    assert (one.n, one.paths, one.size) == (1_000_000, 1_000_000, 100 * sum(range(10_000)))
    tasks = spark.read.parquet(found.inputFiles()[0].rpartition("/level=")[0]).where("level = 2")
    assert len(tasks.inputFiles()) >= 12  # folders of a level were listed by many tasks


def test_second_run_adds_new_and_overwritten_files(spark):
    root, at = tempfile.mkdtemp(prefix="run-"), tables.Tables(tempfile.mkdtemp(prefix="run-") + "/t")
    settings = Settings(root)
    for n in range(6):
        write(root, f"A/d{n}.md", "one")
    runs.append_ledger(spark, settings, at, lister=walk.by_arrow)
    ledger = lambda: spark.read.parquet(at.ledger)
    assert ledger().count() == 6
    write(root, "A/d0.md", "one more")
    write(root, "B/new.md", "x")
    runs.append_ledger(spark, settings, at, lister=walk.by_arrow)
    names = sorted(r.source_file_name for r in ledger().collect())
    assert names == ["d0.md", "d0.md", *[f"d{n}.md" for n in range(1, 6)], "new.md"]
    runs.append_ledger(spark, settings, at)  # Spark's own listing finds the same files
    assert ledger().count() == 8
