import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from sheafline.sources import buckets, files, tables

SCHEMA = "chunk_id string, text string, n int"


@pytest.fixture
def table():
    return buckets.Keyed(tempfile.mkdtemp(prefix="run-") + "/t", SCHEMA, buckets=16)


def rows_of(spark, table):
    return sorted((tuple(r) for r in buckets.read(spark, table).select("chunk_id", "text", "n").collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame(sorted(rows), SCHEMA)


def test_change_of_one_percent_rewrites_its_buckets_alone(spark, table):
    rows = [(f"k{i}", f"text {i}", i) for i in range(2000)]
    assert {r.op for r in buckets.merge(spark, table, made(spark, rows)).collect()} == {"insert"}
    before = buckets.manifest(spark, table)
    keys = {f"k{i}" for i in range(2000)}
    bucket = {r.chunk_id: r.b for r in made(spark, rows).select("chunk_id", table.bucket_of(F.col("chunk_id")).alias("b")).collect()}
    some = [k for k in sorted(keys) if bucket[k] in (3, 7)][:20]
    after = [(k, "new" if k in some else t, n) for k, t, n in rows]
    changes = buckets.merge(spark, table, made(spark, after))
    assert sorted((r.chunk_id, r.op) for r in changes.collect()) == sorted((k, "update") for k in some)
    now = buckets.manifest(spark, table)
    touched = {bucket[k] for k in some}
    assert {b for b in now.places if now.places[b] != before.places[b]} == touched
    assert set(files.folders(spark, f"{table.root}/data/commit={now.commit}")) == {f"bucket={b}" for b in touched}
    assert rows_of(spark, table) == sorted(after, key=str)
    assert buckets.merge(spark, table, made(spark, after)).isEmpty()
    assert buckets.manifest(spark, table).commit == now.commit


@pytest.mark.parametrize("sent", [buckets.SENT_KEYS, 0])
def test_random_batches_equal_the_source(spark, table, monkeypatch, sent):
    monkeypatch.setattr(buckets, "SENT_KEYS", sent)
    rng, rows = random.Random(sent), {}
    for _ in range(4):
        for k in rng.sample(range(60), 25):
            rows[f"k{k}"] = (f"k{k}", rng.choice(["a", "b", None]), rng.choice([1, 2, None]))
        for k in rng.sample(sorted(rows), min(8, len(rows))):
            rows.pop(k)
        source = made(spark, []) if not rows else spark.createDataFrame(list(rows.values()), SCHEMA)
        buckets.merge(spark, table, source)
        assert set(rows_of(spark, table)) == set(rows.values()) and len(rows_of(spark, table)) == len(rows)
    buckets.merge(spark, table, made(spark, []))
    assert rows_of(spark, table) == []


def test_kept_rows_are_not_shuffled(spark, table):
    buckets.merge(spark, table, made(spark, [(f"k{i}", "x", i) for i in range(500)]))
    kept = buckets.read(spark, table).join(F.broadcast(made(spark, [("k1", "x", 1)]).select("chunk_id")), "chunk_id", "left_anti")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_failed_commit_is_not_seen(spark, table, monkeypatch):
    rows = [(f"k{i}", "x", i) for i in range(50)]
    buckets.merge(spark, table, made(spark, rows))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_commit", fail)
        with pytest.raises(OSError):
            buckets.merge(spark, table, made(spark, rows[:10]))
    assert rows_of(spark, table) == sorted(rows, key=str)
    buckets.merge(spark, table, made(spark, rows[:10]))
    assert rows_of(spark, table) == sorted(rows[:10], key=str)


def test_followers_take_each_commit_once(spark, table):
    target = buckets.Keyed(table.root + "-copy", SCHEMA, buckets=5)
    rows = {f"k{i}": (f"k{i}", "a", i) for i in range(40)}
    for step in range(4):
        rows[f"k{step}"] = (f"k{step}", f"b{step}", step)
        rows.pop(f"k{30 + step}")
        buckets.merge(spark, table, made(spark, rows.values()))
        if step != 1:  # two commits at once
            assert buckets.follow(spark, table, target) == buckets.manifest(spark, table).commit
            assert rows_of(spark, target) == sorted(rows.values(), key=str)
    before = buckets.manifest(spark, target)
    assert buckets.follow(spark, table, target) == before.followed and buckets.manifest(spark, target) == before


def test_batch_that_comes_again_after_a_failure(spark, table, monkeypatch):
    target = buckets.Keyed(table.root + "-copy", SCHEMA, buckets=5)
    rows = [(f"k{i}", "a", i) for i in range(40)]
    buckets.merge(spark, table, made(spark, rows))
    buckets.follow(spark, table, target)
    rows = rows[5:] + [("new", "b", 0)]
    buckets.merge(spark, table, made(spark, rows))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_commit", fail)
        with pytest.raises(OSError):
            buckets.follow(spark, table, target)
    assert len(rows_of(spark, target)) == 40
    buckets.follow(spark, table, target)
    assert rows_of(spark, target) == sorted(rows, key=str)
    # The same commits once more, as after a lost manifest.
    stale = buckets.manifest(spark, target)
    buckets._commit(spark, target, buckets.Manifest(stale.commit, 1, stale.places))
    buckets.follow(spark, table, target)
    assert rows_of(spark, target) == sorted(rows, key=str)


def test_expiry_bounds_the_disk_and_spares_readers(spark, table):
    rows = [(f"k{i}", "x" * 50, i) for i in range(300)]
    buckets.merge(spark, table, made(spark, rows))
    early = buckets.manifest(spark, table)
    reader = buckets.read(spark, table, early)
    sizes = []
    for n in range(12):
        rows[n] = (f"k{n}", f"changed {n}", n)
        buckets.merge(spark, table, made(spark, rows))
        assert buckets.expire(spark, table) == 0  # all of it is young
        if n == 3:
            assert reader.count() == 300
        if n > 5:
            buckets.expire(spark, table, keep=2, seconds=0)
            sizes.append(sum(len(f) for _, _, f in os.walk(table.root)))
    assert rows_of(spark, table) == sorted(rows, key=str)
    assert len(tables.snapshot_paths(spark, f"{table.root}/manifests")) == 2
    assert max(sizes) < 2 * min(sizes)
    # A follower that is too far behind compares the tables instead.
    target = buckets.Keyed(table.root + "-copy", SCHEMA, buckets=5)
    buckets.follow(spark, table, target)
    assert rows_of(spark, target) == sorted(rows, key=str)


def test_snapshots_expire(spark):
    root = tempfile.mkdtemp(prefix="run-") + "/s"
    for n in range(5):
        tables.write_snapshot(spark.range(n), root)
        assert tables.expire_snapshots(spark, root) == 0
    os.makedirs(f"{root}/version=2b".replace("2b", "9"))  # a write that goes on
    assert tables.expire_snapshots(spark, root, keep=2, seconds=0) == 3
    assert sorted(files.folders(spark, root)) == ["version=4", "version=5", "version=9"]
    assert spark.read.parquet(tables.snapshot_path(spark, root)).count() == 4
