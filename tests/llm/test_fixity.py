import pytest

from sheafline.llm import fixity

SCHEMA = "file long, offset long, bytes binary, node string, digest int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "n", None) for r in rows], SCHEMA).repartition(3)


def replica(rng, files, records):
    rows = []
    for f in range(files):
        at = 0
        for _ in range(rng.randrange(1, records)):
            body = rng.randbytes(rng.randrange(0, 30))
            rows.append((f, at, body))
            at += max(1, len(body))
    return rows


def places(found):
    return {(r.file, r.first_a if r.first_a is not None else r.first_b) for r in found.collect()}


@pytest.mark.parametrize("fan", [2, 16])
def test_finds_changed_records(spark, rng, fan):
    a = replica(rng, 40, 60)
    hurt = set(rng.sample(range(len(a)), 7))
    b = [(f, o, x[:-1] + b"#" if i in hurt and x else x) for i, (f, o, x) in enumerate(a)]
    want = {(f, o) for (f, o, x), (_, _, y) in zip(a, b, strict=True) if x != y}
    assert places(fixity.audit(table(spark, a), table(spark, b), fan)) == want


def test_replicas_alike(spark, rng):
    a = replica(rng, 12, 30)
    assert fixity.audit(table(spark, a), table(spark, a[::-1])).count() == 0


def test_missing_records_files_and_replicas(spark, rng):
    a = replica(rng, 5, 40)
    whole = {(f, o) for f, o, _ in a}
    assert places(fixity.audit(table(spark, a), table(spark, [r for r in a if r[0] != 3]))) == {p for p in whole if p[0] == 3}
    last = max(a)
    assert places(fixity.audit(table(spark, a), table(spark, [r for r in a if r != last]))) == {last[:2]}
    assert places(fixity.audit(table(spark, a), table(spark, []))) == whole
    assert places(fixity.audit(table(spark, []), table(spark, a))) == whole
    assert fixity.audit(table(spark, []), table(spark, [])).count() == 0


def test_missing_files_beside_a_file_that_was_cut(spark):
    """The replicas' trees differ in depth, and each way round a file is only in the shallower one."""
    deep = [(1, i, b"%d" % i) for i in range(300)] + [(5, 0, b"alike")]
    shallow = deep[:200] + [(2, i, b"two") for i in range(3)] + [(400, 0, b"far")] + deep[300:]
    want = {r[:2] for r in deep} ^ {r[:2] for r in shallow}
    assert places(fixity.audit(table(spark, deep), table(spark, shallow))) == want
    assert places(fixity.audit(table(spark, shallow), table(spark, deep))) == want


def test_odd_records(spark):
    a = [(None, 0, b"x"), (0, None, b"x"), (0, 0, None), (0, 5, b""), (0, 9, b"a"), (0, 9, b"b"), (0, 10, b"z" * 100_000)]
    assert fixity.audit(table(spark, a), table(spark, a)).count() == 0
    b = [(0, 0, b""), *a[3:]]
    assert places(fixity.audit(table(spark, a), table(spark, b))) == {(0, 0)}


def test_goes_down_only_below_nodes_that_differ(spark, rng, monkeypatch):
    a = [(f, i, b"%d" % i) for f in range(20) for i in range(64)]
    b = [(f, i, b"other" if (f, i) == (7, 33) else x) for f, i, x in a]
    seen = []
    real = fixity.differing

    def count(x, y, keys):
        seen.append(x.count())
        return real(x, y, keys)

    monkeypatch.setattr(fixity, "differing", count)
    assert places(fixity.audit(table(spark, a), table(spark, b), 4)) == {(7, 33)}
    assert max(seen) <= 4


def test_query_on_repeated_and_null_pages(spark):
    """Rows that share an id, all alike or not, null urls and texts: as the SQL says."""
    import tempfile

    import duckdb
    from compare import difference

    rows = [(i % 20, f"http://h/{i % 150}" if i % 7 else None, None if i % 11 == 0 else f"text {i % 30}") for i in range(400)]
    rows += [(3, "http://h/3", "same")] * 40 + [(None, "http://h/x", "lost")] * 5
    folder = tempfile.mkdtemp(prefix="run-")
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    found = fixity.op5_fixity_audit(spark, folder).cache()
    assert found.count() > 10
    assert difference(found, con, fixity.OP5_SQL) == ""
