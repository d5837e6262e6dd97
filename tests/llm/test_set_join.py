import re

import pytest

from sheafline.llm import set_join

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = lambda x: -1 if x is None else x
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((low(doc_id), len(sets[i]), -1 if doc_id is None else min(ids)))
    return sorted(out)


def told(df):
    low = lambda x: -1 if x is None else x
    return sorted((low(r.doc_id), r.n_shingles, low(r.component_id)) for r in df.collect())


def near_copies(rng, bases, copies, changes, vocabulary=400):
    rows, passage = [], [f"p{i}" for i in range(30)]
    for b in range(bases):
        words = [f"v{rng.randrange(vocabulary)}" for _ in range(rng.randrange(3, 160))]
        if b % 3 == 0:
            words = words[: len(words) // 2] + passage + words[len(words) // 2 :]
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.randrange(changes + 1)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("changes", [1, 6])
def test_equals_brute_force(table, rng, changes):
    rows = near_copies(rng, 12, 9, changes)
    assert told(set_join.classes_of(table(rows))) == brute(rows)


def test_links_that_only_a_chain_makes(table):
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 15 : i * 15 + 200])) for i in range(12)]
    assert told(set_join.classes_of(table(rows))) == brute(rows)


def test_links_away_from_the_pivot(table, rng):
    """Sets around a centre that are too far from it, and near to each other in pairs."""
    base = [f"b{i}" for i in range(220)]
    rows = [(0, " ".join(base))]
    for k in range(10):
        own = list(base)
        for i in range(k * 20, k * 20 + 14):
            own[i] = f"x{k}-{i}"
        rows += [(2 * k + 1, " ".join(own)), (2 * k + 2, " ".join([*own[:-1], f"y{k}"]))]
    assert told(set_join.classes_of(table(rows))) == brute(rows)


def test_pivots_and_bridges_without_an_identifier(table, rng):
    """Most of each group, so also pivots, and every other link of a chain have a null doc_id."""
    group = [(i if k % 4 == 0 else None, t) for k, (i, t) in enumerate(near_copies(rng, 8, 12, 2))]
    words = [f"c{i}" for i in range(400)]
    chain = [(1000 + i if i % 2 == 0 else None, " ".join(words[i * 15 : i * 15 + 200])) for i in range(12)]
    rows = group + chain + [(None, group[1][1])] * 5
    assert told(set_join.classes_of(table(rows))) == brute(rows)


@pytest.mark.parametrize("percent", [60, 70])
def test_other_percents_equal_brute_force(table, rng, percent):
    rows = near_copies(rng, 6, 6, 6)
    for n, m in ((60, 85), (60, 99), (100, 142), (33, 47)):
        words = [f"q{n}-{m}-{i}" for i in range(m + 4)]
        rows += [(len(rows), " ".join(words[: n + 4])), (len(rows) + 1, " ".join(words))]
    assert told(set_join.classes_of(table(rows), percent=percent)) == brute(rows, percent)


def test_odd_rows(table, odd_rows):
    assert told(set_join.classes_of(table(odd_rows))) == brute(odd_rows)


def test_one_of_each_class_stays(table, odd_rows):
    out = set_join.one_of_each(table(odd_rows))
    assert out.columns == table(odd_rows).columns
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == [1, 1, 3, 4, 5, 6, 8, 9, 10]
    assert out.filter("doc_id is null").count() == 2


def test_empty_table(table):
    assert set_join.classes_of(table([])).count() == 0


def test_components_equal_brute_force(spark, rng):
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)]
    root = {x: x for p in pairs for x in p}
    for _ in pairs:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = set_join.components(spark.createDataFrame(pairs, "a long, b long"))
    want = {x: r for x, r in root.items() if any(a != b and x in (a, b) for a, b in pairs)}
    assert {r.node: r.root for r in got.collect()} == want


def test_stars_are_told_and_need_no_round(spark, monkeypatch):
    stars = spark.createDataFrame([(9, 1), (8, 1), (7, 3), (6, 3)], "a long, b long")
    assert set_join.all_stars(stars)
    for more in ((9, 8), (8, 3), (1, 0)):
        assert not set_join.all_stars(stars.union(spark.createDataFrame([more], "a long, b long")))
    staged = []
    monkeypatch.setattr(set_join.common, "stage", lambda df, name, f=set_join.common.stage: staged.append(name) or f(df, name))
    got = {r.node: r.root for r in set_join.components(stars).collect()}
    assert got == {9: 1, 8: 1, 1: 1, 7: 3, 6: 3, 3: 3}
    assert staged == ["edges", "classes"]
