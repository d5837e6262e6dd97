import numpy as np
import pytest

from sheafline.llm import decontamination as d


def plain_smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            same = d.MATCH if a[i - 1] == b[j - 1] else d.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] + d.GAP, h[i, j - 1] + d.GAP)
    return int(h.max())


def test_alignment_equals_the_plain_one(rng):
    for _ in range(60):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(25))])
        b = np.array([rng.randrange(6) for _ in range(rng.randrange(40))])
        assert d.smith_waterman(a, b)[0] == plain_smith_waterman(a, b)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(k, " ".join(f"item{k}word{i}" for i in range(40))) for k in range(30)] + [(90, None), (91, ""), (92, "two words")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_finds_copies_and_leaves_clean_texts_alone(table, items, rng):
    def words(k):
        return [f"item{k}word{i}" for i in range(40)]

    def noise(n):
        return [f"n{rng.randrange(500)}" for _ in range(n)]

    edited = [w if i % 7 else "changed" for i, w in enumerate(words(2))]
    shorter = [w for i, w in enumerate(words(3)) if i % 8]
    padded = [x for i, w in enumerate(words(4)) for x in ([w, "more"] if i % 9 == 0 else [w])]
    rows = [
        (1, " ".join(noise(200) + words(1) + noise(300))),
        (2, " ".join(noise(20) + edited)),
        (3, " ".join(shorter + noise(40))),
        (4, ". ".join(w.upper() for w in padded)),
        (5, " ".join(noise(900))),
        (6, " ".join(noise(30) + words(6)[:8] + noise(30))),
        (7, " ".join(noise(3) + ["two", "words"] + noise(3))),
    ]
    got = {(r.doc_id, r.item_id) for r in d.contaminated(table(rows), items).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (7, 92)}
    kept = d.without_contaminated(table(rows), items)
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6]
    assert kept.columns == table(rows).columns


def test_an_item_that_most_texts_hold_is_found_in_all(table, items):
    text = " ".join(f"item5word{i}" for i in range(40))
    rows = [(i, text + f" and {i}") for i in range(50)] + [(60, "clean")]
    assert {r.doc_id for r in d.contaminated(table(rows), items).collect()} == set(range(50))


@pytest.mark.parametrize("edited", [18, 300])
def test_one_exact_copy_hides_no_group_of_equal_edits(table, items, edited):
    words = [f"item7word{i}" for i in range(40)]
    copy = " ".join(w if i % 6 else "changed" for i, w in enumerate(words))
    rows = [(0, " ".join(words))] + [(i, f"{copy} and {i}") for i in range(1, edited + 1)] + [(999, "clean")]
    assert {r.doc_id for r in d.contaminated(table(rows), items).collect()} == set(range(edited + 1))


def test_the_bound_rules_out_no_alignment(rng):
    for _ in range(60):
        text = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 40))], np.uint64)
        known = d.Items([(1, " ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(1, 25))))], d.SEED)
        text = known.words[0][text.astype(np.int64) % len(known.words[0])]
        assert plain_smith_waterman(known.words[0], text) <= d.MATCH * known.shared(0, text)


def test_blocks_of_items_give_the_same(table, items, monkeypatch):
    rows = [(k, " ".join(f"item{k}word{i}" for i in range(40))) for k in range(30)]
    whole = sorted(map(str, d.contaminated(table(rows), items).collect()))
    monkeypatch.setattr(d, "BLOCK_ITEMS", 7)
    assert sorted(map(str, d.contaminated(table(rows), items).collect())) == whole and len(whole) == 30


def test_odd_rows_and_empty_tables(spark, table, items, odd_rows):
    assert d.contaminated(table(odd_rows), items).count() == 0
    assert d.without_contaminated(table(odd_rows), items).count() == len(odd_rows)
    assert d.contaminated(table([]), items).count() == 0
    assert d.contaminated(table(odd_rows), items.limit(0)).count() == 0
    none = spark.createDataFrame([(None, "a b c d e f g")], items.schema)
    assert {r.doc_id for r in d.contaminated(table(odd_rows), none).collect()} == {1, 2, None}


def test_copy_with_a_foreign_word_before_each_is_reached(table, items):
    words = [f"item8word{i}" for i in range(40)]
    text = words[:4] + [x for i, w in enumerate(words[4:]) for x in (f"other{i}", w)]
    rows = [(1, " ".join(text)), (2, " ".join(["lead"] * 70 + text[::-1]))]
    (found,) = d.contaminated(table(rows), items).collect()
    assert (found.doc_id, found.item_id, found.score) == (1, 8, 0.55)


def test_random_edits_against_alignment_of_whole_texts(table, items, rng):
    """Gaps, insertions, swaps and every fourth or fifth word replaced: recall against all pairs, without seeds."""
    rows, ids = [], {k: d.word_ids(" ".join(f"item{k}word{i}" for i in range(40))) for k in range(30)}
    for n in range(400):
        words = [f"item{n % 30}word{i}" for i in range(40)]
        kind = rng.randrange(5)
        if kind < 2:
            k = rng.choice([4, 5, 7])
            words = [f"x{rng.randrange(99)}" if i % k == n % k else w for i, w in enumerate(words)]
        elif kind == 2:
            words = [w for w in words if rng.random() < rng.choice([0.6, 0.8])]
        elif kind == 3:
            words = [x for w in words for x in ([w, f"y{rng.randrange(99)}"] if rng.random() < 0.5 else [w])]
        else:
            for _ in range(rng.randrange(12)):
                i = rng.randrange(39)
                words[i], words[i + 1] = words[i + 1], words[i]
        rows.append((n, " ".join([f"n{rng.randrange(999)}" for _ in range(60)] + words + ["end"] * 30)))
    want = {}
    for n, text in rows:
        score = d.smith_waterman(ids[n % 30], d.word_ids(text))[0] / (2 * 40)
        if score >= d.THRESHOLD:
            want[n] = score
    got = {r.doc_id: r.score for r in d.contaminated(table(rows), items).collect()}
    assert got.keys() <= want.keys() and all(got[n] == want[n] for n in got)
    assert len(got) >= 0.9 * len(want) and len(want) > 200
    print(len(got), len(want))


def test_common_seeds_alone_are_enough(table, items):
    """What a text shares with the item is all common; its rare seeds lead elsewhere."""
    words = [f"item9word{i}" for i in range(40)]
    rows = [(i, " ".join(words[:24] + [f"z{i}"] * 5)) for i in range(60)]
    rows += [(100, " ".join(words[30:33] + ["far"] * 200 + words[:24]))]
    assert {r.doc_id for r in d.contaminated(table(rows), items).collect()} == {*range(60), 100}
