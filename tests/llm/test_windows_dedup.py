import re

import numpy as np
import pyarrow as pa
import pytest

from sheafline.llm import windows_dedup
from sheafline.llm.words import Words


def brute(rows, size):
    low = lambda x: -(1 << 63) if x is None else x
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, (low(i), k)), (low(i), k))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (low(i), k):
                gone |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((low(i), len(w), len(gone), kept))
    return sorted(out)


def told(df):
    low = lambda x: -(1 << 63) if x is None else x
    return sorted((low(r.doc_id), r.n_words, r.n_removed, r.kept) for r in df.collect())


@pytest.mark.parametrize("part_bytes", [1, windows_dedup.PART_BYTES])
def test_equals_brute_force_also_in_parts(table, rng, part_bytes):
    """With parts of one byte each row of a bucket is a part, so windows go on to the grouping."""
    passages = [[f"p{k}-{i}" for i in range(rng.randrange(15, 70))] for k in range(6)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"v{rng.randrange(50)}" for _ in range(rng.randrange(30))] + rng.choice(passages)
        rows.append((rng.randrange(10**6), " ".join(words)))
    # Batches of one row see no repeats among themselves.
    out = windows_dedup.without_repeats(table(rows, 40), part_bytes=part_bytes)
    assert told(out) == brute(rows, 20)


def test_odd_rows(table, odd_rows):
    assert told(windows_dedup.without_repeats(table(odd_rows))) == brute(odd_rows, 20)
    assert told(windows_dedup.without_repeats(table(odd_rows), size=5)) == brute(odd_rows, 5)


def test_empty_table(table):
    assert windows_dedup.without_repeats(table([])).count() == 0


def test_window_minima(rng):
    values = np.array([rng.randrange(1000) for _ in range(60)])
    for width in range(1, 20):
        want = [min(values[i : i + width]) for i in range(len(values) - width + 1)]
        assert windows_dedup.window_minima(values, width).tolist() == want


def test_words_equal_regex(odd_rows):
    texts = [t for _, t in odd_rows]
    words = Words(pa.array(texts))
    got = [words.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end, strict=True)]
    assert got == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert words.count.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    by_word = {}
    for w, h in zip(got, words.hashes().tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
