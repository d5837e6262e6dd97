import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sheafline.llm import alignment, common

SMALL = "/root/testdata/sf0.001"
ODD = [
    "<|endoftext|> a <s> b</s> <0x41>",
    "blank ▁ sign",
    "two  blanks \n\n and lines\r\n\tend ",
    " first",
    "\nline first",
    "日本語テスト 한국어 🙂🙂 naïve ﬁ ２ é  x",
    "x" * 3000,
    "a\u001c b c\u0085 d",
    "the the the the the the the the cat the",
]


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as public

    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [i for i in range(256) if i not in kept]
    sign = {chr(c): c for c in kept} | {chr(256 + k): c for k, c in enumerate(others)}
    a_bytes = {i: bytes(sign[c] for c in t) for t, i in a.get_vocab().items() if i < 50256}
    b_bytes = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        b_bytes[i] = bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def groups(libraries, text):
    """Whole texts by both libraries, cut where ends meet."""
    a, b, a_bytes, b_bytes = libraries
    if not text:
        return []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if b"".join(map(a_bytes.get, x)) != whole or b"".join(map(b_bytes.get, y)) != whole:
        return []
    ends_x = np.cumsum([len(a_bytes[i]) for i in x]).tolist()
    ends_y = np.cumsum([len(b_bytes[i]) for i in y]).tolist()
    both = set(ends_x) & set(ends_y)
    cut = lambda ids, ends: np.split(ids, [k + 1 for k, e in enumerate(ends) if e in both][:-1])
    return [(a.tolist(), b.tolist()) for a, b in zip(cut(x, ends_x), cut(y, ends_y), strict=True)]


def brute(libraries, rows):
    every = [(d, groups(libraries, t)) for d, t in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for _, g in every]
    documents = Counter(p for ps in links for p in set(ps))
    most = defaultdict(int)
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    out = []
    for (d, g), ps in zip(every, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        best = sum(documents[p] == most[p[0]] for p in ps)
        digest = hashlib.sha256(text.encode()).hexdigest() if g else ""
        counts = sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(ps)
        out.append((-1 if d is None else d, *counts, best, sum(documents[p] for p in ps), digest))
    return sorted(out)


def told(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((-1 if r.doc_id is None else r.doc_id, *[r[n] for n in names[1:]]) for r in df.collect())


def test_query_equals_brute_force(spark, libraries):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SMALL).collect()]
    assert told(alignment.op11_alignment(spark, SMALL)) == brute(libraries, rows)


def test_odd_rows_in_small_chunks(table, odd_rows, libraries):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    assert told(alignment.align(table(rows), *alignment.vocabularies(), chunk_links=40)) == brute(libraries, rows)


def test_common_pair_in_plain_bits(table, libraries):
    rows = [(i, "the cat " * (i % 9 + 1) + f"w{i % 7}") for i in range(1200)]
    assert told(alignment.align(table(rows), *alignment.vocabularies())) == brute(libraries, rows)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(2)
    sets = [np.sort(rng.choice(alignment.CHUNK, n, replace=False)) for n in (1, 255, 256, 4096, 3)]
    pair = np.repeat(np.arange(5) * 10, [len(s) for s in sets])
    keys, card, docs = alignment.bitmaps(pair, np.concatenate(sets))
    assert keys.tolist() == [0, 10, 20, 30, 40] and card.tolist() == [len(s) for s in sets]
    for part in (docs, docs.slice(1, 3), docs.slice(4)):
        at, n = alignment.positions(part)
        lost = (len(docs) - len(part)) if len(part) == 1 else (1 if len(part) == 3 else 0)
        assert at.tolist() == np.concatenate(sets[lost : lost + len(part)]).tolist()
        assert n.tolist() == [len(s) for s in sets[lost : lost + len(part)]]


def test_link_counts_come_from_planes(table, libraries):
    rows = [(i, "the " * (i + 1)) for i in range(20)]
    made = alignment.inverted(table(rows), *alignment.vocabularies()[:1])
    counts = {(r.a, r.b): (r.documents, r.links) for r in alignment.pair_counts(made, alignment.vocabularies()[1]).collect()}
    want = Counter((x, y) for _, t in rows for a, b in groups(libraries, t) for x in a for y in b)
    assert {p: n for p, (_, n) in counts.items()} == dict(want)


def test_empty_table(table):
    assert alignment.align(table([]), *alignment.vocabularies()).count() == 0


def test_parts_encoded_together_equal_each_alone(rng, monkeypatch):
    """Words that come for the first time are encoded in one go, and aligned without a step for each of them."""
    files = alignment.vocabularies()[0]
    known = alignment.Parts(alignment.Tokenizers(*files))
    alone = []
    monkeypatch.setattr(known.of, "groups", lambda part, f=known.of.groups: alone.append(part) or f(part))
    pieces = ["a", "foo", " ", "  ", "\n", "　", "é", "한국", "🙂", "x1", ".", "'s", "\t", "1234", " b", " c d"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(300)] + [t for t in ODD if t]
    texts += ["\nfoo", "a \nfoo b", "foo\n", "a foo\n b"]
    other = alignment.Tokenizers(*files)
    for text in texts:
        found, want = known.of_text(text), other.groups(text)
        assert (found is None) == (want is None)
        if want is not None:
            counts, pairs, digest = found
            assert counts.tolist() == [sum(len(g[0]) for g in want), sum(len(g[1]) for g in want), len(want)]
            assert pairs.tolist() == [x * other.b_count + y for a, b in want for x in a for y in b]
            assert digest == hashlib.sha256(alignment.written(want)).hexdigest()
    alone.clear()
    known.of_text(" ".join(f"word{i}x{i * 7}, 한{i}" for i in range(5000)))
    assert not alone
