import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sheafline.llm import packing

ODD = [
    "", " ", "  ", "a", " a", "a  b", "a\n b", "a \nb", "it's  we'll don't", "x" * 3000, "tab\tend \t", "é ü  ß 日本 🙂",
    "1 22 333,44", "end ", "a\r\n\r\nb", "<|endoftext|", "  x", "a 　b",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch, rng):
    encode = packing.encoder(*packing.vocabulary())
    mixed = ["".join(rng.choice([" ", "\n", "ab", "é", "1", ".", "  ", "\t", "'s", "Z"]) for _ in range(60)) for _ in range(300)]
    for text in [*ODD, *mixed]:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    monkeypatch.setattr(packing.Encoder, "STEP", 7)
    for text in [*ODD, *mixed]:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_equal_the_tokenizer(tokenizer, monkeypatch, rng):
    encode = packing.encoder(*packing.vocabulary())
    assert np.frombuffer(encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    end = "<|endoftext|>"
    texts = [end, f"a{end}b", f"a {end}b", f"a{end} b", f" {end}  {end} ", end + end, f"\n{end}\n\n", f"<|{end}|>", f"é{end}🙂"]
    texts += ["".join(rng.choice([" ", "\n", "ab", end, "  ", end[:-1], "1"]) for _ in range(30)) for _ in range(200)]
    for step in (packing.Encoder.STEP, 7):
        monkeypatch.setattr(packing.Encoder, "STEP", step)
        for text in texts:
            assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_pieces_put_every_document_together_again(table, tokenizer, rng):
    rows = [(i, " ".join(f"word{rng.randrange(99)}" for _ in range(rng.randrange(2000)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(200, None), (None, "no id"), (0, rows[0][1])]
    pieces = packing.pack(table(rows), *packing.vocabulary(), group_windows=8).collect()
    want = defaultdict(list)
    for i, t in rows:
        want[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(by_doc) == set(want)
    for i, texts in want.items():
        ids = texts[0]
        assert all(t == ids for t in texts)
        expected = []
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert sum(p.length for p in own) == len(ids) * len(texts)
        for p in own:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
            expected += range(p.start, p.start + p.length)
        assert sorted(expected) == sorted(list(range(len(ids))) * len(texts))
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0, *[p.length for p in own]])[:-1])
        assert sum(p.length for p in own) <= 1024


def test_little_padding(rng):
    packer = packing.Packer(1024, 128, 0)
    total = 0
    for i in range(3000):
        n = rng.randrange(1, 3000)
        total += n
        for _ in packer.add(i, b"\0" * 4 * n):
            pass
    for _ in packer.flush():
        pass
    assert total / (packer.next * 1024) > 0.99


def test_differencing_deals_every_piece_and_is_nearly_even(rng):
    for k in (1, 2, 3, 7, 40):
        sizes = np.array([rng.randrange(1, 129) for _ in range(k * 9)])
        windows = packing.differencing(sizes, k)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        sums = [sizes[w].sum() for w in windows]
        assert max(sums) - min(sums) <= 6


def test_windows_rise_when_one_is_over_capacity():
    windows = packing.deal(np.array([60, 60, 60]), 100)  # 180 would fit in two windows
    assert sorted(map(len, windows)) == [1, 1, 1]


def test_empty_table(table):
    assert packing.pack(table([]), *packing.vocabulary()).count() == 0
