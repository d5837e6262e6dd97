import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sheafline.llm import common, wavelet

SMALL = "/root/testdata/sf0.001"
ODD = [
    "Don't STOP. it's, U.S. naïve Éa. ÉE ＡＢ",
    "a<|endoftext|>b. <|startoftext|>.",
    "é. É, İ. İİ ǅ ŉ ſ. ß. ΑΣ. क़.",
    "x\u001cy \u0085z w v﻿",
    " \n\t ",
    "...,,, .a ,b 12.5, 3rd.",
    ".a ,b. É,\nc.d e,f\n\n.",
    "a. , b .. c",
    "日本語。テスト 한국어 🙂🙂.",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(wavelet.vocabulary())


def encoded(tokenizer, text):
    return [*(tokenizer.encode(text, add_special_tokens=False).ids if text else []), 1]


def brute(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = encoded(tokenizer, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n", [1, 511, 512, 513, 3000])
def test_matrix_equals_plain_array(n):
    ids = np.random.default_rng(n).choice([0, 1, 5, 700, 49407, 65535], n).astype(np.uint16)
    m = wavelet.Matrix.of(ids, 16)
    assert (m.ids() == ids).all() and (m.access(np.arange(n)) == ids).all()
    for token in (0, 1, 5, 6, 49407, 70000):
        places = np.flatnonzero(ids == token)
        assert (m.occurrences(token) == places).all()
        for end in (0, n // 3, n):
            assert m.rank(token, end) == (ids[:end] == token).sum()
    with pytest.raises(IndexError):
        m.select(6, [0])


def test_words_equal_the_tokenizer(tokenizer):
    known = wavelet.WordIds(wavelet.vocabulary())
    for text in [*ODD, "The end. The end."]:
        assert np.frombuffer(known.of_text(text), known.kind).tolist() == encoded(tokenizer, text)[:-1], text
    for c in [*range(1, 0xD800), *range(0xE000, 0x10000, 3)]:
        for text in (f"a{chr(c)}.", f"{chr(c)}b'S", f"Z{chr(c)}, c", f"{chr(c)}1{chr(c)}{chr(c)} É"):
            if c < 0x400 or c % 31 == 0:
                ids = np.frombuffer(known.of_text(text), known.kind).tolist()
                assert ids == encoded(tokenizer, text)[:-1], (hex(c), text)


def test_words_equal_the_tokenizer_on_documents(spark, tokenizer):
    known = wavelet.WordIds(wavelet.vocabulary())
    for row in common.documents(spark, SMALL).collect():
        if row.text:
            assert np.frombuffer(known.of_text(row.text), known.kind).tolist() == encoded(tokenizer, row.text)[:-1]


def test_query_equals_brute_force(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SMALL).collect()]
    assert sorted(map(tuple, wavelet.op12_wavelet_matrix(spark, SMALL).collect())) == brute(tokenizer, rows)


def test_odd_rows_and_small_segments(spark, table, odd_rows, tokenizer):
    path = common.new_path(spark, "wavelet")
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    wavelet.write_shards(table(rows), wavelet.vocabulary(), path, segment_ids=50, shard_bytes=1 << 10)
    shards = wavelet.read_shards(spark, path)
    assert len({r.shard for r in shards.select("shard").distinct().collect()}) > 4
    found = wavelet.documents_of(shards).join(wavelet.starts(shards), "shard").collect()
    got = sorted((r.base + r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in found)
    # Rows that share an identifier stand side by side, in any order.
    want = brute(tokenizer, rows)
    low = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(low((d, n, c)) for _, d, n, c in got) == sorted(low((d, n, c)) for d, _, n, c in want)
    assert [(-1 if d is None else d) for _, d, _, _ in got] == sorted(-1 if d is None else d for d, _ in rows)
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n


def test_search_over_shards(spark, table, tokenizer):
    rows = [(i, f"the cat{i % 3} sat. the end") for i in range(40)]
    path = common.new_path(spark, "wavelet")
    wavelet.write_shards(table(rows), wavelet.vocabulary(), path, segment_ids=64)
    shards = wavelet.read_shards(spark, path)
    flat = [i for _, t in rows for i in encoded(tokenizer, t)]
    the = encoded(tokenizer, "the")[0]
    counts = {r.token: r.n for r in wavelet.count_of(shards, [the, 1, 7]).collect()}
    assert counts == {the: flat.count(the), 1: 40, 7: flat.count(7)}
    places = [(i, j) for i, t in rows for j, x in enumerate(encoded(tokenizer, t)) if x == the]
    assert sorted(map(tuple, wavelet.occurrences_of(shards, the).collect())) == places
    wanted = spark.createDataFrame([(0,), (len(flat) - 1,), (77,), (130,)], "at long")
    assert {r.at: r.token for r in wavelet.tokens_at(shards, wanted).collect()} == {i: flat[i] for i in (0, len(flat) - 1, 77, 130)}


def test_empty_table(spark, table):
    path = common.new_path(spark, "wavelet")
    wavelet.write_shards(table([]), wavelet.vocabulary(), path)
    assert wavelet.documents_of(wavelet.read_shards(spark, path)).count() == 0
