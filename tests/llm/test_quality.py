import numpy as np
import pyarrow as pa

from sheafline.llm import common, quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_calibration(spark):
    found = queries.QUERIES["op8_quality"](spark, SF)
    rows = found.join(common.read(spark, SF, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert np.mean([(r.score - r.quality) ** 2 for r in held]) < 0.05


def test_contexts_equal_brute_force():
    texts = ["a b a c", None, "x y", "", "one", "a b\nA!! b b"]
    table = np.zeros((quality.ROWS, quality.DIMENSIONS))
    quality.add_contexts(table, pa.array(texts))
    words, word, shape = quality.tokens(pa.array(texts))
    at, sign = quality.index_vectors()
    want = np.zeros_like(table)
    for i in range(len(word)):
        for j in range(i - quality.AROUND, i + quality.AROUND + 1):
            if j == i or not 0 <= j < len(word) or words.row[i] != words.row[j]:
                continue
            for own in (word[i], shape[i]):
                for other in (word[j], shape[j]):
                    for k in range(quality.SIGNS):
                        want[own, at[other, k]] += sign[other, k]
    assert np.array_equal(table, want)


def test_shapes():
    def shape(*texts):
        return quality.tokens(pa.array(texts))[2].tolist()

    assert len(set(shape("word", "other", "élan"))) == 1
    assert len(set(shape("word", "Word", "WORD", "word!!", "12", "a|b"))) == 6
    again = shape("same same other")
    assert again[0] != again[1] and again[0] == again[2]


def test_pooled_is_the_mean(rng):
    table = np.random.default_rng(3).normal(size=(quality.ROWS, quality.DIMENSIONS)).astype(np.float32)
    texts = ["a b c", "", None, "d", " ".join(f"w{rng.randrange(40)}" for _ in range(500))] * 30
    got = quality.pooled(pa.array(texts), table)
    words, word, shape = quality.tokens(pa.array(texts))
    for r in range(len(texts)):
        own = slice(words.first[r], words.first[r + 1])
        for k, rows in enumerate((word, shape)):
            want = table[rows[own]].mean(axis=0) if words.count[r] else 0
            assert np.allclose(got[r, k * 32 : (k + 1) * 32], want, atol=1e-4)


def test_table_is_alike_however_texts_are_dealt(spark, table, odd_rows):
    common.small_batches(spark)
    one, many = (quality.word_vectors(table(odd_rows, n).select("text")) for n in (1, 7))
    assert np.allclose(one, many, atol=1e-5)


def test_odd_rows(spark, table, odd_rows):
    docs = table(odd_rows)
    schema = "doc_id long, quality int, toxic int"
    some = spark.createDataFrame([(1, 1, None), (2, 0, 1), (None, 1, 1), (3, None, 0), (8, 0, 0), (9, 1, 0)], schema)
    found = quality.score(docs, quality.learning_rows(docs, some)).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    none = quality.score(docs, quality.learning_rows(docs, some.limit(0))).collect()
    assert [r.score for r in none] == [0.5] * len(odd_rows)
    assert quality.score(table([]), quality.learning_rows(table([]), some)).count() == 0
