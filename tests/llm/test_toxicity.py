import numpy as np
import pytest

from sheafline.llm import common, queries, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.model_of(common.documents(spark, SF))


def test_counts_equal_brute_force(spark, model):
    texts = [r.text for r in common.documents(spark, SF).select("text").limit(50).collect()]
    counts = toxicity.gram_counts(texts + [None, ""])
    want = np.zeros(toxicity.GRAMS, np.int64)
    line = [toxicity.EDGE] * 3
    import re

    for word in re.findall(r"[^\W\d_]+", "  ".join(texts)):
        line += [toxicity.letter(c) for c in word.lower().replace("ß", "é")] if word.isascii() else [
            toxicity.letter(c.lower()) if c.isascii() else toxicity.OTHER for c in word]
        line += [toxicity.EDGE] * 3
    for i in range(len(line) - 3):
        a, b, c, e = line[i : i + 4]
        want[((a * 28 + b) * 28 + c) * 28 + e] += 1
    inner = np.ones(toxicity.GRAMS, bool)
    inner[toxicity.EDGE * (28**3 + 28**2 + 28 + 1)] = False
    assert abs(counts[inner] - want[inner]).sum() <= 6  # the very ends of the line


@pytest.mark.parametrize(
    "disguised, word",
    [("1d1ot", "idiot"), ("m0r0n", "moron"), ("tr4sh", "trash"), ("w0rthl3ss", "worthless"), ("sssscum", "scum"),
     ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("l0ser!", "loser!"), ("p@thetic,", "pathetic"), ("CL0WN", "clown")],
)
def test_disguises_are_put_right(model, disguised, word):
    assert word in toxicity.Restorer(model)(f"the {disguised} and").split()


@pytest.mark.parametrize(
    "text, words",
    [("you are a s t u p i d person", ["stupid"]), ("an i d i o t l o s e r here", ["idiot", "loser"]),
     ("m.o.r.o.n  t r 4 s h", ["moron", "trash"]), ("1 d 1 o t", ["idiot"]), ("s s s s c u m", ["scum"])],
)
def test_spaced_words_end_where_the_model_says(model, text, words):
    found = toxicity.Restorer(model)(text).split()
    assert all(w in found for w in words), found


def test_spaced_equals_all_paths(model, rng):
    """All ways to join or part the letters, each word then read by its own lattice."""
    from itertools import product

    def price(word):
        log, s, total = model.log, (26, 26, 26), 0.0
        for c in word:
            total += float(log[(*s, toxicity.letter(c))])
            s = (s[1], s[2], toxicity.letter(c))
        return total + float(log[(*s, 26)])

    def best_word(word):
        paths = product(*toxicity.lattice(word))
        return max((price("".join(t for t, _ in p)) + sum(x for _, x in p), "".join(t for t, _ in p)) for p in paths)

    for _ in range(40):
        letters = [rng.choice("aabe10$l") for _ in range(6)]
        readings = []
        for edges in product((False, True), repeat=5):
            words = "".join(c + " " * e for c, e in zip(letters, (*edges, False), strict=True)).split(" ")
            total = sum(best_word(w)[0] for w in words) + sum(edges) * toxicity.PRICE_EDGE
            readings.append((total, [best_word(w)[1] for w in words]))
        found = toxicity.spaced(" ".join(letters), model)
        assert max(readings)[0] - max((t for t, w in readings if w == found), default=-1e9) < 1e-3


def test_features_are_words_without_marks():
    row, plain = toxicity.features(["loser"])
    assert set(plain) <= set(toxicity.features(["(loser!), and"])[1])


def test_plain_text_stays(model):
    text = "the thing, and 1234 or 2.0. of 555-1234 then book"
    assert toxicity.Restorer(model)(text) == text


def test_viterbi_equals_all_paths(model, rng):
    from itertools import product

    def price(word):
        log, s, total = model.log, (26, 26, 26), 0.0
        for c in word:
            k = toxicity.letter(c)
            total += float(log[s[0], s[1], s[2], k])
            s = (s[1], s[2], k)
        return total + float(log[s[0], s[1], s[2], 26])

    for _ in range(40):
        word = "".join(rng.choice("abe1043$$s!oo") for _ in range(7))
        paths = [("".join(t for t, _ in p), sum(x for _, x in p)) for p in product(*toxicity.lattice(word))]
        best = max(price(t) + x for t, x in paths)
        found = toxicity.viterbi(word, model)
        assert best - max(price(t) + x for t, x in paths if t == found) < 1e-3


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1")
    rows = found.join(common.read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").collect()
    assert len(rows) > 3000
    held = [r for r in rows if r.held_out]
    toxic, clean = [r for r in held if r.toxic == 1], [r for r in held if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.9
    assert sum(r.predicted for r in clean) / len(clean) < 0.02


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows(spark, table, odd_rows):
    docs = table(odd_rows)
    some = labels(spark, [(1, None, 1), (2, 1, 0), (None, 1, 1), (3, 0, None), (1, 0, 0), (9, 1, 1)])
    found = toxicity.score(docs, toxicity.learning_rows(docs, some)).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.without_toxic(docs, some).columns == docs.columns
    none = toxicity.score(docs, toxicity.learning_rows(docs, labels(spark, []))).collect()
    assert [r.score for r in none] == [0.5] * len(odd_rows)
    assert toxicity.score(table([]), toxicity.learning_rows(table([]), some)).count() == 0


def test_a_few_labels_suffice(spark, table):
    rows = [(i, f"some plain words {i % 7} here" + (" you 1d1ot" if i % 3 == 0 else "")) for i in range(200)]
    docs = table(rows)
    kept = toxicity.without_toxic(docs, labels(spark, [(i, 1, int(i % 3 == 0)) for i in range(150)]))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(200) if i % 3]


def test_without_labels_nothing_is_dropped(spark, table, odd_rows):
    docs = table(odd_rows)
    for rows in ([], [(4, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert toxicity.without_toxic(docs, labels).count() == len(odd_rows)


def test_long_runs_take_linear_time(rng):
    import time

    model = toxicity.LanguageModel(toxicity.gram_counts(["some plain words of a text"] * 50))

    def seconds(n):
        run = " ".join(rng.choice("abcdefghij") for _ in range(n))
        word = "".join(rng.choice("abst1u$o0el@") for _ in range(n))
        start = time.process_time()
        toxicity.spaced(run, model)
        toxicity.viterbi(word, model)
        return time.process_time() - start

    seconds(2_000)
    assert seconds(100_000) < 10 * 2 * max(seconds(10_000), 0.1)


def test_paths_are_written_out_where_they_agree(rng, monkeypatch):
    model = toxicity.LanguageModel(toxicity.gram_counts(["stupid loser idiot and others"] * 50))
    runs = ["".join(rng.choice("abst1u$oo0eeel@") + rng.choice([" ", ".", "  "]) for _ in range(60)).rstrip(" .") for _ in range(80)]
    words = ["".join(rng.choice("abst1u$oo0eeel@lll5") for _ in range(60)) for _ in range(80)]
    runs = [r for r in runs if any(c.isalpha() for c in r)]
    whole = [toxicity.spaced(r, model) for r in runs], [toxicity.viterbi(w, model) for w in words]
    monkeypatch.setattr(toxicity.Trail, "EVERY", 5)
    assert whole == ([toxicity.spaced(r, model) for r in runs], [toxicity.viterbi(w, model) for w in words])


def test_many_texts_are_restored_as_each_word_is(model, rng):
    """Disguises are looked for in many texts at once; brute force looks at each word and each text."""
    pieces = list("aabcdeE013@$!|+*.-_  ") + ["\n", "é", "한", "🙂", "aaa", " ", "İ", "𝒜𝒜𝒜", "²", "a b c", " x.y-z ", "l_o_l", "\x1c"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(2000)] + ["", "i d i o t"]
    restore = toxicity.Restorer(model)

    def brute(text):
        text = text.lower()
        extra = [words for m in toxicity.SPACED.finditer(text) if (words := restore.spaced(m.group()))]
        words = {w: restore.word(w) for w in text.split() if toxicity.DISGUISED.search(w)}
        import re

        return " ".join([re.sub(r"\S+", lambda m: words.get(m.group(), m.group()), text), *extra])

    assert toxicity.Restorer(model).all(texts) == [brute(t) for t in texts]


def test_scores_look_up_only_what_has_a_weight(rng):
    texts = [" ".join(rng.choice(["loser", "losers", "idiotic", "plain", "words"]) for _ in range(rng.randrange(9))) for _ in range(300)]
    row, found = toxicity.features(texts)
    every = np.unique(found)
    for some in (every, every[::3], every[:1]):
        weight = np.arange(1, len(some) + 1) / len(some)
        hit = np.isin(found, some)
        total = -1 + np.bincount(row[hit], weight[np.searchsorted(some, found[hit])], len(texts))
        scorer = toxicity.Classifier(some, weight, -1.0)
        assert np.allclose(scorer.scores(texts), 1 / (1 + np.exp(-total)))
        assert len(toxicity.features(texts, scorer.sources)[0]) <= len(row)
    assert len(toxicity.features(texts, toxicity.sources(every[:1]))[0]) < len(row) / 2
