import re

import pytest

from sheafline.llm import common, personal, queries

SF = "/root/testdata/sf0.01"
KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        k = int(c) * (2 if i % 2 else 1)
        total += k - 9 if k > 9 else k
    return total % 10 == 0


def base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


TEXTS = [
    "a@b.c_d@e.f x@y z@w.v. é🙂 me.you+x%y-z@mail-1.example.co.uk.",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3 999999999999.1.1.1 0.0.0.0",
    "4111 1111 1111 1111 4111-1111-1111-1111, 4111111111111112 4111  1111 1111 1111 1 5",
    "+1 (988) 555-2485 +49.30.1234567890123456 +1 2 +12 + 1234567890 ++1 555 555 5555",
    "a@b.c@d.e 1.2.3.4@h.i +1.2.3.4.5.6.7.8 a@-.- @x.y",
    "x@y.z" * 3 + " 4111 1111 1111 1111 4111 1111 1111 1111",
    None,
    "",
]


def told(row):
    return sorted(((s.kind, s.start, s.end) for s in row.base), key=lambda s: (KINDS.index(s[0]), s[1]))


def test_base_spans_equal_brute_force(table, rng):
    alphabet = ["1", "23", ".", "-", " ", "@", "a", "+", "(", ")", "4111", "_", "é", "b.c", "x@y.z"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(80)) for _ in range(300)]
    out = {r.doc_id: r for r in personal.personal_data(table(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert told(out[i]) == base(text or ""), text


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in common.documents(spark, SF).collect()}
    rows = queries.QUERIES["op7_personal_data"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        joined = [f"{k}:{s}:{e}" for k, s, e in want]
        assert set(joined) <= set(r.spans.split(",")) or not joined
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, *_ in want) for k in KINDS]


def test_long_runs_neither_recurse_nor_take_quadratic_time(table):
    texts = ["1 " * 60_000, "9" * 200_000, "a." * 60_000 + "@x" + ".y" * 60_000, "+1" + " 2" * 60_000]
    out = {r.doc_id: r for r in personal.personal_data(table(list(enumerate(texts)))).collect()}
    for i in (0, 2, 3):
        assert told(out[i]) == base(texts[i])
    assert told(out[1]) == []


def test_trees_add_what_no_base_pattern_takes(table, rng):
    """Numbers written like the others, but for the sign that the base pattern wants."""
    rows = []
    for i in range(400):
        n = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        rows.append((i, f"words call +1 {n} here and order {rng.randrange(10**6, 10**8)} there, {rng.randrange(10**12)} it"))
    rows.append((900, "words call (212) 555-1234 here"))
    rows.append((901, "order 1234567 there"))
    out = {r.doc_id: r for r in personal.personal_data(table(rows)).collect()}
    assert [(s.kind, s.start, s.end) for s in out[900].added] == [("phone", 11, 25)]
    assert not out[901].added
    for r in out.values():
        assert all(a.end <= b.start or b.end <= a.start for a in r.added for b in r.base)


def test_odd_rows(table, odd_rows):
    assert personal.personal_data(table(odd_rows)).count() == len(odd_rows)
    assert personal.personal_data(table([])).count() == 0


@pytest.mark.parametrize("name", ["op7_personal_data"])
def test_no_python_in_the_plan(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_example_counts(table, spark):
    """Many examples of one form, and a few of another kind that only a whole reading is sure to see."""
    text = " ".join(f"call +1 555 {i:03d} {i * 7 % 10_000:04d} or order {1_000_000 + i}" for i in range(500))
    docs = table([(i, text) for i in range(60)] + [(60, "write to a@b.c")])
    found = personal.matches(docs, "doc_id", "text")
    spots = personal.placed(found)
    base = spots.filter("base = 1").filter(personal.is_base(spots["kind"], spots["match"]))
    candidates = common.stage(personal.with_features(personal.touching(spots.filter("base = 0"), base)), "candidates")
    rows = personal.examples_of(candidates)
    own = candidates.filter("same or not touches")
    assert own.count() > 50_000
    assert rows.selectExpr("sum(n)").first()[0] == own.count() + personal.without_marks(
        own.withColumn("label", own["same"].cast("double")).filter("same")
    ).count()
    assert rows.count() < own.count() / 20
    assert rows.filter("kind = 'email' and label = 1").selectExpr("sum(n)").first()[0] == 2
