import random

import pytest
from pyspark.sql import functions as F

from sheafline import fixed_values as fv
from sheafline.functions import paths
from sheafline.operators import routing
from sheafline.settings import default_agent_rules


def brute(path, rules):
    for _, prefix, agent in sorted(rules):
        if path and prefix and (path == prefix or path.startswith(prefix + ">")):
            return agent
    return fv.DEFAULT_AGENT


def test_equals_first_rule_in_order(spark):
    rng = random.Random(2)
    name = lambda: ">".join(rng.choice(["a", "ab", "b", "보험", ""]) for _ in range(rng.randrange(1, 5)))
    rules = [(n, name(), f"agent{n % 50}") for n in range(10_000)] + [(20_000, "z", "late"), (15_000, "z", "early"), (1, None, "x")]
    rows = [(n, name(), "old") for n in range(500)] + [(n, "z>y", "old") for n in (600, 601)] + [(700, None, "old"), (701, "", "old")]
    out = routing.route(
        spark.createDataFrame(rows, "id int, doc_path string, agent_id string"),
        spark.createDataFrame(rules, "rule_no int, prefix string, agent_id string"),
    )
    assert out.columns == ["id", "doc_path", "agent_id"]
    rules = [r for r in rules if r[1]]
    assert sorted((r.id, r.agent_id) for r in out.collect()) == [(n, brute(p, rules)) for n, p, _ in rows]
    assert "CASE" not in out._jdf.queryExecution().executedPlan().toString()


def test_equals_the_rules_as_a_column(spark):
    owned = [p for rule in default_agent_rules() for p in (rule.prefix, rule.prefix + ">x", rule.prefix + "y")]
    rows = spark.createDataFrame([(p,) for p in [*owned, None, "", "none"]], "doc_path string")
    rules = [(n, rule.prefix, rule.agent) for n, rule in enumerate(default_agent_rules())]
    out = routing.route(rows, spark.createDataFrame(rules, "rule_no int, prefix string, agent_id string"))
    want = rows.withColumn("agent_id", paths.agent(F.col("doc_path")))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_rows_and_paths_are_not_multiplied(spark):
    """Only folders are taken apart, of which there are far fewer than paths."""
    rows = spark.range(20_000).selectExpr("id", "concat('a>', id % 10, '>', id) doc_path")
    rules = spark.createDataFrame([(3, "a>7", "seven"), (1, "a>7>17", "own"), (9, "a>7>27", "late")], "rule_no int, prefix string, agent_id string")
    out = routing.route(rows, rules).collect()
    want = lambda n: ("own" if n == 17 else "seven") if n % 10 == 7 else fv.DEFAULT_AGENT
    assert sorted((r.id, r.agent_id) for r in out) == [(n, want(n)) for n in range(20_000)]
    exploded = routing.with_parents
    made = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(routing, "with_parents", lambda path: made.append(str(path)) or exploded(path))
        routing.route(rows, rules)
    assert made == ["Column<'_in'>"]
    levels = spark.createDataFrame([("a>b>c",), ("a",), (">a",), ("a>",), ("",), (None,)], "p string")
    assert [r[0] for r in levels.select(routing.parent(F.col("p"))).collect()] == ["a>b", "", "", "a", "", None]
