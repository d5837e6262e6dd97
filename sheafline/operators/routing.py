"""Routing of folder paths by a table of rules, however many there are.

A rule fits a path if its prefix is the path or one of its parents. So the first rule of
a path is its own or the first one of the folder it lies in. Rows meet their own rule by
equality. Only each distinct folder is taken apart into itself and its parents, which
meet the rules by equality as well, and the first rule in order wins.
Nothing grows with the number of rules but the rules' side of two joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheafline import fixed_values as fv


def with_parents(path: Column) -> Column:
    """A path ``a>b>c`` as the array of ``a``, ``a>b`` and itself."""
    parts = F.split(path, ">")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ">")
    )


def parent(path: Column) -> Column:
    """The path ``a>b`` of ``a>b>c``; empty where there is none."""
    return F.left(path, F.length(path) - F.length(F.substring_index(path, ">", -1)) - 1)


def route(
    rows: DataFrame,
    rules: DataFrame,
    path: str = "doc_path",
    agent: str = "agent_id",
    default: str = fv.DEFAULT_AGENT,
) -> DataFrame:
    """The rows with the agent of the first fitting rule of ``rules`` (rule_no, prefix, agent_id); ``default`` where
    none fits or the path is NULL or empty. Rules without a prefix fit nothing; of rules with
    one prefix the first counts. Rows of a folder are reduced to one before its parents are looked up, and
    no row is multiplied; the sizes decide whether Spark sends rules or folders to all tasks."""
    first = rules.where("prefix <> ''").groupBy(F.col("prefix").alias("_level"))
    first = first.agg(F.min(F.struct("rule_no", F.col("agent_id").alias("agent"))).alias("_rule"))
    placed = rows.withColumn("_folder", parent(F.col(path)))
    folders = placed.select(F.col("_folder").alias("_in")).where("_in <> ''").distinct()
    levels = folders.select("_in", F.explode(with_parents(F.col("_in"))).alias("_level"))
    above = levels.join(first, "_level").groupBy("_in").agg(F.min("_rule").alias("_above"))
    own = first.select(F.col("_level").alias("_path"), F.col("_rule").alias("_own"))
    found = placed.join(own, F.col(path) == F.col("_path"), "left").join(above, F.col("_folder") == F.col("_in"), "left")
    found = found.withColumn("_first", F.least("_own", "_above"))
    names = [c for c in rows.columns if c != agent]
    return found.select(*[rows[c] for c in names], F.coalesce("_first.agent", F.lit(default)).alias(agent))
