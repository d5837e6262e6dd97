"""Exact Jaccard join of documents' shingle sets that skips by relations between sets.

Sets that are equal are one set. A set's shingles stand in one order for all sets, rare
ones first; sets that are similar enough share a shingle among the first few (its prefix).
The index has a list for each such shingle, cut in blocks of sets of like size, and holds
for each set the position of the shingle in it.

* Shingles of a single set can't link anything. They stay out of the index, but count as
  positions; a set with too many of them is out altogether.
* Each block has a pivot, the set that stands in most lists. The answers of the pivot to all
  sets of its blocks (its star) are computed: overlap, and what the other set lacks and has
  besides.
* Answers of the other sets are derived from those. A set linked to the pivot is in its
  class, so pairs within a class are skipped, and so are blocks of one class. Sets that have
  something in common which the pivot lacks are tried next, each with the best of them.
  Of the remaining pairs of a star those are skipped whose sizes, positions or answers to the
  pivot rule a link out. All overlaps follow from the two differences to the pivot,
  without looking at the sets again.

The order: shingles of a fixed third of the hash space first, by the number of sets that
have them, then all others by hash. Only that third is ever counted.

Nulls and odd input: a null or blank text has no words, an empty set and no link; texts
with fewer words than a shingle are one shingle; a null doc_id stays null in the result
and names no class; rows that repeat an identifier are rows of their own; an empty table
gives an empty result; other columns are not looked at. Shingles are told apart by 64 bits of hash
and sets by 64 bits of a digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common
from sheafline.llm.words import Words, lists, rolling

SIZE = 5
#: Link at 100 * intersection >= PERCENT * union.
PERCENT = 80
#: The counted part of the hash space is the lowest 1 / COUNTED of it.
COUNTED = 3


def shingle_sets(column, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow column."""
    words = Words(column, lower=True)
    hashes = words.hashes()
    runs = rolling(hashes, size)
    for row in range(words.rows):
        a, n = words.first[row], words.count[row]
        if n >= size:
            yield np.unique(runs[a : a + n - size + 1])
        elif n:
            yield rolling(hashes[a : a + n], int(n))
        else:
            yield np.zeros(0, np.uint64)


def digest_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def slack(n, percent: int):
    """The most shingles of a set of n that a linked set may lack: n - ceil(n * percent / 100)."""
    return n - (n * percent + 99) // 100


SETS = "doc_id long, mark long, n long, set long, counted array<long>, beyond array<long>"


def sets_of(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """For each row: its set's size and digest, its shingles in the counted part (once for each set in a
    task), and, if these are fewer than its prefix, as many of the others as the prefix lacks."""
    bound = np.uint64((1 << 64) // COUNTED)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            n, key, low, low_n, more, more_n = [], [], [], [], [], []
            for s in shingle_sets(b.column(1), size):
                n.append(len(s))
                key.append(digest_of(s))
                cut, need = int(np.searchsorted(s, bound)), 0
                if key[-1] in seen or not len(s):
                    cut = 0
                else:
                    seen.add(key[-1])
                    need = max(0, slack(len(s), percent) + 1 - cut)
                low.append(s[:cut])
                low_n.append(cut)
                more.append(s[cut : cut + need])
                more_n.append(need)
            join = lambda parts: np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(2),
                    pa.array(n, pa.int64()),
                    pa.array(key, pa.int64()),
                    lists(join(low), np.array(low_n), pa.int64()),
                    lists(join(more), np.array(more_n), pa.int64()),
                ],
                names=["doc_id", "mark", "n", "set", "counted", "beyond"],
            )

    return common.marked(docs, id_col, text_col).mapInArrow(task, SETS)


def index_entries(sets: DataFrame, percent: int) -> DataFrame:
    """The index: shingle, set, n, position (from 0) of the shingle in its set's order."""
    each = sets.filter("size(counted) > 0").select("set", "n", F.size("counted").alias("own"), "counted")
    tokens = each.select("set", "n", "own", F.explode("counted").alias("shingle"))
    shared = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    most = F.expr(f"n - cast((n * {percent} + 99) div 100 as bigint)")
    ordered = (
        tokens.join(shared, "shingle")
        .groupBy("set", "n", "own")
        .agg(F.sort_array(F.collect_set(F.struct("df", "shingle"))).alias("shared"))
        .withColumn("alone", F.col("own") - F.size("shared"))
        .filter(F.col("alone") <= most)
    )
    head = ordered.select(
        "set", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), (most + 1 - F.col("alone")).cast("int")))
    )
    counted = head.select("col.shingle", "set", "n", (F.col("alone") + F.col("pos")).alias("position"))
    beyond = sets.filter("size(beyond) > 0").select(
        "set", "n", F.size("counted").alias("own"), F.posexplode("beyond").alias("pos", "shingle")
    )
    beyond = beyond.select("shingle", "set", "n", (F.col("own") + F.col("pos")).alias("position")).distinct()
    return counted.unionByName(beyond)


def blocks(entries: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The lists cut by size: a set is in two blocks, and sets of sizes that a link allows share one."""
    # A little above the most that linked sets' sizes differ by, so they are at most one level apart.
    level = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent * 1.008))).cast("int")
    return entries.withColumn("block", F.explode(F.array(level, level - 1)))


def with_pivots(entries: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Blocks of two or more sets, each row with the block's pivot: the set that stands in most lists, so that
    few sets are pivots of many blocks."""
    lists = entries.groupBy("set").agg(F.count(F.lit(1)).alias("lists"))
    placed = blocks(entries.join(lists, "set"), percent)
    best = F.min(F.struct(-F.col("lists"), "n", "set")).alias("best")
    pivots = placed.groupBy("shingle", "block").agg(best, F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    pivots = pivots.select("shingle", "block", F.col("best.set").alias("pivot"))
    return placed.drop("lists").join(pivots, ["shingle", "block"])


def texts_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(set, shingles) of the wanted (doc_id, mark, set), out of the texts once more; a null doc_id is one of its own."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            new = [i for i, want in enumerate(b.column(0).to_pylist()) if want not in seen]
            b = b.take(pa.array(new, pa.int64()))
            key, out = [], []
            for want, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1), size), strict=True):
                if want not in seen and want == digest_of(s):
                    seen.add(want)
                    key.append(want)
                    out.append(s)
            flat = np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64)
            part = [pa.array(key, pa.int64()), lists(flat, np.array([len(s) for s in out], np.int64), pa.int64())]
            yield pa.RecordBatch.from_arrays(part, names=["set", "shingles"])

    rows = common.marked(docs, id_col, text_col)
    want = wanted.select(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark"), F.col("set").alias("want"))
    same = (F.col("mark") == F.col("of_mark")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
    made = rows.join(want, same).select("want", "text").mapInArrow(task, "set long, shingles array<long>")
    # Several rows may hold the text, in tasks of their own.
    made = common.stage(made, "shingles")
    repeated = made.groupBy("set").count().filter("count > 1")
    return made if repeated.isEmpty() else common.stage(made.dropDuplicates(["set"]), "shingles")


ANSWERS = "pivot long, set long, pivot_n long, n long, overlap long, lacks array<long>, adds array<long>"


def answers(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For each (pivot, set): overlap, the pivot's shingles that the set lacks, and those it has besides."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lacks, adds, overlap = [], [], []
            p_flat, s_flat = b.column(2), b.column(3)
            for i in range(b.num_rows):
                p = p_flat[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                s = s_flat[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                lacks.append(np.setdiff1d(p, s, assume_unique=True))
                adds.append(np.setdiff1d(s, p, assume_unique=True))
                overlap.append(len(p) - len(lacks[-1]))
            part = [
                b.column(0),
                b.column(1),
                pa.array([len(x.values) for x in p_flat], pa.int64()),
                pa.array([len(x.values) for x in s_flat], pa.int64()),
                pa.array(overlap, pa.int64()),
            ]
            for kept in (lacks, adds):
                flat = np.concatenate([np.zeros(0, np.uint64), *kept]).view(np.int64)
                part.append(lists(flat, np.array([len(x) for x in kept], np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(part, names=[c.split()[0] for c in ANSWERS.split(", ")])

    both = pairs.join(sets, "set").withColumnRenamed("shingles", "of_set")
    both = both.join(sets.select(F.col("set").alias("pivot"), F.col("shingles").alias("of_pivot")), "pivot")
    return both.select("pivot", "set", "of_pivot", "of_set").mapInArrow(task, ANSWERS)


def linked(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (a + b - overlap)


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def all_stars(edges: DataFrame) -> bool:
    """Whether each node of the distinct edges (a, b), b the smaller, is the smallest around it or has one neighbour."""
    around = both_ways(edges).groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("edges"))
    return not around.filter("m < a and edges > 1").agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b); root is the smallest node it reaches. Staged.

    Large star and small star in turn: each is one grouping by node, and in O(log n) rounds every
    node points at its root. Before a round one grouping tells whether they do already, so a graph of stars,
    as most links are, costs no round. Edges are written between the steps, so no plan grows and a step
    that is read twice isn't made twice. A node's neighbours never meet in one row: only their minimum is
    taken, and joined back.
    """
    now = common.stage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while not all_stars(now):
        both = both_ways(now)
        # Large star: larger neighbours of a node point at the smallest node around it.
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = common.stage(large, "edges")
        # Small star: smaller neighbours of a node, and itself, point at the smallest of them.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, now = now, common.stage(moved.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "edges")
        for old in (before, large):
            common.unstage(old)
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    classes = common.stage(ends.unionByName(tops), "classes")
    common.unstage(now)
    return classes


def joined_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (node, root) after more links (a, b): only the roots are a graph of their own."""
    root_of = lambda end: classes.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    ends = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    ends = ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    top = components(ends).withColumnRenamed("root", "top")
    below = classes.join(top, classes["root"] == top["node"], "left").select(
        classes["node"], F.coalesce("top", "root").alias("root")
    )
    new = top.select("node", F.col("top").alias("root")).join(classes, "node", "left_anti")
    joined = common.stage(below.unionByName(new), "classes")
    for old in (classes, top):
        common.unstage(old)
    return joined


def open_stars(index: DataFrame, found: DataFrame, classes: DataFrame) -> DataFrame:
    """(pivot, set, n, root, first, overlap, adds) of the sets, other than pivots, of blocks of several classes;
    first is the least position at which the set stands in such a block. Staged."""
    label = classes.select(F.col("node").alias("set"), "root")
    rows = index.join(label, "set", "left").withColumn("root", F.coalesce("root", "set"))
    several = rows.groupBy("shingle", "block").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    several = several.filter("x <> y").select("shingle", "block")
    rows = rows.join(several, ["shingle", "block"], "left_semi").filter("set <> pivot")
    rows = rows.groupBy("pivot", "set", "n", "root").agg(F.min("position").alias("first"))
    return common.stage(rows.join(found.select("pivot", "set", "overlap", "adds"), ["pivot", "set"]), "open")


def pairs_by_additions(stars: DataFrame) -> DataFrame:
    """Pairs (pivot, a, b) of a set and the best (with most of the pivot) of those of its star that share something
    the pivot lacks: a link to that one, found from the differences to the pivot, makes all other links of the set to
    its class needless."""
    each = stars.select("pivot", "set", "root", "overlap", F.explode("adds").alias("shingle"))
    best = F.min(F.struct(-F.col("overlap"), "set", "root")).alias("best")
    again = each.groupBy("pivot", "shingle").agg(best, F.min("root").alias("x"), F.max("root").alias("y"))
    again = again.filter("x <> y").select("pivot", "shingle", F.col("best.set").alias("b"), F.col("best.root").alias("of_b"))
    pairs = each.join(again, ["pivot", "shingle"]).filter(F.col("root") != F.col("of_b"))
    return pairs.select("pivot", F.col("set").alias("a"), "b").distinct()


def own_additions(stars: DataFrame) -> DataFrame:
    """(pivot, set, own): how much of what a set has besides its pivot no other set of the star has."""
    each = stars.select("pivot", "set", F.explode("adds").alias("shingle"))
    alone = each.groupBy("pivot", "shingle").agg(F.min("set").alias("set"), F.count(F.lit(1)).alias("sets"))
    return alone.filter("sets = 1").groupBy("pivot", "set").agg(F.count(F.lit(1)).alias("own"))


def derived_pairs(stars: DataFrame, percent: int) -> DataFrame:
    """Pairs (pivot, a, b) of sets of one star whose link is still open after all that can be skipped.

    Two sets of a star share at most the lesser overlap with the pivot and the lesser of what they have besides
    it in common with any other (`more`). So a set shares at most its `reach` with any, and a link needs
    a `reach` that suffices, for a partner of equal size, of the smaller one: only such sets
    look for partners, and only among larger ones.
    """
    rows = stars.withColumn("besides", F.size("adds")).drop("adds").join(own_additions(stars), ["pivot", "set"], "left")
    rows = rows.withColumn("more", F.col("besides") - F.coalesce("own", F.lit(0)))
    both, reach = 100 + percent, F.least(F.col("overlap") + F.col("more"), F.col("n") - F.col("first"))
    rows = common.stage(rows.withColumn("reach", reach).filter(100 * reach >= percent * F.col("n")), "reach")
    names = ["set", "n", "root", "overlap", "more", "reach"]
    strong = rows.filter(both * F.col("reach") >= 2 * percent * F.col("n"))
    a = strong.select("pivot", *[F.col(c).alias(f"a_{c}") for c in names])
    b = rows.select("pivot", *[F.col(c).alias(f"b_{c}") for c in names])
    c = F.col
    need = percent * (c("a_n") + c("b_n"))
    open_ = (
        ((c("a_n") < c("b_n")) | ((c("a_n") == c("b_n")) & (c("a_set") < c("b_set"))))
        & (c("a_root") != c("b_root"))
        & (100 * c("a_n") >= percent * c("b_n"))
        & (both * F.least("a_reach", "b_reach") >= need)
        & (both * (F.least("a_overlap", "b_overlap") + F.least("a_more", "b_more")) >= need)
    )
    pairs = a.join(b, ["pivot"]).filter(open_)
    return pairs.groupBy(c("a_set").alias("a"), c("b_set").alias("b")).agg(F.min("pivot").alias("pivot"))


def derived_links(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links among those pairs; the overlap follows from both sets' differences to the pivot."""
    side = lambda x: found.select(
        "pivot",
        F.col("set").alias(x),
        F.col("n").alias(f"{x}_n"),
        F.col("pivot_n").alias(f"{x}_pivot_n"),
        F.col("lacks").alias(f"{x}_lacks"),
        F.col("adds").alias(f"{x}_adds"),
    )
    both = pairs.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"])
    overlap = (
        F.col("a_pivot_n")
        - F.size(F.array_union("a_lacks", "b_lacks"))
        + F.size(F.array_intersect("a_adds", "b_adds"))
    )
    return both.filter(linked(overlap, F.col("a_n"), F.col("b_n"), percent)).select("a", "b")


def classes_of(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT
) -> DataFrame:
    """A row for each row of `docs`: doc_id, mark (hash of the text), n_shingles, component_id (smallest
    doc_id reached by links)."""
    common.small_batches(docs.sparkSession)
    whole = common.stage(sets_of(docs, id_col, text_col, size, percent), "sets")
    entries = common.stage(index_entries(whole, percent), "entries")
    sets = common.stage(whole.select("doc_id", "mark", "n", "set"), "sets")
    common.unstage(whole)
    # A set's name is its smallest doc_id and a text of that row; null if only rows without an identifier have the set.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")
    names = sets.filter("n > 0").groupBy("set").agg(first).select("set", "first.doc_id", "first.mark")

    index = common.stage(with_pivots(entries, percent), "index")
    common.unstage(entries)
    pairs = common.stage(index.filter("pivot <> set").select("pivot", "set").distinct(), "pairs")
    nodes = pairs.select("set").union(pairs.select(F.col("pivot").alias("set"))).distinct()
    shingles = texts_of(docs, names.join(nodes, "set"), id_col, text_col, size)
    found = common.stage(answers(pairs, shingles), "answers")
    for old in (shingles, pairs):
        common.unstage(old)

    links = found.filter(linked(F.col("overlap"), F.col("pivot_n"), F.col("n"), percent))
    links = links.select(F.col("pivot").alias("a"), F.col("set").alias("b"))
    classes = components(links)
    stars = open_stars(index, found, classes)
    near = common.stage(derived_links(pairs_by_additions(stars), found, percent), "links")
    if not near.isEmpty():
        classes = joined_classes(classes, near)
        common.unstage(stars)
        stars = open_stars(index, found, classes)
    rest = common.stage(derived_links(derived_pairs(stars, percent), found, percent), "links")
    if not rest.isEmpty():
        classes = joined_classes(classes, rest)
    for old in (stars, near, rest, index, found):
        common.unstage(old)
    classes = classes.withColumnRenamed("node", "set")

    named = names.join(classes, "set", "left").withColumn("root", F.coalesce("root", "set"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(least, "root").select("set", "component_id")
    rows = sets.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("set")).alias("set"))
    return rows.join(of_set, "set", "left").select(
        "doc_id",
        "mark",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` less those whose class has a row with a smaller doc_id; rows without an id stay."""
    gone = classes_of(docs, id_col, text_col).filter("component_id < doc_id")
    return common.without(docs, gone, "near-copies", id_col, text_col)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return classes_of(common.documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
        FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
  WHERE 100 * p.both >= 80 * (m.n + n.n - p.both)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r USING (doc_id)
GROUP BY d.doc_id, s.n
"""
