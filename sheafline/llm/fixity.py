"""Merkle fixity audit of archive replicas.

A replica is files of records, each record with its offset in the file. The leaves of a
file's tree are its records in order of their offsets: a digest of offset, length and bytes. A
node stands for the ordered range of offsets of its `FAN` children and is the digest of these in order.
The files' roots, in order of the files, are the leaves of one tree above.

An audit compares the roots of two replicas and goes down only below nodes that differ;
where everything is as it should be, that is one comparison. The nodes of all levels are
small tables, staged by level, so an audit reads the bytes once for each replica and shuffles
their lengths and digests alone.
Trees of unequal depth are made equally deep first: above a root of the shallower one come nodes with one child.

Nulls and odd input: null bytes are other than empty ones; a record without file or offset has no place
in a tree and is left out; records of one file that repeat an offset are told apart
by their digests, in order of these; an empty replica lacks every record of the other; other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.llm import common

FAN = 16
#: Records in a file, of the archive that the query makes of the table of pages.
FILE_RECORDS = 256


def measured(records: DataFrame) -> DataFrame:
    """(file, offset, length, sha) of (file, offset, bytes): all that the trees need, so no bytes go on from the scan.
    Records that come with length and sha stay as they are."""
    if "bytes" not in records.columns:
        return records.select("file", "offset", "length", "sha")
    length = F.coalesce(F.octet_length("bytes"), F.lit(-1)).cast("long").alias("length")
    return records.select("file", "offset", length, F.sha2("bytes", 256).alias("sha"))


def leaves(records: DataFrame) -> DataFrame:
    """(file, node, first, last, digest) of records: node numbers the records of a file from 0."""
    text = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "sha")
    placed = measured(records).filter(F.col("file").isNotNull() & F.col("offset").isNotNull())
    placed = placed.select(
        F.col("file").cast("long").alias("file"),
        F.col("offset").cast("long").alias("first"),
        (F.col("offset") + F.greatest("length", F.lit(0))).cast("long").alias("last"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )
    order = Window.partitionBy("file").orderBy("first", "digest")
    return placed.withColumn("node", (F.row_number().over(order) - 1).cast("long"))


def parents(nodes: DataFrame, keys: list[str], fan: int) -> DataFrame:
    """The level above: up to `fan` children, in order, make a node."""
    children = F.sort_array(F.collect_list(F.struct("node", "digest")))
    digest = F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), ":").cast("binary"), 256)
    up = nodes.withColumn("up", F.expr(f"node div {fan}")).groupBy(*keys, "up")
    return up.agg(digest.alias("digest"), F.min("first").alias("first"), F.max("last").alias("last")).withColumnRenamed(
        "up", "node"
    )


def levels(bottom: DataFrame, keys: list[str], fan: int, name: str) -> list[DataFrame]:
    """All levels from the bottom up, staged; the last has node 0 alone for each key."""
    out = [common.stage(bottom, name)]
    while (out[-1].agg(F.max("node").alias("n")).first().n or 0) > 0:
        out.append(common.stage(parents(out[-1], keys, fan), name))
    return out


def equally_deep(a: list[DataFrame], b: list[DataFrame], keys: list[str], fan: int, name: str) -> None:
    """Put nodes with one child above the roots of the shallower of two trees, until it is as deep as the other."""
    shallow, depth = min(a, b, key=len), max(len(a), len(b))
    while len(shallow) < depth:
        shallow.append(common.stage(parents(shallow[-1], keys, fan), name))


def roots_of(files: list[DataFrame]) -> DataFrame:
    """The roots of all files as leaves of the tree above."""
    return files[-1].select(F.lit(0).alias("all"), F.col("file").alias("node"), "digest", "first", "last")


def differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes that differ, or that one of both lacks."""
    left = a.select(*keys, F.col("digest").alias("digest_a"), F.col("first").alias("first_a"), F.col("last").alias("last_a"))
    right = b.select(*keys, F.col("digest").alias("digest_b"), F.col("first").alias("first_b"), F.col("last").alias("last_b"))
    return left.join(right, keys, "full").filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def descend(a: list[DataFrame], b: list[DataFrame], keys: list[str], start: DataFrame | None, fan: int) -> DataFrame:
    """The bottom nodes that differ. `start` names the keys to look at (None: all); each level looks only
    at children of the nodes found above. The trees are equally deep."""
    wanted, node_keys = start, keys
    found = None
    for level in reversed(range(len(a))):
        sides = []
        for tree in (a, b):
            nodes = tree[level]
            if wanted is not None:
                on = [F.expr(f"node div {fan}") if k == "node" else F.col(k) for k in node_keys]
                nodes = nodes.withColumns({f"__{k}": c for k, c in zip(node_keys, on, strict=True)})
                want = wanted.select(*[F.col(k).alias(f"__{k}") for k in node_keys]).distinct()
                nodes = nodes.join(want, [f"__{k}" for k in node_keys], "left_semi").drop(*[f"__{k}" for k in node_keys])
            sides.append(nodes)
        found = common.stage(differing(*sides, [*keys, "node"]), "differing")
        wanted, node_keys = found, [*keys, "node"]
    return found


def audit(a: DataFrame, b: DataFrame, fan: int = FAN) -> DataFrame:
    """(file, first_a, last_a, first_b, last_b, digest_a, digest_b) of each place, by order in its file, at which the
    replicas (file, offset, bytes) differ; nulls where a replica has no record there."""
    one, two = (levels(leaves(records), ["file"], fan, "file-tree") for records in (a, b))
    equally_deep(one, two, ["file"], fan, "file-tree")
    # The trees above the files' roots.
    top_one, top_two = (levels(roots_of(files), ["all"], fan, "tree") for files in (one, two))
    equally_deep(top_one, top_two, ["all"], fan, "tree")
    files = descend(top_one, top_two, ["all"], None, fan).select(F.col("node").alias("file"))
    return descend(one, two, ["file"], files, fan)


def record_of(body: Column) -> Column:
    lines = F.concat(F.lit("WARC-Target-URI: "), F.coalesce("url", F.lit("")), F.lit("\r\n\r\n"), F.coalesce(body, F.lit("")))
    return lines.cast("binary")


def archive(pages: DataFrame, body: Column) -> DataFrame:
    """Pages as records (file, offset, page_id, length, sha): FILE_RECORDS ids to a file, one record after the
    other. Rows that share an id are records each, by the digest of what `html` says. Bytes are measured in the scan."""
    record = record_of(body)
    rows = pages.filter("page_id is not null").select(
        F.expr(f"page_id div {FILE_RECORDS}").alias("file"),
        "page_id",
        F.sha2(record_of(F.col("html")), 256).alias("tie"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("sha"),
    )
    before = Window.partitionBy("file").orderBy("page_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("tie")


#: Of the second replica, pages whose URL's digest begins so have a changed sign at the end of their text.
DAMAGED = "0"


def op5_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages that differ between two replicas, of which one has damage where `DAMAGED` says."""
    pages = common.read(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    hurt = F.md5(F.coalesce("url", F.lit("")).cast("binary")).startswith(DAMAGED)
    cut = F.expr("concat(substr(html, 1, length(html) - 1), if(endswith(html, '#'), '*', '#'))")
    sound = archive(pages, F.col("html"))
    found = audit(sound, archive(pages, F.when(hurt & (F.length("html") > 0), cut).otherwise(F.col("html"))))
    # No record is empty, so a place in a file is one record's.
    names = sound.select("file", F.col("offset").alias("first_a"), "page_id", "length")
    found = found.select("file", "first_a").join(names, ["file", "first_a"])
    return found.select("page_id", "file", F.col("first_a").alias("offset"), "length")


OP5_SQL = """
WITH records AS (
  SELECT page_id, page_id // 256 AS file,
         strlen('WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, ''))
           AS length,
         sha256('WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, ''))
           AS tie,
         starts_with(md5(coalesce(url, '')), '0') AND length(coalesce(html, '')) > 0 AS hurt
  FROM pages WHERE page_id IS NOT NULL
), placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, tie
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM records
)
SELECT page_id, file, "offset", length FROM placed WHERE hurt
"""
