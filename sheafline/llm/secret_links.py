"""Secret scan with multipart credential linking.

Each text is scanned once for parts: identifiers (access keys, login names), secrets
(assignments, hex, 40-character keys) and endpoints (URLs). Strong parts stand by
themselves. Weak ones (a login name, a short password, an unnamed key, an endpoint) mean nothing
alone: they are reported only if a part that completes them lies in the same scope, however far
away. A scope is a stretch of text without an empty line.

Linking joins parts to the intervals of their scopes. What a weak part needs to know of the others is
whether its scope holds a completing role, so each scope is first reduced to its parts of each role,
counted before anything is shuffled, and weak parts meet these counts: no two parts are paired,
however many a scope has.

Nulls and odd input: a null text is empty; a null identifier stays null; rows that repeat an
identifier are scanned each; an empty table gives an empty result; other columns
are not looked at. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import re
from bisect import bisect, bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common

# Base kinds, in order, with their patterns; the group and the length that a match needs.
BASE = (
    (
        "assign",
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
        ),
        2,
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = [k for k, *_ in BASE]
#: The same matches as BASE's, found without a stop at each short one.
HEX = re.compile(r"[0-9a-f]{32,}")

#: Weak kinds, their role and pattern.
WEAK = (
    ("login", "id", re.compile(r"(?:user(?:name)?|login|account|client_id)[\"']?\x20*[:=]\x20*[\"']?([\w.@+-]{3,})", re.I)),
    ("key", "secret", re.compile(r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+]{39}[A-Za-z0-9/+=](?![A-Za-z0-9/+=])")),
    ("endpoint", "endpoint", re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]+", re.I)),
)
SHORT = "short"  # an assignment of fewer than eight characters, at least four
ORDER = [*KINDS, "login", "key", "short", "endpoint"]
ROLE = {"assign": "secret", "hex": "secret", "access": "id", "login": "id", "key": "secret", "short": "secret",
        "endpoint": "endpoint"}
#: What completes a weak part of a role.
COMPLETES = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}

EMPTY_LINE = re.compile(r"\n[^\S\n]*\n")

PART = "struct<kind: string, start: bigint, end: bigint, scope: bigint>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the base kinds, by start and then kind as listed."""
    out = []
    if ":" in text or "=" in text:
        _, pattern, group, least = BASE[0]
        out += [("assign", *m.span()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    if "AKIA" in text:
        _, pattern, group, least = BASE[1]
        out += [("access", *m.span()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def weak_parts(text: str) -> list[tuple[str, int, int]]:
    """Candidates that need another part, whether or not base spans cover them."""
    out = []
    if ":" in text or "=" in text:
        _, pattern, group, least = BASE[0]
        out += [(SHORT, *m.span()) for m in pattern.finditer(text) if 4 <= len(m.group(group)) < least]
        out += [("login", *m.span()) for m in WEAK[0][2].finditer(text)]
    out += [("key", *m.span()) for m in WEAK[1][2].finditer(text)]
    if "://" in text:
        out += [("endpoint", *m.span()) for m in WEAK[2][2].finditer(text)]
    return out


def outside(parts: list[tuple[str, int, int]], spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The parts that overlap none of the spans (sorted by start)."""
    starts = [s for _, s, _ in spans]
    reach, furthest = [0], 0
    for _, _, e in spans:
        furthest = max(furthest, e)
        reach.append(furthest)
    return [p for p in parts if reach[bisect_left(starts, p[2])] <= p[1]]


def scopes(text: str, parts: list[tuple[str, int, int]]) -> list[int]:
    """The scope of each part, as the number of empty lines before it."""
    cuts = [m.start() for m in EMPTY_LINE.finditer(text)] if parts else []
    return [bisect(cuts, start) for _, start, _ in parts]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: row (a number of its own), doc_id, base and weak (arrays of parts). Staged."""
    common.small_batches(docs.sparkSession)
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: tuple[list, list] = ([], [])
            for text in b.column(1).to_pylist():
                text = text or ""
                found = base_spans(text)
                weak = outside(weak_parts(text), found)
                for column, parts in zip(columns, (found, weak), strict=True):
                    at = scopes(text, parts)
                    names = ("kind", "start", "end", "scope")
                    column.append([dict(zip(names, (*p, a), strict=True)) for p, a in zip(parts, at, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.list_(struct)) for c in columns)], names=["doc_id", "base", "weak"]
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    made = rows.mapInArrow(task, f"doc_id long, base array<{PART}>, weak array<{PART}>")
    return common.stage(made.withColumn("row", F.monotonically_increasing_id()), "parts")


def link(scanned: DataFrame) -> DataFrame:
    """(row, linked): the weak parts that another part of their scope completes, for the rows that have some."""

    def role(kind: Column) -> Column:
        return F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[kind]

    with_weak = scanned.filter("size(weak) > 0")
    every = with_weak.select("row", F.explode(F.concat("base", "weak")).alias("q"))
    own = role(F.col("q.kind"))
    held_roles = [F.count_if(own == r).alias(r) for r in COMPLETES]
    held = every.groupBy("row", F.col("q.scope").alias("scope")).agg(*held_roles)
    weak = with_weak.select("row", F.explode("weak").alias("p")).withColumn("scope", F.col("p.scope"))
    fits = F.lit(False)
    for mine, others in COMPLETES.items():
        there = [F.col(r) > 0 for r in others]
        fits = fits | ((role(F.col("p.kind")) == mine) & functools.reduce(operator.or_, there))
    pairs = weak.join(held, ["row", "scope"]).filter(fits)
    return pairs.groupBy("row").agg(F.collect_set("p").alias("linked"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind as listed."""
    place = F.create_map(*[x for i, k in enumerate(ORDER) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], place[s["kind"]].alias("o"), s["end"], s["kind"]))
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: doc_id, base and linked (arrays of parts: kind, start, end, scope)."""
    scanned = scan(docs, id_col, text_col)
    none = F.array().cast(f"array<{PART}>")
    out = scanned.join(link(scanned), "row", "left")
    return out.select("doc_id", "base", F.coalesce("linked", none).alias("linked"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document."""
    found = secrets(common.documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "linked")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    """The digest of base spans, as the query gives it."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
