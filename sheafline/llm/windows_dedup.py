"""Repeated passages by super-k-mer partitioning.

A window is `size` consecutive words of one text. Its minimiser is the run of `MINIMISER`
words in it with the least hash. Consecutive windows that share a minimiser travel
together, as one string of words, to the bucket of that minimiser; equal windows
have equal minimisers, so they meet there. A bucket sorts its windows and finds, for each
distinct one, its first occurrence (least identifier, then least start); all others are
repeats.

* A task first looks for repeats among its own rows, batch by batch. Those are settled at
  once and don't travel, so a passage that a third of all texts share leaves a batch once.
* All strings that go from a batch to one bucket are one compressed row.
* The number of buckets follows the input. A bucket is read part by part; when it is larger than a
  part (a run of words that a great many texts have), its windows go on to Spark, which
  takes the least occurrence of each by a grouping that reduces before it shuffles.

Nulls and odd input: a null text has no words; texts shorter than a window have no windows;
a null doc_id counts as smaller than any other; rows that repeat an identifier with the same
text get the same result, as none of them is earlier; an empty table gives an empty
result; other columns are not looked at. Windows are told apart by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common
from sheafline.llm.words import Words, rolling, within_row

SIZE = 20
MINIMISER = 3
#: Bytes of text for which there is a bucket.
BUCKET_BYTES = 4 << 20
#: Bytes of strings that a task has in memory at once.
PART_BYTES = 32 << 20

NULL_ID = -(1 << 63)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values, in O(n log width)."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def occurrences(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: the word it starts at, and its 128 bits of hash."""
    at = np.flatnonzero(within_row(words, size))
    return at, rolling(words.hashes(0), size)[at], rolling(words.hashes(1), size)[at]


def later_ones(h0: np.ndarray, h1: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the same window occurs earlier (smaller doc, or same doc and smaller start)."""
    order = np.lexsort((start, doc, h1, h0))
    a, b = order[:-1], order[1:]
    same = (h0[a] == h0[b]) & (h1[a] == h1[b])
    later = np.zeros(len(order), bool)
    if not same.any():
        return later
    # The first of each run of equal windows, carried along the run.
    head = np.concatenate([[True], ~same])
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later[order] = (doc[order] > doc[first]) | (start[order] > start[first])
    return later


def runs_of(key: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the runs of consecutive positions with equal keys."""
    if not len(position):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero((np.diff(position) != 1) | (key[1:] != key[:-1])) + 1
    begin = np.concatenate([[0], cut])
    return begin, np.concatenate([cut, [len(position)]])


#: A super-k-mer in a packed row: identifier, mark of the text, first window's start, bytes of the string.
HEAD_TYPE = np.dtype([("doc", "<i8"), ("mark", "<i8"), ("start", "<i8"), ("bytes", "<i4")])

TRAVEL = "bucket long, raw long, packed binary, doc long, mark long, start long, windows long"


def mark_of(text: bytes) -> int:
    """64 bits of the text, to tell rows apart that repeat an identifier."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def travel(rows: DataFrame, size: int, buckets: int) -> DataFrame:
    """Packed super-k-mers by bucket; and (without a bucket) windows known to be repeats already."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        kind = pa.schema([(c.split()[0], pa.binary() if "binary" in c else pa.int64()) for c in TRAVEL.split(", ")])
        for b in batches:
            words = Words(b.column(1))
            at, h0, h1 = occurrences(words, size)
            if not len(at):
                continue
            ids = b.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            used = np.unique(words.row[at])
            marks = np.zeros(words.rows, np.int64)
            for r in used:
                marks[r] = mark_of(words.data[words.bounds[r] : words.bounds[r + 1]].tobytes())
            row = words.row[at]
            start = at - words.first[row]
            later = later_ones(h0, h1, ids[row], start)

            known = np.flatnonzero(later)
            begin, end = runs_of(row[known], at[known])
            first = known[begin]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(begin)) % buckets, pa.int64()),
                    pa.array(np.zeros(len(begin), np.int64)),
                    pa.nulls(len(begin), pa.binary()),
                    pa.array(ids[row[first]]),
                    pa.array(marks[row[first]]),
                    pa.array(start[first], pa.int64()),
                    pa.array(end - begin, pa.int64()),
                ],
                schema=kind,
            )

            left = np.flatnonzero(~later)
            least = window_minima(rolling(words.hashes(0), MINIMISER), size - MINIMISER + 1)[at[left]]
            begin, end = runs_of(least, at[left])
            first, last = at[left[begin]], at[left[end - 1]] + size - 1
            bucket = (least[begin] % np.uint64(buckets)).astype(np.int64)
            lo, hi = words.start[first], words.end[last]
            head = np.zeros(len(begin), HEAD_TYPE)
            head["doc"], head["mark"] = ids[words.row[first]], marks[words.row[first]]
            head["start"], head["bytes"] = first - words.first[words.row[first]], hi - lo
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            names, raw, packed = [], [], []
            text = memoryview(words.data)
            for group in np.split(order, cut):
                strings = b"".join([text[x:y] for x, y in zip(lo[group].tolist(), hi[group].tolist(), strict=True)])
                body = struct.pack("<q", len(group)) + head[group].tobytes() + strings
                names.append(int(bucket[group[0]]))
                raw.append(len(body))
                packed.append(squeeze(body))
            none = pa.nulls(len(names), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(raw, pa.int64()), pa.array(packed, pa.binary())] + [none] * 4,
                schema=kind,
            )

    return rows.mapInArrow(task, TRAVEL)


FOUND = "window binary, doc long, mark long, start long, windows long"


def settle(travelled: DataFrame, size: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """Repeats (without `window`); and each window of a bucket that was too large for one part."""
    kind = pa.schema([(c.split()[0], pa.binary() if "binary" in c else pa.int64()) for c in FOUND.split(", ")])

    def repeats(doc, mark, start, n):
        part = [pa.nulls(len(doc), pa.binary()), *(pa.array(x, pa.int64()) for x in (doc, mark, start, n))]
        return pa.RecordBatch.from_arrays(part, schema=kind)

    def part_of(bodies: list[bytes]):
        heads, strings = [], []
        for body in bodies:
            (n,) = struct.unpack_from("<q", body)
            heads.append(np.frombuffer(body, HEAD_TYPE, n, 8))
            strings.append(body[8 + n * HEAD_TYPE.itemsize :])
        head = np.concatenate(heads)
        bounds = np.zeros(len(head) + 1, np.int64)
        np.cumsum(head["bytes"], dtype=np.int64, out=bounds[1:])
        column = pa.Array.from_buffers(
            pa.large_string(),
            len(head),
            [None, pa.py_buffer(bounds), pa.py_buffer(b"".join(strings))],
        )
        words = Words(column)
        at, h0, h1 = occurrences(words, size)
        row = words.row[at]
        return at, row, head["doc"][row], head["mark"][row], head["start"][row] + at - words.first[row], h0, h1

    def finish(bodies: list[bytes], whole: bool) -> Iterator[pa.RecordBatch]:
        at, row, doc, mark, start, h0, h1 = part_of(bodies)
        later = later_ones(h0, h1, doc, start)
        if later.any():
            known = np.flatnonzero(later)
            begin, end = runs_of(row[known], at[known])
            first = known[begin]
            yield repeats(doc[first], mark[first], start[first], end - begin)
        if whole:
            return
        keys = np.stack([h0[~later], h1[~later]], 1)
        for i in range(0, len(keys), 1 << 16):
            block = keys[i : i + (1 << 16)]
            key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(block), [None, pa.py_buffer(block.tobytes())])
            own = [x[~later][i : i + (1 << 16)] for x in (doc, mark, start)]
            part = [key.cast(pa.binary()), *(pa.array(x, pa.int64()) for x in own), pa.array(np.ones(len(block), np.int64))]
            yield pa.RecordBatch.from_arrays(part, schema=kind)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        open_ = zstandard.ZstdDecompressor().decompress
        bucket, bodies, held, parts = None, [], 0, 0
        for b in batches:
            settled = b.column(2).is_null()
            done = b.filter(settled)
            if done.num_rows:
                yield repeats(*(done.column(i) for i in (3, 4, 5, 6)))
            for name, packed in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                if not packed.is_valid:
                    continue
                if name != bucket or held >= part_bytes:
                    if bodies:
                        yield from finish(bodies, whole=name != bucket and not parts)
                    parts = parts + 1 if name == bucket else 0
                    bucket, bodies, held = name, [], 0
                bodies.append(open_(packed.as_py()))
                held += len(bodies[-1])
        if bodies:
            yield from finish(bodies, whole=not parts)

    return travelled.mapInArrow(task, FOUND)


def repeated_windows(
    docs: DataFrame, size: int, id_col: str, text_col: str, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(doc, mark, repeats): for each text with repeated windows, their starts as (start, windows), staged."""
    spark = docs.sparkSession
    common.small_batches(spark, 1024)
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    moved = travel(rows, size, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = common.stage(settle(moved, size, part_bytes), "windows")

    here = found.filter("window is null").drop("window")
    open_ = found.filter("window is not null")
    first = open_.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    rest = open_.join(first.filter("n > 1").drop("n"), "window")
    rest = rest.filter("struct(doc, start) > first").select("doc", "mark", "start", "windows")
    each = here.unionByName(rest).groupBy("doc", "mark")
    return each.agg(F.collect_set(F.struct("start", "windows")).alias("repeats"))


KEPT = "doc_id long, n_words long, n_removed long, kept string"


def without_repeats(
    docs: DataFrame,
    size: int = SIZE,
    id_col: str = "doc_id",
    text_col: str = "text",
    sha256: bool = False,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """For each row: doc_id, n_words, n_removed, and the words kept, joined by a blank (or sha-256 of that)."""
    marked = repeated_windows(docs, size, id_col, text_col, part_bytes)

    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Words(b.column(1))
            out = []
            for r in range(words.rows):
                out.append(mark_of(words.data[words.bounds[r] : words.bounds[r + 1]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.int64())], names=["doc_id", "text", "mark"]
            )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Words(b.column(1))
            gone = np.zeros(len(words.start) + 1, np.int64)
            repeats = b.column(2)
            lengths = np.array([0 if not x.is_valid else len(x) for x in repeats], np.int64)
            flat = repeats.flatten()
            if len(flat):
                at = flat.field(0).to_numpy(zero_copy_only=False) + np.repeat(words.first[:-1], lengths)
                till = at + flat.field(1).to_numpy(zero_copy_only=False) + size - 1
                np.add.at(gone, at, 1)
                np.add.at(gone, till, -1)
            keep = np.cumsum(gone)[:-1] == 0
            n, removed, kept = [], [], []
            text = memoryview(words.data)
            for r in range(words.rows):
                own = np.arange(words.first[r], words.first[r + 1])
                left = own[keep[own]]
                n.append(len(own))
                removed.append(len(own) - len(left))
                line = b" ".join(
                    [text[x:y] for x, y in zip(words.start[left].tolist(), words.end[left].tolist(), strict=True)]
                )
                kept.append(hashlib.sha256(line).hexdigest() if sha256 else line.decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[c.split()[0] for c in KEPT.split(", ")],
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    rows = rows.mapInArrow(marks, "doc_id long, text string, mark long")
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NULL_ID)))
    joined = rows.join(marked, ["doc", "mark"], "left").select("doc_id", "text", "repeats")
    return joined.mapInArrow(task, KEPT)


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 20 words that are found earlier."""
    kept = without_repeats(common.documents(spark, sf_dir), sha256=True)
    return kept.withColumnRenamed("kept", "kept_sha256")


OP6_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, start, w[start + 1:start + 20] AS words
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS start FROM words WHERE len(w) >= 20)
), repeats AS (
  SELECT doc_id, start FROM windows
  QUALIFY row_number() OVER (PARTITION BY array_to_string(words, ' ') ORDER BY doc_id, start) > 1
), gone AS (
  SELECT DISTINCT doc_id, start + k AS place FROM repeats, range(20) t(k)
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM words
), kept AS (
  SELECT e.doc_id, count(*) AS n, count(g.place) AS removed,
         coalesce(string_agg(e.word, ' ' ORDER BY e.place) FILTER (g.place IS NULL), '') AS line
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.place = e.place GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(k.n, 0) AS n_words, coalesce(k.removed, 0) AS n_removed,
       sha256(coalesce(k.line, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
