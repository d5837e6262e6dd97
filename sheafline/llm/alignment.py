"""Alignment of two tokenizers over a corpus, by inverted bitmaps of token pairs.

Every text is encoded by a byte-level tokenizer A and a piece tokenizer B. Byte places where
tokens of both end cut a text into groups; all tokens of A and B in a group are linked.

Documents are numbered in chunks of 4096. For every pair of ids a chunk has the bitmap of the
documents that hold the pair linked: the bitmaps of each batch of texts are OR-merged, as 16-bit
positions or, where these would take more, as plain bits. Documents that hold it more than
once have their further links in multiplicity planes: plane j has the documents whose count
less one has bit j - 1. Popcounts, summed over the chunks, are a pair's documents and links in the
corpus. The counts then go back to the documents by the postings, that is, the bitmaps of each
chunk, which yields each document's scores; rows are never expanded to single links.

Both tokenizers begin a new token at a blank between two characters other than white space, so what stands
between such blanks is encoded and aligned once, and remembered.

Nulls and odd input: a null or empty text, and one whose tokens' bytes aren't its own (as when the text holds
the piece tokenizer's sign for a blank), has no tokens: counts are zero, `groups_sha256` is empty; a null
doc_id stays null; rows that repeat a doc_id are documents of their own; an empty table
gives an empty result; other columns are not looked at. A text with very many links ends its chunk.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common

SHIFT = 12
#: Documents of a chunk; a chunk also ends with the document by which it has CHUNK_LINKS links.
CHUNK = 1 << SHIFT
CHUNK_LINKS = 1 << 22
#: Parts of texts that a worker remembers.
REMEMBERED = 300_000

ROWS = (
    "chunk long, pos int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, plane int, n int, docs binary"
)
NAMES = [c.split()[0] for c in ROWS.split(", ")]


class Tokenizers:
    """Both tokenizers and the bytes of their ids; `ranks` and `pieces` are files, `pattern` is that of the ranks."""

    def __init__(self, ranks: str, pattern: str, pieces: str):
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={}).encode_ordinary
        self.a_size = {i: len(token) for token, i in known.items()}
        model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b = lambda text: model.encode(text, num_threads=1)
        self.b_count = model.get_piece_size()
        self.b_bytes = [self._bytes(model, i) for i in range(self.b_count)]
        self.a_sizes = np.zeros(max(known.values()) + 1, np.int64)
        self.a_sizes[list(self.a_size)] = list(self.a_size.values())
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # Ids as they are written: within a group, and at the end of its A or B side.
        self.a_written = [np.array([f"{i}{end}" for i in range(len(self.a_sizes))], object) for end in ",|"]
        self.b_written = [np.array([f"{i}{end}" for i in range(self.b_count)], object) for end in ",;"]

    @staticmethod
    def _bytes(model, i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text: str) -> list[tuple[list[int], list[int]]] | None:
        """The groups of blank + text; None if its tokens' bytes aren't its own."""
        a, b = self.a(" " + text), self.b(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != (" " + text).encode():
            return None
        out, i, j = [], 0, 0
        while i < len(a):
            from_i, from_j = i, j
            end_a, end_b = self.a_size[a[i]], len(self.b_bytes[b[j]])
            i, j = i + 1, j + 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a += self.a_size[a[i]]
                    i += 1
                else:
                    end_b += len(self.b_bytes[b[j]])
                    j += 1
            out.append((a[from_i:i], b[from_j:j]))
        return out

    def groups_of_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]] | None:
        """Of parts that begin and end without white space, encoded in one go with a blank between them: n_a, n_b, n_groups
        and links of each; pairs of all their links; their written groups. None if they have to be encoded one by one."""
        joined = " " + " ".join(parts)
        data = joined.encode()
        a, b = np.array(self.a(joined), np.int64), np.array(self.b(joined[1:]), np.int64)
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != data:
            return None
        end_a, end_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        at = np.searchsorted(end_b, end_a)
        last_a = end_b[at] == end_a
        last_b = np.zeros(len(b), bool)
        last_b[at[last_a]] = True
        n_a = np.diff(np.flatnonzero(last_a), prepend=-1)
        n_b = np.diff(np.flatnonzero(last_b), prepend=-1)
        end = end_a[last_a]
        ascii_ = len(data) == len(joined)
        size = np.array([len(p) for p in parts] if ascii_ else [len(p.encode()) for p in parts], np.int64) + 1
        # The groups before each part, and after the last one.
        bound = np.searchsorted(end, np.concatenate([[0], np.cumsum(size)]), "right")
        if (end[bound[1:] - 1] != np.cumsum(size)).any():
            return None
        upto_a, upto_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        links = n_a * n_b
        upto = np.concatenate([[0], np.cumsum(links)])
        of = np.repeat(np.arange(len(links)), links)
        k = np.arange(upto[-1]) - upto[of]
        pairs = a[upto_a[of] + k // n_b[of]] * self.b_count + b[upto_b[of] + k % n_b[of]]
        # A's ids of a group, then B's.
        signs = np.empty(len(a) + len(b), object)
        signs[np.arange(len(a)) + np.repeat(upto_b[:-1], n_a)] = np.where(last_a, self.a_written[1][a], self.a_written[0][a])
        signs[np.arange(len(b)) + np.repeat(upto_a[1:], n_b)] = np.where(last_b, self.b_written[1][b], self.b_written[0][b])
        signs, cuts = signs.tolist(), (upto_a + upto_b)[bound].tolist()
        text = ["".join(signs[x:y])[:-1].encode() for x, y in zip(cuts, cuts[1:], strict=False)]
        counts = np.stack([np.diff(x[bound]) for x in (upto_a, upto_b, np.arange(len(links) + 1), upto)], 1)
        return counts, pairs, text


def written(groups) -> bytes:
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups).encode()


def plain(part: str) -> bool:
    """Whether a part has no white space at an edge. Only such parts are the same whatever stands around them."""
    return bool(part) and not part[0].isspace() and not part[-1].isspace()


class Parts(dict):
    """Parts of texts to rows of a table: counts, links and written groups of each part. Parts with white space at an
    edge, which only a text's own edge can give, are held apart in `edges`."""

    #: What a blank alone stands between; the same cuts as of a text's split by blanks that has no white space at an edge.
    CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, tokenizers: Tokenizers):
        self.of = tokenizers
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.edges: dict[str, int] = {}
        self.counts = np.zeros((1024, 5), np.int64)  # n_a, n_b, n_groups, first link, links
        self.links = np.zeros(4096, np.int64)
        self.groups: list[bytes | None] = []
        self.held = 0

    def add(self, part: str) -> None:
        found = self.of.groups(part)
        pairs = [x * self.of.b_count + y for a, b in found or [] for x in a for y in b]
        n_a, n_b = (sum(len(g[k]) for g in found or []) for k in (0, 1))
        counts = np.array([[n_a, n_b, len(found or []), len(pairs)]])
        self._hold([part], counts, np.array(pairs, np.int64), [None if found is None else written(found)])

    def add_all(self, parts: list[str]) -> None:
        """Parts that aren't held yet, none twice."""
        together = [p for p in parts if plain(p)]
        found = self.of.groups_of_parts(together) if together else None
        if found is not None:
            self._hold(together, *found)
        for part in parts if found is None else [p for p in parts if not plain(p)] if len(together) < len(parts) else ():
            self.add(part)

    def _hold(self, parts: list[str], counts: np.ndarray, pairs: np.ndarray, groups: list[bytes | None]) -> None:
        row = len(self.groups)
        for at, part in enumerate(parts, row):
            (self if plain(part) else self.edges)[part] = at
        self.groups.extend(groups)
        while len(self.groups) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        while self.held + len(pairs) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[self.held : self.held + len(pairs)] = pairs
        new = self.counts[row : row + len(parts)]
        new[:, [0, 1, 2, 4]] = counts
        new[:, 3] = self.held + np.cumsum(counts[:, 3]) - counts[:, 3]
        self.held += len(pairs)

    def of_text(self, text: str) -> tuple[np.ndarray, np.ndarray, str] | None:
        """n_a, n_b and n_groups; pairs of all links; the digest of the groups. None without tokens."""
        if len(self.groups) > REMEMBERED:
            self.forget()
        parts = text.split(" ")
        rows = list(map(self.get, parts))
        if None in rows:
            if not all(plain(p) for p, row in zip(parts, rows, strict=True) if row is None):
                parts = self.CUT.split(text)
            self.add_all([p for p in dict.fromkeys(parts) if p not in self and p not in self.edges])
            rows = [self.edges[p] if row is None else row for p, row in zip(parts, map(self.get, parts), strict=True)]
        groups = list(map(self.groups.__getitem__, rows))
        if None in groups:
            return None
        counts = self.counts[rows]
        first, n = counts[:, 3], counts[:, 4]
        upto = np.cumsum(n)
        pairs = self.links[np.repeat(first - (upto - n), n) + np.arange(upto[-1])]
        return counts[:, :3].sum(0), pairs, hashlib.sha256(b";".join(groups)).hexdigest()


_PARTS: dict[tuple, Parts] = {}


def parts_of(files: tuple[str, str, str]) -> Parts:
    """One for each worker process."""
    if files not in _PARTS:
        _PARTS[files] = Parts(Tokenizers(*files))
    return _PARTS[files]


def bitmaps(pair: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For rows sorted by (pair, pos): each pair, its documents' number, and its bitmap. One of fewer than CHUNK / 16
    documents is their positions in 16 bits each, any other one the bits themselves."""
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    card = np.diff(np.append(first, len(pair)))
    few = card < CHUNK // 16
    size = np.where(few, 2 * card, CHUNK // 8)
    offset = np.concatenate([[0], np.cumsum(size)])
    data = np.zeros(int(offset[-1]), np.uint8)
    of = np.repeat(np.arange(len(first)), card)
    thin = few[of]
    place = offset[of] // 2 + np.arange(len(pair)) - first[of]
    data.view("<u2")[place[thin]] = pos[thin]
    thick = ~thin
    np.bitwise_or.at(data, offset[of[thick]] + (pos[thick] >> 3), (1 << (pos[thick] & 7)).astype(np.uint8))
    buffers = [None, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(data)]
    return pair[first], card, pa.Array.from_buffers(pa.binary(), len(first), buffers)


def positions(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a column of bitmaps: each document's position, and the number of documents of each row."""
    offset = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offset[0] : offset[-1]] if raw is not None else np.zeros(0, np.uint8)
    offset = offset - offset[0]
    size = np.diff(offset)
    thick = size == CHUNK // 8
    card = size // 2
    if not thick.any():
        return data.view("<u2").astype(np.int64), card
    rows = data[offset[:-1][thick][:, None] + np.arange(CHUNK // 8)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    card[thick] = bits.sum(1)
    out = np.empty(int(card.sum()), np.int64)
    full = np.repeat(thick, card)
    out[full] = np.nonzero(bits)[1]
    out[~full] = data[np.repeat(~thick, size)].view("<u2")
    return out, card


class Chunk:
    """Documents numbered from 0, and the pairs that each holds."""

    def __init__(self, number: int, most_links: int = CHUNK_LINKS):
        self.number, self.most_links = number, most_links
        self.docs, self.now, self.merged, self.links = [], [], [], 0

    def add(self, row: tuple, pairs: np.ndarray) -> None:
        self.now.append(pairs << SHIFT | len(self.docs))
        self.docs.append(row)
        self.links += len(pairs)

    def merge(self) -> None:
        """The batch's links as (pair, position) with their number."""
        if self.now:
            self.merged.append(np.unique(np.concatenate(self.now), return_counts=True))
            self.now = []

    def full(self) -> bool:
        return len(self.docs) >= CHUNK or self.links >= self.most_links

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        n = len(self.docs)
        columns = dict(zip(NAMES[2:8], zip(*self.docs, strict=True), strict=True))
        columns |= {"chunk": [self.number] * n, "pos": range(n)}
        yield batch(n, columns)
        key = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in self.merged)])
        more = np.concatenate([np.zeros(0, np.int64), *(c for _, c in self.merged)]) - 1
        order = np.argsort(key, kind="stable")
        key, more, plane = key[order], more[order], 0
        yield from self._plane(key, 0)
        plane = 1
        while len(key):
            odd = more & 1 == 1
            yield from self._plane(key[odd], plane)
            left = more > 1
            key, more, plane = key[left], more[left] >> 1, plane + 1

    def _plane(self, key: np.ndarray, plane: int) -> Iterator[pa.RecordBatch]:
        if len(key):
            pair, card, docs = bitmaps(key >> SHIFT, key & (CHUNK - 1))
            n = len(pair)
            columns = {"chunk": np.full(n, self.number), "pair": pair, "plane": np.full(n, plane), "n": card, "docs": docs}
            out = batch(n, columns)
            yield from (out.slice(at, 20_000) for at in range(0, n, 20_000))


KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def batch(n: int, columns: dict) -> pa.RecordBatch:
    """A batch of ROWS; columns that aren't given are null."""
    out = []
    for c in ROWS.split(", "):
        name, kind = c.split()
        kind = KINDS[kind]
        got = columns.get(name)
        if got is None:
            out.append(pa.nulls(n, kind))
        else:
            out.append(got if isinstance(got, pa.Array) else pa.array(np.asarray(got) if name in ("chunk", "pair") else got, kind))
    return pa.RecordBatch.from_arrays(out, names=NAMES)


def inverted(
    docs: DataFrame,
    files: tuple[str, str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_links: int = CHUNK_LINKS,
) -> DataFrame:
    """Staged rows of two kinds: documents (`pair` is null) with their counts, and postings (`pos` is null)."""
    common.small_batches(docs.sparkSession)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, none = parts_of(files), np.zeros(0, np.int64)
        chunk = Chunk(TaskContext.get().partitionId() << 32, chunk_links)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = known.of_text(text) if text else None
                if found is None:
                    chunk.add((doc_id, 0, 0, 0, 0, ""), none)
                else:
                    counts, pairs, digest = found
                    chunk.add((doc_id, *counts.tolist(), len(pairs), digest), pairs)
                if chunk.full():
                    yield from chunk.rows()
                    chunk = Chunk(chunk.number + 1, chunk_links)
            chunk.merge()
        if chunk.docs:
            yield from chunk.rows()

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    return common.stage(rows.mapInArrow(task, ROWS), "pair-bitmaps")


#: Links that a document in a plane stands for: plane 0 is the bitmap itself.
WEIGHT = "case when plane = 0 then 1L else shiftleft(1L, plane - 1) end"


def pair_counts(rows: DataFrame, b_count: int) -> DataFrame:
    """(pair, a, b, documents, links, best) of every pair in the corpus; best: no pair of its `a` is in more documents."""
    counted = rows.filter("pair is not null").groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n")).cast("long")).alias("documents"),
        F.sum(F.expr(WEIGHT) * F.col("n")).alias("links"),
    )
    counted = counted.withColumn("a", F.expr(f"pair div {b_count}")).withColumn("b", F.col("pair") % b_count)
    counted = common.stage(counted, "pair-counts")
    most = counted.groupBy("a").agg(F.max("documents").alias("most"))
    return counted.join(most, "a").withColumn("best", F.col("documents") == F.col("most")).drop("most")


def scores(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, pos, n_best, count_sum): the pairs' counts back at the documents, by the bitmaps."""
    out = "chunk long, pos int, n_best long, count_sum long"
    sent = rows.filter("pair is not null").select("chunk", "pair", "plane", "docs")
    sent = sent.join(counts.select("pair", "documents", "best"), "pair").select(
        "chunk", (F.expr(WEIGHT) * F.col("documents")).alias("score"),
        F.when(F.col("best"), F.expr(WEIGHT)).otherwise(0).alias("best"), "docs",
    )
    sent = sent.repartition("chunk").sortWithinPartitions("chunk")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros((2, CHUNK), np.int64)

        def done() -> pa.RecordBatch:
            pos = np.flatnonzero(total[1])
            columns = [pa.array(np.full(len(pos), at)), pa.array(pos, pa.int32()), pa.array(total[0, pos]), pa.array(total[1, pos])]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "pos", "n_best", "count_sum"])

        for b in batches:
            chunk = b.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
            for begin, end in zip(edges, edges[1:], strict=False):
                if begin == end:
                    continue
                if chunk[begin] != at:
                    if at is not None:
                        yield done()
                    at, total = chunk[begin], np.zeros((2, CHUNK), np.int64)
                part = b.slice(begin, end - begin)
                pos, card = positions(part.column(3))
                for row, column in ((1, 1), (0, 2)):
                    np.add.at(total[row], pos, np.repeat(part.column(column).to_numpy(), card))
        if at is not None:
            yield done()

    return sent.mapInArrow(task, out)


def align(
    docs: DataFrame,
    files: tuple[str, str, str],
    b_count: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_links: int = CHUNK_LINKS,
) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = inverted(docs, files, id_col, text_col, chunk_links)
    of_doc = scores(rows, pair_counts(rows, b_count))
    of_docs = rows.filter("pair is null").select(*NAMES[:8])
    return of_docs.join(of_doc, ["chunk", "pos"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )


def vocabularies() -> tuple[tuple[str, str, str], int]:
    """Files and pattern of the two public tokenizers, and the number of pieces."""
    import public_tokenizers
    import sentencepiece

    pieces = public_tokenizers.path("piece_bpe_32k.model")
    count = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    return (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, pieces), count


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers aligned over all documents."""
    return align(common.documents(spark, sf_dir), *vocabularies())
