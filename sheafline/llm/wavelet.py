"""Token ids of a corpus in wavelet matrices: succinct, searchable, one compressed file for each shard.

A shard is a range of documents in ascending order of doc_id, written by one task as one
compressed file. Its rows are segments, each a wavelet matrix of the ids of whole
documents: one plane of bits for each bit of an id, from the highest, where every plane
holds the bits in the order that stable partitions by the planes above have left, the
number of zeros of each plane, and ones counted before every 512 bits (the rank directory).
From a segment come a token by its place (access), the occurrences of a token before a
place (rank, and so counts), the place of its k-th occurrence (select), and all ids at once.
A segment ends with the document that fills it, so tasks hold a segment and no more.

Nulls and odd input: a null text is the empty text and has the end id alone; a null
doc_id comes before all others; rows that repeat a doc_id are documents of their own, side
by side, in the order of a hash of their text; white space alone gives the end id alone; an
empty table gives no file's rows and an empty result; other columns are not looked at. A very long
text is a segment of its own.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.llm import common
from sheafline.llm.words import lists

#: Ids that fill a segment.
SEGMENT_IDS = 1 << 16
#: Bytes of text that a shard is made for; there are never fewer shards than shuffle partitions.
SHARD_BYTES = 1 << 27
#: Bits between two entries of a rank directory.
STEP_BITS = 512
#: Words whose ids a worker remembers in each of two generations.
REMEMBERED = 500_000

SCHEMA = (
    "shard int, segment int, first long, n int, bits int, doc_ids array<long>, lengths array<int>, "
    "zeros array<int>, planes array<binary>, ranks array<binary>"
)


class Matrix:
    """A wavelet matrix over ids below 2^bits."""

    def __init__(self, n: int, planes: list[bytes], zeros: list[int], ranks: list[bytes]):
        self.n, self.zeros = n, zeros
        self.packed = [np.frombuffer(p, np.uint8) for p in planes]
        self.before = [np.frombuffer(r, "<u4") for r in ranks]

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> Matrix:
        planes, zeros, ranks = [], [], []
        for shift in range(bits - 1, -1, -1):
            bit = (ids & ids.dtype.type(1 << shift)).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            whole = np.zeros(-(-len(ids) // STEP_BITS) * STEP_BITS // 8, np.uint8)
            whole[: len(packed)] = packed
            ones = np.bitwise_count(whole).reshape(-1, STEP_BITS // 8).sum(1, dtype=np.uint32)
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes())
            low = ids.compress(~bit)  # several times as fast as a mask as the index
            zeros.append(len(low))
            ids = np.concatenate([low, ids.compress(bit)])
        return cls(len(ids), planes, zeros, ranks)

    def bit(self, plane: int, at: np.ndarray) -> np.ndarray:
        return (self.packed[plane][at >> 3] >> (at & 7).astype(np.uint8)) & 1

    def ones(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a plane before each place."""
        packed, step = self.packed[plane], STEP_BITS // 8
        block = at // STEP_BITS
        total = self.before[plane][block].astype(np.int64)
        byte = block * step
        for _ in range(step):
            inside = byte < (at >> 3)
            if not inside.any():
                break
            total[inside] += np.bitwise_count(packed[byte[inside]])
            byte += 1
        part = np.flatnonzero(at & 7)
        mask = ((1 << (at[part] & 7)) - 1).astype(np.uint8)
        total[part] += np.bitwise_count(packed[at[part] >> 3] & mask)
        return total

    def access(self, at) -> np.ndarray:
        """The ids at the places `at`."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.int64)
        for plane, zeros in enumerate(self.zeros):
            bit, one = self.bit(plane, at), self.ones(plane, at)
            out = out << 1 | bit
            at = np.where(bit == 1, zeros + one, at - one)
        return out

    def _range(self, token: int, end: int) -> list[int]:
        """Begin and end, behind the last plane, of the token's occurrences before `end`."""
        at = np.array([0, end], np.int64)
        for plane, zeros in enumerate(self.zeros):
            one = self.ones(plane, at)
            at = zeros + one if token >> (len(self.zeros) - 1 - plane) & 1 else at - one
        return at.tolist()

    def rank(self, token: int, end: int) -> int:
        """How often the token occurs before `end`."""
        if token >> len(self.zeros):
            return 0
        begin, upto = self._range(token, end)
        return upto - begin

    def select(self, token: int, k) -> np.ndarray:
        """The places of the k-th (from 0) occurrences."""
        begin, upto = self._range(token, self.n) if not token >> len(self.zeros) else (0, 0)
        at = begin + np.asarray(k, np.int64)
        if len(at) and (at.min() < begin or at.max() >= upto):
            raise IndexError("the token doesn't occur as often")
        for plane in range(len(self.zeros) - 1, -1, -1):
            if token >> (len(self.zeros) - 1 - plane) & 1:
                at = self._place_of(plane, at - self.zeros[plane], True)
            else:
                at = self._place_of(plane, at, False)
        return at

    def _place_of(self, plane: int, k: np.ndarray, ones: bool) -> np.ndarray:
        """The places of a plane's k-th set (or unset) bits: by the directory, then inside a step."""
        before = self.before[plane].astype(np.int64)
        if not ones:
            before = np.arange(len(before)) * STEP_BITS - before
        block = np.searchsorted(before, k, "right") - 1
        step = STEP_BITS // 8
        whole = np.zeros((len(before) - 1) * step, np.uint8)
        whole[: len(self.packed[plane])] = self.packed[plane]
        bits = np.unpackbits(whole.reshape(-1, step)[block], axis=1, bitorder="little").astype(bool)
        count = np.cumsum(bits if ones else ~bits, axis=1)
        return block * STEP_BITS + (count <= (k - before[block])[:, None]).sum(1)

    def occurrences(self, token: int) -> np.ndarray:
        """All places of a token, ascending."""
        return self.select(token, np.arange(self.rank(token, self.n)))

    def ids(self, kind=np.uint16) -> np.ndarray:
        """All ids: partitions undone plane by plane, from the lowest."""
        out = np.zeros(self.n, kind)
        for plane in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.packed[plane], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(out)
            above[np.flatnonzero(~bit)] = out[: self.zeros[plane]]
            above[np.flatnonzero(bit)] = out[self.zeros[plane] :] | kind(1 << (len(self.zeros) - 1 - plane))
            out = above
        return out


class Remembered(dict):
    """Ids of a word, as bytes; words met again go over from the older generation, so frequent ones stay."""

    def __init__(self, encode: Callable[[str], list[int]], kind: str):
        self.encode, self.kind, self.older = encode, kind, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        out = self.older.get(word)
        if out is None:
            out = array(self.kind, self.encode(word)).tobytes()
        self[word] = out
        return out


class WordIds:
    """Ids of a text as bytes, exactly the tokenizer's, word by word.

    For tokenizers that make nothing of white space but an edge between words, as the word-level vocabulary does.
    Texts of Latin-1 alone, which composing leaves as they are, are lower-cased and cut by its pattern here, and the words
    go straight to its merges. Of all others, and of those that may hold a special token, what stands between
    blanks goes through the whole tokenizer.
    """

    LETTERS = "a-zª\xb5ºß-öø-ÿ"
    NUMBERS = "0-9²³¹¼½¾"
    #: In a text without any of these, blanks, lines and single full stops and commas part the words.
    OTHERWISE = re.compile(f"[^{LETTERS} \\n.,]|[.,][.,]")
    WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\x09-\\x0d \\x85\\xa0{LETTERS}{NUMBERS}]+")

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(file)
        self.bits = max(1, (tokenizer.get_vocab_size() - 1).bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        # The sign that stands for each byte, asked of the library's own byte-level step.
        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        table = str.maketrans({chr(c): signs.pre_tokenize_str(chr(c))[0][0] for c in range(256)})
        merges = tokenizer.model.tokenize
        code = np.dtype(self.kind).char
        self.words = Remembered(lambda word: [t.id for t in merges(word.translate(table))], code)
        self.parts = Remembered(lambda part: tokenizer.encode(part, add_special_tokens=False).ids, code)

    def of_text(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            plain = "<|" not in text
        except UnicodeEncodeError:
            plain = False
        if plain:
            low = text.lower()
            if self.OTHERWISE.search(low):
                words = self.WORDS.findall(low)
            else:
                words = low.replace(".", " . ").replace(",", " , ").split()
            return b"".join(map(self.words.__getitem__, words))
        # U+0009, U+000A and U+000D are white space to every pattern, as the blank is.
        parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.parts.__getitem__, parts))


_KNOWN: dict[str, WordIds] = {}


def word_ids(file: str) -> WordIds:
    """One for each worker process, as it remembers words."""
    if file not in _KNOWN:
        _KNOWN[file] = WordIds(file)
    return _KNOWN[file]


def segment(shard: int, number: int, first: int, bits: int, doc_ids: list, parts: list[np.ndarray]) -> pa.RecordBatch:
    ids = np.concatenate(parts)
    matrix = Matrix.of(ids, bits)
    columns = [
        pa.array([shard], pa.int32()),
        pa.array([number], pa.int32()),
        pa.array([first], pa.int64()),
        pa.array([len(ids)], pa.int32()),
        pa.array([bits], pa.int32()),
        pa.array([doc_ids], pa.list_(pa.int64())),
        lists(np.array([len(p) for p in parts], np.int32), np.array([len(parts)]), pa.int32()),
        pa.array([matrix.zeros], pa.list_(pa.int32())),
        pa.array([[p.tobytes() for p in matrix.packed]], pa.list_(pa.binary())),
        pa.array([[b.tobytes() for b in matrix.before]], pa.list_(pa.binary())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def write_shards(
    docs: DataFrame,
    file: str,
    path: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_ids: int = SEGMENT_IDS,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode all texts with the tokenizer of `file` and write the shards' files below `path`.

    Rows are dealt by ranges of (doc_id, hash of the text, place in the input), so neither a doc_id nor a text that
    a third of the rows have lands in one shard.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("place"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(-(-size // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = ["doc_id", "mark", "place"]
    rows = rows.repartitionByRange(shards, *key).sortWithinPartitions(*key).select("doc_id", "text")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, known = TaskContext.get().partitionId(), word_ids(file)
        number, first, held, doc_ids, parts = 0, 0, 0, [], []
        end = np.array([end_id], known.kind).tobytes()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.frombuffer((known.of_text(text) if text else b"") + end, known.kind)
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids)
                if held >= segment_ids:
                    yield segment(shard, number, first, known.bits, doc_ids, parts)
                    number, first, held, doc_ids, parts = number + 1, first + held, 0, [], []
        if parts:
            yield segment(shard, number, first, known.bits, doc_ids, parts)

    rows.mapInArrow(task, SCHEMA).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def starts(shards: DataFrame) -> DataFrame:
    """(shard, base): ids in all shards before each; one row for each shard is all that meets in one task."""
    totals = shards.groupBy("shard").agg(F.sum(F.col("n").cast("long")).alias("ids"))
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))


def matrix_of(row: dict) -> Matrix:
    return Matrix(row["n"], row["planes"], row["zeros"], row["ranks"])


def documents_of(shards: DataFrame) -> DataFrame:
    """Out of the files alone: shard, doc_id, start (within the shard), n_tokens, ids_crc32."""
    out = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = matrix_of(row).ids(np.uint16 if row["bits"] <= 16 else np.uint32).astype("<u4")
                view = memoryview(ids).cast("B")
                length = np.array(row["lengths"], np.int64)
                begin = np.cumsum(length) - length
                crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [
                    pa.array([row["shard"]] * len(crc), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(begin + row["first"], pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in out.split(", ")])

    return shards.mapInArrow(task, out)


def count_of(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of a few tokens occurs in the corpus, by rank in each segment."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for b in batches:
            for row in b.to_pylist():
                matrix = matrix_of(row)
                total += [matrix.rank(t, matrix.n) for t in tokens]
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(total)], names=["token", "n"])

    return shards.mapInArrow(task, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences_of(shards: DataFrame, token: int) -> DataFrame:
    """(doc_id, start): the places of a token in its documents, by select in each segment."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                at = matrix_of(row).occurrences(token)
                end = np.cumsum(np.array(row["lengths"], np.int64))
                of = np.searchsorted(end, at, "right")
                begin = end - row["lengths"]
                doc_ids = pa.array(row["doc_ids"], pa.int64()).take(pa.array(of))
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(at - begin[of], pa.int64())], names=["doc_id", "start"])

    return shards.mapInArrow(task, "doc_id long, start long")


def tokens_at(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """(at, token) of the wanted corpus-wide places `at`, by access in the segment that holds each."""
    placed = shards.join(starts(shards), "shard").withColumn("from", F.col("base") + F.col("first"))
    bounds = placed.select("shard", "segment", "from", (F.col("from") + F.col("n")).alias("to"))
    # Each place looks up its segment through buckets of equal width, which a segment lists itself in.
    width = SEGMENT_IDS
    spans = bounds.withColumn("bucket", F.explode(F.expr(f"sequence(`from` div {width}, (`to` - 1) div {width})")))
    found = wanted.select(F.col("at").cast("long").alias("at")).withColumn("bucket", F.expr(f"at div {width}"))
    found = found.join(spans, "bucket").filter("at >= `from` and at < `to`")
    asked = found.groupBy("shard", "segment", "from").agg(F.collect_list(F.col("at") - F.col("from")).alias("places"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                at = np.array(row["places"], np.int64)
                got = matrix_of(row).access(at)
                yield pa.RecordBatch.from_arrays([pa.array(at + row["from"]), pa.array(got)], names=["at", "token"])

    rows = shards.join(asked, ["shard", "segment"]).select("from", "places", "n", "planes", "zeros", "ranks")
    return rows.mapInArrow(task, "at long, token long")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op12_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written in ascending order of doc_id, and what the files say of each document."""
    path = common.new_path(spark, "wavelet")
    write_shards(common.documents(spark, sf_dir), vocabulary(), path)
    shards = read_shards(spark, path)
    # A few numbers of each shard, so the plan may send them to all tasks.
    base = common.stage(starts(shards), "shard-starts")
    found = documents_of(shards).join(base, "shard")
    return found.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
