"""Packing of token ids into sequences by Karmarkar-Karp multiway differencing.

Each task reads its documents once, turns them into ids, and packs them in groups, so
nothing is shuffled. A document is cut: whole windows go out by themselves, the rest of it
in pieces of at most an eighth of a window. The pieces of a group are dealt to k windows by
differencing: every piece starts as a partition of k windows, all but one empty; the
two partial partitions with the largest imbalance are merged again and again, the fullest
windows of one with the emptiest of the other, until one partition is left, whose windows
are nearly equal. k is the least number that could do; while a window is over capacity, k
rises by one and the group is dealt again.

Nulls and odd input: a null text is the empty text and has the end id alone; rows that
repeat an identifier are documents of their own; a null identifier stays null; very
long texts are read piece by piece; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sheafline.llm import common

CAPACITY = 1024
#: Windows that the rests of a group of documents make; more of them waste less, and take longer.
GROUP_WINDOWS = 128
#: A rest is cut in pieces of CAPACITY / PARTS.
PARTS = 8
#: Words whose ids a worker remembers.
REMEMBERED = 400_000

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Ids(dict):
    """Ids of a word as bytes (unsigned, little-endian, 32 bits each), remembered."""

    def __init__(self, encode, prefix: str = ""):
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = np.array(self.encode(self.prefix + word), "<u4").tobytes()
        self[word] = ids
        return ids


class Encoder:
    """Byte-level BPE of `ranks` (a file of base64 tokens and their ids), exactly as on the whole text.

    `added` are tokens with ids of their own that texts may hold: a text is cut at them, and each part
    between is encoded by itself.

    The vocabulary's pattern starts a new part at a blank that follows anything but white space,
    so a text without two white-space characters in a row is encoded word by word.
    """

    DOUBLE = re.compile(r"\s\s")
    #: Texts above this are encoded in steps, so that their words are never all in memory as objects.
    STEP = 1 << 20

    def __init__(self, ranks: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={}
        ).encode_ordinary
        self.first, self.later = Ids(self.encode), Ids(self.encode, " ")
        self.added = {token: np.array([i], "<u4").tobytes() for token, i in added}
        # Of tokens that begin alike, the longest.
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None

    def _steps(self, text: str) -> Iterator[str]:
        """Parts that begin at a blank between two other characters: the pattern never crosses that."""
        at = 0
        while len(text) - at > self.STEP:
            cut = at + self.STEP
            while True:
                cut = text.find(" ", cut)
                if cut < 0 or not (text[cut - 1].isspace() or text[cut + 1 : cut + 2].isspace()):
                    break
                cut += 1
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:] if at else text

    def __call__(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        return b"".join(self.added.get(part) or self._plain(part) for part in self.cut.split(text) if part)

    def _plain(self, text: str) -> bytes:
        out = []
        for part in self._steps(text):
            if self.DOUBLE.search(part):
                out.append(np.array(self.encode(part), "<u4").tobytes())
                continue
            words = part.split(" ")
            out.append(self.first[words[0]] if words[0] else b"")
            out.append(b"".join(map(self.later.__getitem__, words[1:])))
        return b"".join(out)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(ranks: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> Encoder:
    """One for each worker process, as it remembers words."""
    if (ranks, pattern, added) not in _ENCODERS:
        _ENCODERS[ranks, pattern, added] = Encoder(ranks, pattern, added)
    return _ENCODERS[ranks, pattern, added]


def differencing(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Indexes of `sizes` dealt to k windows of nearly equal sums.

    A partial partition is its windows' sums, in falling order and less the smallest, with the
    pieces of each. Only the windows that hold something are kept, as the others are zero.
    """
    heap = []
    for i, size in enumerate(sizes.tolist()):
        heapq.heappush(heap, (-size, i, [size], [[i]]))
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, of_a = heapq.heappop(heap)
        _, _, b, of_b = heapq.heappop(heap)
        # Opposing imbalances: the j-th fullest window of one goes with the j-th emptiest of the other.
        free = k - len(a)
        if len(b) <= free:
            sums, parts = a + b, of_a + of_b
        else:
            meet = len(b) - free  # windows where both have something: the least of each
            sums = a[: len(a) - meet] + b[: len(b) - meet]
            parts = of_a[: len(a) - meet] + of_b[: len(b) - meet]
            for j in range(meet):
                x, y = len(a) - meet + j, len(b) - 1 - j
                sums.append(a[x] + b[y])
                parts.append(of_a[x] + of_b[y])
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        least = sums[order[-1]] if len(sums) == k else 0
        sums, parts = [sums[j] - least for j in order], [parts[j] for j in order]
        heapq.heappush(heap, (-sums[0], serial, sums, parts))
        serial += 1
    parts = heap[0][3] if heap else []
    return parts + [[] for _ in range(k - len(parts))]


def deal(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`: the least number, raised by one while differencing overfills one."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        windows = differencing(sizes, k)
        if all(int(sizes[w].sum()) <= capacity for w in windows if w):
            return [w for w in windows if w]
        k += 1


class Packer:
    """Takes documents' ids, gives pieces with their place; numbers sequences from `base` on."""

    def __init__(self, capacity: int, group_windows: int, base: int):
        self.capacity, self.most, self.next = capacity, capacity * group_windows, base
        self.rests: list[tuple] = []
        self.held = 0

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        n, cap = len(ids) // 4, self.capacity
        view = memoryview(ids)
        whole = n // cap * cap
        for at in range(0, whole, cap):
            yield doc_id, at, cap, zlib.crc32(view[4 * at : 4 * (at + cap)]), n, self.next, 0
            self.next += 1
        step = max(1, cap // PARTS)
        for at in range(whole, n, step):
            length = min(step, n - at)
            self.rests.append((doc_id, at, length, zlib.crc32(view[4 * at : 4 * (at + length)]), n))
        self.held += n - whole
        if self.held >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if not self.rests:
            return
        sizes = np.array([r[2] for r in self.rests], np.int64)
        for window in deal(sizes, self.capacity):
            offset = 0
            for i in sorted(window):
                yield (*self.rests[i], self.next, offset)
                offset += self.rests[i][2]
            self.next += 1
        self.rests, self.held = [], 0


def pack(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    added: tuple[tuple[str, int], ...] = (),
    end_id: int = 0,
    capacity: int = CAPACITY,
    group_windows: int = GROUP_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A sequence's id is the number of its task, times 2^40, and its number in that task.
    """
    common.small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    kind = pa.schema([(name, pa.int64()) for name in (c.split()[0] for c in SCHEMA.split(", "))])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(ranks, pattern, added)
        packer = Packer(capacity, group_windows, TaskContext.get().partitionId() << 40)

        def batch(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=kind)

        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows.extend(packer.add(doc_id, (encode(text) if text else b"") + end))
            if rows:
                yield batch(rows)
        if rows := list(packer.flush()):
            yield batch(rows)

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    return rows.mapInArrow(task, SCHEMA)


def vocabulary() -> tuple[str, str, tuple[tuple[str, int], ...]]:
    """The 50k byte-level vocabulary of the public tokenizers, as ranks, its pattern, and its added tokens, which the
    ranks lack."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 ids."""
    return pack(common.documents(spark, sf_dir), *vocabulary())
