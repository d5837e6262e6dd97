"""Benchmark decontamination: rare seeds, then Smith-Waterman alignment.

A seed is a run of `SEED` words of a test item. The corpus is read once to count the texts that hold each
seed. Where a text holds one, the words around it are aligned with the whole item by
Smith-Waterman. The score is the best local alignment's, over that of a perfect copy, so edited,
shortened and padded copies score by what they share with the item.

Rare seeds come first: an item's rarest seeds in a text are aligned before the others, and when they show a whole
copy the others are left alone, as nothing can score higher. Otherwise the common ones follow, so none is left out by
how many texts share it. An alignment matches no more words than the item
and the stretch have in common, so a stretch with too few of the item's words for the threshold isn't aligned.

A stretch reaches as far from its seed as an alignment can that is good enough. With n words in the item, m of them
matched and e other words in between, 2m - e >= 2n * threshold and m <= n leave m + e <= n * (3 - 2 * threshold).

What is found holds a seed. A copy of which no three words in a row are left, every third word replaced, say,
isn't looked at, though it may score the threshold itself.

The test items are the small side: they are read in blocks of at most `BLOCK_ITEMS` and
`BLOCK_WORDS` words, so what is broadcast is bounded, and each block looks at all
texts. Texts are never shuffled.

Words: runs of ASCII letters or digits and of characters beyond ASCII, in lower case, so that
marks and layout don't hide a copy.
Items shorter than a seed are one seed as a whole.

Nulls and odd input: a null text or item has no words and matches nothing; a null
identifier stays null in the result; rows that repeat an identifier give a row each for
what they match; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common
from sheafline.llm.words import MARKS, Words, rolling

SEED = 3
#: Share of a perfect copy's alignment score from which a text counts as contaminated.
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_ITEMS = 10_000
BLOCK_WORDS = 1_000_000

FOUND = "doc_id long, mark long, item_id long, score double, start long, end long"


def words_of(column) -> tuple[Words, np.ndarray]:
    """The words of an Arrow column, in lower case, and a 64-bit hash of each."""
    words = Words(pc.utf8_lower(column), separator=MARKS)
    return words, words.hashes()


def word_ids(text: str | None) -> np.ndarray:
    return words_of(pa.array([text], pa.string()))[1]


class Items:
    """A block of test items: their words, and where each run of words occurs in them."""

    def __init__(self, rows: list[tuple[int, str]], seed: int):
        self.ids = [r[0] for r in rows]
        self.words = [word_ids(r[1]) for r in rows]
        self.seed = seed
        own = [np.unique(rolling(w, min(seed, len(w)))) if len(w) else w for w in self.words]
        self.item = np.repeat(np.arange(len(rows)), [len(x) for x in own])
        self.run = np.concatenate([np.zeros(0, np.uint64), *own])
        order = np.argsort(self.run, kind="stable")
        self.run, self.item = self.run[order], self.item[order]
        self.sizes = sorted({min(seed, len(w)) for w in self.words if len(w)})
        #: The distinct runs, and a table of bits of their hashes that rules nearly all others out at once.
        self.known = np.unique(self.run)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.known & np.uint64(len(self.maybe) - 1)).astype(np.int64)] = True
        self.vocabulary = [np.unique(w, return_counts=True) for w in self.words]

    def shared(self, k: int, text: np.ndarray) -> int:
        """How many words item k and the text have in common, each as often as both have it."""
        known, times = self.vocabulary[k]
        place = np.minimum(np.searchsorted(known, text), len(known) - 1)
        return int(np.minimum(np.bincount(place[known[place] == text], minlength=len(known)), times).sum())

    def hits(self, words: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of a column at which a known run begins, in order, and the runs."""
        at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for size in self.sizes if len(self.known) else []:
            own = rolling(ids, size)
            hit = np.flatnonzero(self.maybe[(own & np.uint64(len(self.maybe) - 1)).astype(np.int64)])
            hit = hit[words.row[hit] == words.row[hit + size - 1]]
            place = np.minimum(np.searchsorted(self.known, own[hit]), len(self.known) - 1)
            hit = hit[self.known[place] == own[hit]]
            at.append(hit)
            found.append(own[hit])
        at, found = np.concatenate(at), np.concatenate(found)
        order = np.argsort(at, kind="stable")
        return at[order], found[order]


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score and the end of it in the text; linear gaps.

    Row by row over the item. The gap along the text is a running maximum: with
    gap cost g, best[j] = max over i <= j of (row[i] + g * (j - i)).
    """
    j = np.arange(len(text) + 1)
    last = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        row = np.zeros(len(text) + 1, np.int64)
        np.maximum(last[:-1] + np.where(text == w, MATCH, MISMATCH), 0, out=row[1:])
        np.maximum(row, last + GAP, out=row)
        row = np.maximum.accumulate(row - GAP * j) + GAP * j
        row[0] = 0
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        last = row
    return best, end


def reach_of(length: int, threshold: float) -> int:
    """Words of a text that an alignment of a high enough score can span."""
    return math.ceil(length * (3 - 2 * threshold))


def stretches(at: np.ndarray, reach: int, total: int) -> list[tuple[int, int]]:
    """Parts of a text around seeds, joined where they meet."""
    out: list[tuple[int, int]] = []
    for p in np.sort(at).tolist():
        lo, hi = max(0, p - reach), min(total, p + reach)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def texts_with(docs: DataFrame, items: Broadcast) -> dict[int, int]:
    """How many texts hold each seed of a block of items: a number for each seed, summed in the tasks first."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value.known
        total = np.zeros(len(known), np.int64)
        for b in batches:
            words, ids = words_of(b.column(1))
            at, found = items.value.hits(words, ids)
            pair = np.unique(np.stack([words.row[at], np.searchsorted(known, found)]), axis=1)
            total += np.bincount(pair[1], minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["seed", "n"])

    counts = docs.mapInArrow(task, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect()
    return {r.seed: r.n for r in counts}


def best_of(target: np.ndarray, ids: np.ndarray, at: np.ndarray, items: Items, k: int, threshold: float) -> tuple[int, int, int]:
    """Score, start (negative) and end of the best alignment around the seeds."""
    best = (0, 0, 0)
    for a, z in stretches(at, reach_of(len(target), threshold), len(ids)):
        if items.shared(k, ids[a:z]) / len(target) < threshold:
            continue
        score, end = smith_waterman(target, ids[a:z])
        best = max(best, (score, -a, a + end))
    return best


def align(docs: DataFrame, items: Broadcast, rarity: Broadcast, threshold: float) -> DataFrame:
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, texts = items.value, rarity.value
        for b in batches:
            out: list[tuple] = []
            rows = list(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True))
            words, every = words_of(b.column(1))
            all_at, all_found = block.hits(words, every)
            bounds = np.searchsorted(words.row[all_at], np.arange(words.rows + 1))
            for r in np.flatnonzero(np.diff(bounds)):
                row, own = rows[r], slice(bounds[r], bounds[r + 1])
                ids = every[words.first[r] : words.first[r + 1]]
                at, found = all_at[own] - words.first[r], all_found[own]
                rare = texts[np.searchsorted(block.known, found)]
                lo = np.searchsorted(block.run, found, "left")
                n = np.searchsorted(block.run, found, "right") - lo
                which = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                item, place, held = block.item[which], np.repeat(at, n), np.repeat(rare, n)
                for k in np.unique(item):
                    target, mine, texts_of = block.words[k], place[item == k], held[item == k]
                    first = texts_of <= np.median(texts_of)
                    best = best_of(target, ids, mine[first], block, k, threshold)
                    if best[0] < MATCH * len(target) and not first.all():
                        best = max(best, best_of(target, ids, mine, block, k, threshold))
                    score = best[0] / (MATCH * len(target))
                    if score >= threshold:
                        out.append((*row, block.ids[k], score, -best[1], best[2]))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                part = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(part, names=[c.split()[0] for c in FOUND.split(", ")])

    return docs.mapInArrow(task, FOUND)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one at a time on the driver."""
    block: list[tuple[int, str]] = []
    words = 0
    rows = items.selectExpr(f"cast(`{id_col}` as bigint) item_id", f"cast(`{text_col}` as string) text")
    for r in rows.toLocalIterator():
        n = len(word_ids(r.text))
        if block and (len(block) >= BLOCK_ITEMS or words + n > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append((r.item_id, r.text))
        words += n
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, mark, item_id, score, start, end) of every text and item that align well enough; mark is a hash of the text, and the
    last two are the words of the text between which the item lies."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = common.marked(docs, id_col, text_col)
    out = None
    for block in item_blocks(items, item_id_col, item_text_col):
        known = Items(block, seed)
        sent = spark.sparkContext.broadcast(known)
        texts = np.zeros(len(known.known), np.int64)
        for i, n in texts_with(rows, sent).items():
            texts[i] = n
        found = align(rows, sent, spark.sparkContext.broadcast(texts), threshold)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], FOUND)


def without_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs` that hold no copy of an item."""
    gone = contaminated(docs, items, id_col=id_col, text_col=text_col, **options)
    return common.without(docs, gone, "contaminated", id_col, text_col)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, with the item and the alignment."""
    return contaminated(common.documents(spark, sf_dir), common.read(spark, sf_dir, "benchmark")).drop("mark")
