"""Quality classifier: random-indexing word vectors, pooled by document, and a two-layer network.

Random indexing: each token has an index vector of a few signs, drawn from its hash. The
vector of a token is the sum of the index vectors of the tokens around it, over all documents, so tokens
that stand in like places get like vectors. Tokens are hashed to a fixed number of
rows, which bounds the table. A place in a text gives two tokens: the word itself, and its
shape (runs of small letters, capitals, digits, each other sign, and whether the word
repeats the one before it), by which words that were never seen are known too.

A document is the mean of its tokens' vectors (rows scaled to length 1), words and shapes
apart, and the log of its length. A network of one hidden layer, in numpy, is trained on labelled
documents; a temperature, fitted on a part of these that the training leaves
out, makes its probabilities fit.

Nulls and odd input: a null or blank text has no tokens, and the mean is zero; a document
without a label teaches nothing, one with several counts for each; rows that repeat an identifier are scored
each; without labels of both kinds the score is 0.5; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common
from sheafline.llm.words import Words, mix

#: Rows of the table for words and for shapes, numbers in a vector, signs in an index vector, places to each side.
WORD_ROWS, SHAPE_ROWS = 1 << 13, 1 << 11
ROWS = WORD_ROWS + SHAPE_ROWS
DIMENSIONS, SIGNS, AROUND = 32, 4, 2
#: Rows of the table that travel as one.
BLOCK = 1 << 10
#: Labelled documents, about, that the network is trained on at most; chosen by hash of the identifier.
LABELLED = 20_000
HIDDEN, EPOCHS, STEP = 24, 60, 256
#: Documents with this score or a higher one are good.
ACCEPT = 0.3

FEATURES = 2 * DIMENSIONS + 1

# Classes of bytes in a shape: 0 small letter or any byte of a non-ASCII character, 1 capital, 2 digit, else the sign.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[[*range(97, 123), *range(128, 256)]] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each row's index vector."""
    h = mix(np.arange(ROWS * SIGNS, dtype=np.uint64) + np.uint64(12345)).reshape(ROWS, SIGNS)
    return (h % np.uint64(DIMENSIONS)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def tokens(column) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a column, and the table's row of each word and of each word's shape."""
    words = Words(column)
    own = words.hashes(0)
    kind = _CLASS[words.data]
    # A shape is the word with its runs of one class cut to one; hashed as the sum over the runs.
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[words.start] = True
    place = np.cumsum(new)
    value = np.zeros(len(kind) + 1, np.uint64)
    if len(words.start):
        lead = np.repeat(place[words.start], words.end - words.start)
        flat = np.repeat(words.start - np.cumsum(words.end - words.start) + (words.end - words.start),
                         words.end - words.start) + np.arange(int((words.end - words.start).sum()))
        part = mix(kind[flat].astype(np.uint64) * np.uint64(1 << 20) + (place[flat] - lead).astype(np.uint64))
        value[1:][flat] = np.where(new[flat], part, np.uint64(0))
    total = np.cumsum(value)
    shape = total[words.end] - total[words.start]
    again = np.zeros(len(own), bool)
    again[1:] = (own[1:] == own[:-1]) & (words.row[1:] == words.row[:-1])
    shape = mix(shape + again.astype(np.uint64))
    return (
        words,
        (own % np.uint64(WORD_ROWS)).astype(np.int64),
        (shape % np.uint64(SHAPE_ROWS)).astype(np.int64) + WORD_ROWS,
    )


def add_contexts(table: np.ndarray, column) -> None:
    """Add the index vectors of the places around each token of these texts to the token's row."""
    words, word, shape = tokens(column)
    at, sign = index_vectors()
    flat = table.reshape(-1)
    for distance in range(1, AROUND + 1):
        n = len(word) - distance
        if n <= 0:
            continue
        same = words.row[:n] == words.row[distance:]
        for own in (word, shape):
            for other in (word, shape):
                for a, b in ((own[:n][same], other[distance:][same]), (own[distance:][same], other[:n][same])):
                    for k in range(SIGNS):
                        flat += np.bincount(a * DIMENSIONS + at[b, k], sign[b, k], len(flat))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table over all texts. Tasks give it in blocks of rows; blocks are added up in two steps, so that no
    task adds more than a share of them."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.zeros((ROWS, DIMENSIONS))
        for b in batches:
            add_contexts(table, b.column(0))
        share = TaskContext.get().partitionId() % 64
        parts = [table[i : i + BLOCK].astype(np.float64).tobytes() for i in range(0, ROWS, BLOCK)]
        n = len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int32()), pa.array([share] * n, pa.int32()), pa.array(parts, pa.binary())],
            names=["block", "share", "part"],
        )

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for block, share, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                one = np.frombuffer(part, np.float64)
                sums[block, share] = sums[block, share] + one if (block, share) in sums else one
        rows = [(k[0], k[1], v.tobytes()) for k, v in sums.items()]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        kinds = (pa.int32(), pa.int32(), pa.binary())
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["block", "share", "part"])

    kind = "block int, share int, part binary"
    made = docs.select("text").mapInArrow(task, kind)
    made = made.repartition("block", "share").mapInArrow(add, kind)
    made = made.withColumn("share", F.lit(0)).repartition("block").mapInArrow(add, kind)
    table = np.zeros((ROWS, DIMENSIONS))
    for r in made.collect():  # ROWS / BLOCK rows
        table[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.part, np.float64).reshape(-1, DIMENSIONS)
    length = np.sqrt((table**2).sum(axis=1, keepdims=True))
    return (table / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(column, table: np.ndarray) -> np.ndarray:
    """The features of each text."""
    words, word, shape = tokens(column)
    out = np.zeros((words.rows, FEATURES), np.float32)
    n = np.maximum(words.count, 1)[:, None]
    full = np.flatnonzero(words.count)
    for k, rows in enumerate((word, shape)):
        for at in range(0, len(full), 64):
            some = full[at : at + 64]
            lo, hi = words.first[some[0]], words.first[some[-1] + 1]
            sums = np.add.reduceat(table[rows[lo:hi]], words.first[some] - lo, axis=0)
            out[some, k * DIMENSIONS : (k + 1) * DIMENSIONS] = sums
    out[:, : 2 * DIMENSIONS] /= n
    out[:, -1] = np.log1p(words.count) / 10
    return out


class Network:
    """Two layers, tanh between them; inputs are standardised."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, seed: int = 7):
        random = np.random.default_rng(seed)
        self.shift, self.scale = np.zeros(inputs, np.float32), np.ones(inputs, np.float32)
        self.a = (random.normal(size=(inputs, hidden)) / np.sqrt(inputs)).astype(np.float32)
        self.b = np.zeros(hidden, np.float32)
        self.c = (random.normal(size=hidden) / np.sqrt(hidden)).astype(np.float32)
        self.d, self.temperature = np.float32(0), 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.a + self.b) @ self.c + self.d

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30).astype(np.float64)))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """Cross entropy, both labels weighing alike, by Adam."""
        random = np.random.default_rng(seed)
        self.shift, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-4
        x = (x - self.shift) / self.scale
        weight = np.where(y == 1, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean())).astype(np.float32)
        names = ("a", "b", "c", "d")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        t = 0
        for _ in range(epochs):
            order = random.permutation(len(x))
            for at in range(0, len(x), STEP):
                own = order[at : at + STEP]
                h = np.tanh(x[own] @ self.a + self.b)
                p = 1 / (1 + np.exp(-np.clip(h @ self.c + self.d, -30, 30)))
                e = (p - y[own]) * weight[own] / len(own)
                back = e[:, None] * self.c * (1 - h * h)
                grad = {"a": x[own].T @ back + 1e-4 * self.a, "b": back.sum(axis=0), "c": h.T @ e, "d": e.sum()}
                t += 1
                for k in names:
                    m[k] = 0.9 * m[k] + 0.1 * grad[k]
                    v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                    step = 5e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
                    setattr(self, k, (getattr(self, k) - step).astype(np.float32))

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least cross entropy."""
        z = self.logits(x).astype(np.float64)

        def loss(t):
            return np.mean(np.logaddexp(0, z / t) - y * z / t)

        self.temperature = float(min(np.geomspace(0.2, 10, 80), key=loss))


def features_of(docs: DataFrame, table, columns: str) -> DataFrame:
    """`columns` (a name and type each, the text left out) with the features of `text` as `x`."""
    names = [c.split()[0] for c in columns.split(", ")]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pooled(b.column(0), table.value)
            bounds = pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES)
            rows = pa.ListArray.from_arrays(bounds, pa.array(x.reshape(-1), pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], rows], names=[*names, "x"])

    return docs.select("text", *names).mapInArrow(task, f"{columns}, x array<float>")


def fit(labelled: DataFrame, table) -> Network | None:
    """`labelled` has key, text, label; a fifth, by hash of key, is kept for the temperature."""
    made = features_of(labelled, table, "key long, label int").toArrow().combine_chunks()
    y = made.column("label").to_numpy().astype(np.float32)
    if len(np.unique(y)) < 2:
        return None
    x = np.array(made.column("x").combine_chunks().flatten()).reshape(-1, FEATURES)
    key = made.column("key").to_numpy().view(np.uint64)
    order = np.lexsort((key, mix(key)))  # the rows come in any order
    x, y = x[order], y[order]
    held = mix(key[order]) % np.uint64(5) == 0
    network = Network(FEATURES)
    network.train(x[~held], y[~held])
    if held.any():
        network.calibrate(x[held], y[held])
    return network


def score(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row of `docs`; `labelled` has key, text and label, and no more rows than a driver
    can hold the features of."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    table = spark.sparkContext.broadcast(word_vectors(rows))
    network = spark.sparkContext.broadcast(fit(labelled, table))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pooled(b.column(1), table.value)
            found = network.value.scores(x) if network.value else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(task, "doc_id long, score double")


def learning_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, text, label) of about LABELLED labelled documents, less the held-out ones (crc32 of the id mod 5 is 0)."""
    known = labels.filter(common.remainder_of_id(F.col("doc_id"), 5) != 0).filter("quality in (0, 1)")
    known = common.about(known, LABELLED, "doc_id").select("doc_id", F.col("quality").cast("int").alias("label"))
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return found.select(F.col("doc_id").cast("long").alias("key"), "text", "label")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of each document."""
    docs = common.documents(spark, sf_dir)
    found = score(docs, learning_rows(docs, common.read(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        (common.remainder_of_id(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
