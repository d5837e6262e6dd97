"""Exact nearest neighbours of a batch of query vectors.

Every task scores the corpus rows it reads against the queries, one matrix
product per Arrow batch, and gives out at most ``k`` rows per query; the final
ranking sees nothing else. Up to ``MAX_QUERIES`` queries travel with the tasks and
the corpus is not shuffled. Larger query sets are split into blocks, and blocks
of queries meet buckets of the corpus in a grid of tasks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sheafline import fixed_values as fv
from sheafline.functions.embedding import Embedder, embed

MAX_QUERIES = 4096
MAX_QUERY_VALUES = 8_000_000
MAX_SCORES = 1_000_000
BUCKET_ROWS = 200_000
MAX_TASKS = 32_000


@dataclass(frozen=True)
class Scoring:
    """``metric`` is ``cosine``, ``dot`` or ``l2`` (negated distance, so that more
    is nearer). Scores are rounded to ``decimals`` before ranking; rows of equal
    score rank by id. A zero vector has cosine 0 with everything."""

    k: int = fv.SEARCH_RESULTS
    metric: str = "cosine"
    decimals: int = 6

    def __post_init__(self):
        if self.metric not in ("cosine", "dot", "l2"):
            raise ValueError(f"unknown metric {self.metric!r}")
        if self.k < 1:
            raise ValueError("k must be positive")

    def scores(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """One row per query, one column per corpus vector."""
        dots = queries @ rows.T
        if self.metric == "dot":
            out = dots
        elif self.metric == "cosine":
            norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None, :]
            out = np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
        else:
            squares = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :] - 2 * dots
            out = -np.sqrt(np.maximum(squares, 0))
        # Products that are too large for a number rank last.
        return np.round(np.where(np.isnan(out), -np.inf, out), self.decimals)

    def best(self, scores: np.ndarray, bar: float = -np.inf) -> np.ndarray:
        """Positions of the ``k`` best scores of at least ``bar``, best first and
        equal ones in their own order. However many rows tie, none is sorted that
        cannot be among the best."""
        found = np.flatnonzero((scores >= bar) & (scores > -np.inf))
        if len(found) > self.k:
            some = scores[found]
            least = np.partition(some, -self.k)[-self.k]
            above = found[some > least]
            ties = found[some == least][: self.k - len(above)]
            found = np.sort(np.concatenate([above, ties]))
        return found[np.argsort(-scores[found], kind="stable")]


class _Best:
    """Running ``k`` best of every query over the batches of a task."""

    def __init__(self, queries: pa.Table, group_column: str | None, scoring: Scoring):
        self.scoring = scoring
        vectors = _matrix(queries["embedding"])
        usable = np.isfinite(vectors).all(axis=1)
        if group_column:
            usable &= _present(queries[group_column])
        self.vectors = vectors[usable]
        self.query_ids = [q for q, ok in zip(queries["query_id"].to_pylist(), usable) if ok]
        self.of_group = _places(_values(queries[group_column])[usable]) if group_column else None
        self.found: list = [None] * len(self.query_ids)
        self.bars = np.full(len(self.query_ids), -np.inf)

    def add(self, batch: pa.RecordBatch, id_column: str, group_column: str | None):
        """Take in corpus rows, so many at a time that the scores stay small."""
        rows = max(1, MAX_SCORES // max(1, len(self.query_ids)))
        for start in range(0, batch.num_rows, rows):
            self._add(batch.slice(start, rows), id_column, group_column)

    def _add(self, batch: pa.RecordBatch, id_column: str, group_column: str | None):
        vectors = _matrix(batch["embedding"])
        # One bad vector leaves itself out, not the rows read with it.
        usable = np.isfinite(vectors).all(axis=1)
        if group_column:
            usable &= _present(batch[group_column])
        usable = np.flatnonzero(usable)
        if not len(usable):
            return
        ids = _values(batch[id_column])[usable]
        by_id = np.argsort(ids, kind="stable")  # so that ties rank by id
        ids, usable = ids[by_id], usable[by_id]
        if self.of_group is None:
            self._rank(np.arange(len(self.query_ids)), ids, vectors[usable])
            return
        # Rows of a group meet the queries of that group, and no others.
        for group, places in _places(_values(batch[group_column])[usable]).items():
            if group in self.of_group:
                self._rank(self.of_group[group], ids[places], vectors[usable[places]])

    def _rank(self, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        scores = self.scoring.scores(rows, self.vectors[queries])
        # Only queries with a row that is as good as their k-th best are looked at.
        for at in np.flatnonzero(scores.max(axis=1) >= self.bars[queries]):
            q = queries[at]
            new = self.scoring.best(scores[at], self.bars[q])
            some_ids, some = ids[new], scores[at][new]
            if self.found[q] is not None:
                some_ids = np.concatenate([self.found[q][0], some_ids])
                some = np.concatenate([self.found[q][1], some])
                together = np.argsort(some_ids, kind="stable")
                keep = together[self.scoring.best(some[together])]
                some_ids, some = some_ids[keep], some[keep]
            self.found[q] = some_ids, some
            if len(some) == self.scoring.k:
                self.bars[q] = some[-1]

    def hits(self, schema: pa.Schema) -> pa.RecordBatch:
        got = [(q, *f) for q, f in zip(self.query_ids, self.found) if f is not None]
        columns = [
            [q for q, ids, _ in got for _ in ids],
            [i for _, ids, _ in got for i in ids.tolist()],
            [v for _, _, scores in got for v in scores.tolist()],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _values(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _places(groups: np.ndarray) -> dict:
    """Where each group stands."""
    names, of = np.unique(groups, return_inverse=True)
    order = np.argsort(of, kind="stable")
    cuts = np.cumsum(np.bincount(of, minlength=len(names)))[:-1]
    return dict(zip(names.tolist(), np.split(order, cuts), strict=True))


def _present(column) -> np.ndarray:
    """Which values are not NULL: as in SQL, NULL is in no group, its own neither."""
    return column.is_valid().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.is_valid().to_numpy()


def _matrix(lists) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def top_k(
    corpus: DataFrame,
    queries: DataFrame,
    scoring: Scoring = Scoring(),
    id_column: str = "chunk_id",
    group_column: str | None = None,
    max_queries: int = MAX_QUERIES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The nearest corpus rows of every query: (query_id, rank, <id>, score).

    ``corpus`` holds the id and ``embedding``, ``queries`` hold query_id and
    ``embedding``. Query vectors of different lengths are an error. Corpus rows of
    another length are left out, and on both sides so are vectors that are NULL or
    hold a number that is NULL, NaN or infinite. With ``group_column`` both hold
    that column too, and a query only sees rows of its own group, NULL being no
    group: the filter comes before the ranking.
    """
    return _search(corpus, queries, scoring, id_column, group_column, max_queries, bucket_rows)[0]


def _search(
    corpus, queries, scoring, id_column, group_column,
    max_queries=MAX_QUERIES, bucket_rows=BUCKET_ROWS,
) -> tuple[DataFrame, bool]:
    """The hits, and whether the queries were few enough to be sent along."""
    extra = [group_column] if group_column else []
    queries = queries.select("query_id", "embedding", *extra).where("embedding IS NOT NULL")
    length = F.size("embedding")
    seen = queries.agg(F.min(length).alias("least"), F.max(length).alias("most"), F.count("*").alias("rows")).first()
    if seen.least != seen.most:
        raise ValueError("query vectors differ in length")
    dimension = seen.most or 0
    few = seen.rows <= min(max_queries, MAX_QUERY_VALUES // max(dimension, 1))
    rows = corpus.select(id_column, "embedding", *extra).where(F.size("embedding") == dimension)
    # Every task gives k rows per query to the final ranking, so that there must
    # not be a task for every split of a very large corpus.
    rows = rows.coalesce(MAX_TASKS)
    kinds, wanted = dict(corpus.dtypes), dict(queries.dtypes)
    hit = f"query_id {wanted['query_id']}, `{id_column}` {kinds[id_column]}, score double"

    if few:
        candidates = _send_queries(rows, queries.toArrow(), scoring, id_column, group_column, hit)
    else:
        block = max(1, min(max_queries, MAX_QUERY_VALUES // max(dimension, 1)))
        candidates = _grid(rows, queries, scoring, id_column, group_column, hit, block, bucket_rows)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(id_column))
    ranked = candidates.withColumn("rank", F.row_number().over(place))
    hits = ranked.where(F.col("rank") <= scoring.k).select("query_id", "rank", id_column, "score")
    return hits, few


def _hit_schema(queries: pa.Schema, rows: pa.Schema, id_column: str) -> pa.Schema:
    return pa.schema(
        [
            pa.field("query_id", queries.field("query_id").type),
            pa.field(id_column, rows.field(id_column).type),
            pa.field("score", pa.float64()),
        ]
    )


def _send_queries(rows, queries: pa.Table, scoring, id_column, group_column, hit) -> DataFrame:
    """The queries, already checked to be few, go along with the tasks."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, schema = _Best(queries, group_column, scoring), None
        for batch in batches:
            schema = schema or _hit_schema(queries.schema, batch.schema, id_column)
            if batch.num_rows and best.query_ids:
                best.add(batch, id_column, group_column)
        if schema is not None:
            yield best.hits(schema)

    return rows.mapInArrow(score, hit)


def _grid(rows, queries, scoring, id_column, group_column, hit, block_queries, bucket_rows) -> DataFrame:
    """Every block of queries meets every bucket of the corpus in one task.

    Blocks and buckets are cut by hashes of ids, so they are even and the same on
    a retry. Inside a task the queries of a cell come first and the corpus rows
    stream past them: only one block of queries is ever held in memory.
    """
    blocks = -(-queries.count() // block_queries)
    buckets = max(1, -(-rows.count() // bucket_rows))
    kinds, wanted = dict(rows.dtypes), dict(queries.dtypes)
    corpus_side = rows.select(
        F.pmod(F.xxhash64(id_column), F.lit(buckets)).cast("int").alias("_bucket"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(wanted["query_id"]).alias("query_id"),
        *rows.columns,
    )
    query_side = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_bucket"),
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("_block"),
        F.lit(0).alias("_side"),
        "query_id",
        F.lit(None).cast(kinds[id_column]).alias(id_column),
        *[c for c in queries.columns if c != "query_id"],
    )
    cell = ["_bucket", "_block", "_side"]
    cells = (
        query_side.unionByName(corpus_side)
        .repartition("_bucket", "_block")
        .sortWithinPartitions(*cell)
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, best, schema = None, [], None, None
        for batch in batches:
            schema = schema or _hit_schema(batch.schema, batch.schema, id_column)
            marks = np.stack([_values(batch[c]) for c in cell])
            edges = np.flatnonzero((np.diff(marks, axis=1) != 0).any(axis=0)) + 1
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                if start == end:
                    continue
                bucket, block, side = marks[:, start]
                if here != (bucket, block):
                    if best is not None:
                        yield best.hits(schema)
                    here, waiting, best = (bucket, block), [], None
                part = batch.slice(start, end - start)
                if side == 0:
                    waiting.append(part)
                elif waiting:
                    best = best or _Best(pa.Table.from_batches(waiting), group_column, scoring)
                    best.add(part, id_column, group_column)
        if best is not None:
            yield best.hits(schema)

    return cells.mapInArrow(score, hit)


def over_fetch(
    corpus: DataFrame,
    queries: DataFrame,
    scoring: Scoring,
    group_column: str,
    times: int = 4,
    id_column: str = "chunk_id",
) -> DataFrame:
    """Fetch ``times`` as many rows without the filter, then keep the best that
    pass it. May give fewer than ``k`` where the filter first would not."""
    wide = Scoring(scoring.k * times, scoring.metric, scoring.decimals)
    hits, few = _search(corpus, queries, wide, id_column, None)
    wanted = queries.select("query_id", group_column)
    passed = attach(hits, corpus, [group_column], id_column, few).join(
        wanted, ["query_id", group_column]
    )
    place = Window.partitionBy("query_id").orderBy("rank")
    ranked = passed.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= scoring.k)
    return ranked.select("query_id", F.col("_place").alias("rank"), id_column, "score")


def attach(
    hits: DataFrame,
    corpus: DataFrame,
    columns: Sequence[str],
    id_column: str = "chunk_id",
    few_hits: bool = False,
) -> DataFrame:
    """Hits with columns of their corpus rows. Texts are read for the hits only,
    never carried through the scoring. ``few_hits`` says that the hits are known
    to be few (k times a checked number of queries): they go to the corpus."""
    return (F.broadcast(hits) if few_hits else hits).join(corpus.select(id_column, *columns), id_column)


def search_texts(
    corpus: DataFrame, texts: DataFrame, embedder: Embedder, scoring: Scoring = Scoring(), **kw
) -> DataFrame:
    """Nearest chunks of query texts (query_id, text, and the group column)."""
    return top_k(corpus, texts.withColumn("embedding", embed(F.col("text"), embedder)), scoring, **kw)


def similarity_search(
    index: DataFrame,
    query_text: str,
    embedder: Embedder,
    columns: Sequence[str],
    num_results: int = fv.SEARCH_RESULTS,
    filters: Mapping[str, str] | None = None,
) -> DataFrame:
    """The nearest index rows of one text, best first, with the columns asked for
    and the score. ``filters`` are metadata fields and the values they must have,
    ``doc_path`` or ``agent_id``; they are applied before the ranking. An index with columns
    of those names (see ``gold.clustered``) is filtered by them, so the scan
    skips what cannot match; in any other one the metadata text is looked into."""
    rows = index
    for name, value in (filters or {}).items():
        held = F.col(name) if name in index.columns else F.get_json_object("metadata", f"$.{name}")
        rows = rows.where(held == value)
    asked = index.sparkSession.createDataFrame([(0, query_text)], "query_id int, text string")
    hits = search_texts(rows, asked, embedder, Scoring(num_results))
    extra = [c for c in columns if c != "chunk_id"]
    found = attach(hits, rows, extra, few_hits=True)
    return found.orderBy("rank").select(*columns, "score")
