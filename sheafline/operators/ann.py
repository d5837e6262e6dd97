"""Approximate nearest neighbours by an inverted file.

Vectors are dealt to cells by the nearest of a few centres, and the index is a table
partitioned by cell. A query reads the cells whose centres are nearest to it and
ranks what lies there exactly, so a search reads a small share of the index. All rows
are in the index, also those without a usable vector, which are in no query's cells.
The exact way is ``search.top_k`` over the same table; a search that probes all cells
equals it.

Centres are learned on a bounded sample (``Cells.sample_rows``), by hash of the id, so it is
the same at every run; everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from sheafline.operators import search
from sheafline.operators.search import Scoring

#: Rows without a usable vector.
NO_CELL = -1
#: Rows of a cell that one task writes, about; a cell with much of the table has many files.
CELL_FILE_ROWS = 500_000


@dataclass(frozen=True)
class Cells:
    """How many cells there are, how many a query probes, and how many rows the centres are
    learned on at most. About as many cells as the root of the rows make both steps alike."""

    cells: int = 64
    probes: int = 8
    sample_rows: int = 100_000
    rounds: int = 12
    seed: int = 7

    def __post_init__(self):
        if not 1 <= self.probes <= self.cells:
            raise ValueError("probes must be from 1 to the number of cells")


def _usable(dimension: int):
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.size("embedding") == dimension) & ~bad


def train(corpus: DataFrame, dimension: int, cells: Cells = Cells(), id_column: str = "chunk_id") -> np.ndarray:
    """The centres, one row each, of unit length. Their number times the dimension is all that the
    driver holds. With fewer usable vectors than cells there are fewer centres, and never none."""
    rows = corpus.where(_usable(dimension)).select(id_column, "embedding")
    rows = rows.where(F.exists("embedding", lambda x: x != 0))  # a zero vector has no direction
    n = rows.count()
    if n < 2 or cells.cells == 1:
        return np.ones((1, dimension)) / np.sqrt(dimension)
    if n > cells.sample_rows:
        share = int(cells.sample_rows / n * 1_000_003)
        rows = rows.where(F.pmod(F.xxhash64(id_column), F.lit(1_000_003)) < share)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    unit = F.transform("embedding", lambda x: x / norm)
    sample = rows.select(array_to_vector(unit).alias("features"))
    means = KMeans(k=min(cells.cells, n), maxIter=cells.rounds, seed=cells.seed)
    out = np.array(means.fit(sample).clusterCenters())
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=out, where=length > 0)


def nearest(vectors: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` cells nearest to each vector by angle, nearest first."""
    return np.argsort(-(vectors @ centres.T), axis=1, kind="stable")[:, :n]


def with_cells(rows: DataFrame, centres: np.ndarray, n: int = 1) -> DataFrame:
    """The rows with their ``cell``; for queries ``n`` rows each, one for every cell they probe, nearest first."""
    dimension = centres.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["embedding"]
            fits = np.array([v is not None and len(v) == dimension for v in vectors.to_pylist()], bool)
            matrix = search._matrix(vectors.filter(pa.array(fits))).reshape(-1, dimension)
            good = np.isfinite(matrix).all(axis=1)
            place = np.flatnonzero(fits)[good]
            cell = np.full((batch.num_rows, n), NO_CELL, np.int32)
            found = nearest(matrix[good], centres, n)
            cell[place, : found.shape[1]] = found
            row, slot = np.nonzero(np.concatenate([np.ones((batch.num_rows, 1), bool), cell[:, 1:] != NO_CELL], axis=1))
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell[row, slot])], names=[*batch.schema.names, "cell"]
            )

    schema = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    return rows.mapInArrow(assign, f"{schema}, cell int")


def write_index(corpus: DataFrame, centres: np.ndarray, path: str, id_column: str = "chunk_id") -> None:
    """All rows as a table partitioned by cell. Large cells are dealt to several tasks, by hash of the id."""
    rows = with_cells(corpus, centres)
    n = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = F.pmod(F.xxhash64(id_column), F.lit(max(1, int(n) // max(1, len(centres)))))
    rows.repartition("cell", spread).write.option("maxRecordsPerFile", CELL_FILE_ROWS).partitionBy("cell").parquet(path)


def top_k(
    index: DataFrame,
    queries: DataFrame,
    centres: np.ndarray,
    probes: int = Cells.probes,
    scoring: Scoring = Scoring(),
    id_column: str = "chunk_id",
) -> DataFrame:
    """About the nearest index rows of every query: (query_id, rank, <id>, score), as ``search.top_k`` gives
    them. Cells that no query probes are not read: their numbers, at most as many as there are centres, are a
    filter on the partitions."""
    asked = with_cells(queries.select("query_id", "embedding"), centres, min(probes, len(centres)))
    asked = asked.where(F.col("cell") != NO_CELL)
    wanted = sorted(r.cell for r in asked.select("cell").distinct().collect())
    rows = index.where(F.col("cell").isin(wanted)) if wanted else index.where("cell is null")
    return search.top_k(rows, asked, scoring, id_column, group_column="cell")


def probes_for(
    index: DataFrame,
    queries: DataFrame,
    centres: np.ndarray,
    recall: float = 0.95,
    scoring: Scoring = Scoring(),
    id_column: str = "chunk_id",
) -> int:
    """The least number of cells to probe by which at least ``recall`` of the exact neighbours of these
    queries are found. The neighbours come from the exact search; each counts at the
    rank that its cell has among its query's cells, so only a number for each rank comes back."""
    exact = search.top_k(index, queries, scoring, id_column).select("query_id", id_column)
    held = exact.join(index.select(id_column, F.col("cell").alias("held")), id_column)
    order = with_cells(queries.select("query_id", "embedding"), centres, len(centres))
    ranked = order.groupBy("query_id").agg(F.collect_list("cell").alias("cells"))
    rank = F.array_position("cells", F.col("held"))
    found = {r.rank: r.n for r in held.join(ranked, "query_id").groupBy(rank.alias("rank")).agg(F.count("*").alias("n")).collect()}
    total, seen = sum(found.values()), 0
    for probes in range(1, len(centres) + 1):
        seen += found.get(probes, 0)
        if seen >= recall * total:
            return probes
    return len(centres)
