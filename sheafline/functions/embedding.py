"""Batched embedding: the one place where rows go to Python.

An embedder is any picklable callable taking a list of texts and returning one
vector per text. A remote service, a local model or the deterministic stand-in
below all fit.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, FloatType

from sheafline import fixed_values as fv

log = logging.getLogger(__name__)

Embedder = Callable[[list], Sequence]


class CharacterCounts:
    """Stand-in embedder: how often each code point, modulo the dimension,
    occurs. Needs no network or model and counts exactly."""

    def __init__(self, dimension: int = 64):
        self.dimension = dimension

    def __call__(self, texts: list) -> np.ndarray:
        codes = [np.frombuffer(t.encode("utf-32-le"), dtype="<u4") for t in texts]
        row = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
        if not len(row):
            return np.zeros((len(texts), self.dimension), dtype=np.float32)
        cell = row * self.dimension + np.concatenate(codes) % self.dimension
        counts = np.bincount(cell, minlength=len(texts) * self.dimension)
        return counts.reshape(len(texts), self.dimension).astype(np.float32)


def _vectors(embedder: Embedder, texts: list) -> list:
    """Vectors of one sub-batch; all None if the call fails or its reply does
    not hold one vector per text. Why goes to the worker's log."""
    try:
        reply = list(embedder(texts))
        if len(reply) == len(texts):
            return [None if v is None else np.asarray(v, dtype=np.float32).ravel() for v in reply]
        log.warning("no vectors for %d texts: the reply holds %d", len(texts), len(reply))
    except Exception as e:
        log.warning("no vectors for %d texts: %s: %s", len(texts), type(e).__name__, e)
    return [None] * len(texts)


def _halved(embedder: Embedder, texts: list) -> list:
    """As ``_vectors``, but a failed sub-batch is cut in two until what fails is alone."""
    vectors = _vectors(embedder, texts)
    if len(texts) < 2 or any(v is not None for v in vectors):
        return vectors
    half = len(texts) // 2
    return _halved(embedder, texts[:half]) + _halved(embedder, texts[half:])


def _as_lists(vectors: list) -> pa.Array:
    sizes = [0 if v is None else len(v) for v in vectors]
    flat = [v for v in vectors if v is not None]
    values = np.concatenate(flat) if flat else np.empty(0, dtype=np.float32)
    missing = np.array([v is None for v in vectors], dtype=bool)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
        pa.array(values),
        mask=pa.array(missing),
    )


def embed(text: Column, embedder: Embedder, batch: int = fv.EMBED_BATCH, halve: bool = False) -> Column:
    """Vectors of a text column as array<float>. Arrow batches are passed on in
    sub-batches of ``batch`` texts, NULL as ''; a sub-batch whose call fails
    becomes NULLs, or with ``halve`` only the texts that fail by themselves. Marked nondeterministic, so that the optimizer does not copy
    the call into two places of the plan."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            # A sub-batch at a time is taken out of Arrow, and its vectors go back to it: one at least, for no texts.
            made = []
            for at in range(0, max(1, len(texts)), batch):
                part = [t or "" for t in texts.slice(at, batch).to_pylist()]
                made.append(_as_lists((_halved if halve else _vectors)(embedder, part)))
            yield pa.concat_arrays(made) if len(made) > 1 else made[0]

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, ArrayType(FloatType()))
    return udf.asNondeterministic()(text)
