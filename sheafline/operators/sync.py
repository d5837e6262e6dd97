"""Bringing an index table up to date with its source, by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

KEY = "chunk_id"


def latest_per_key(rows: DataFrame, order: Sequence[str], key: str = KEY) -> DataFrame:
    """One row per key, the greatest by ``order`` and then by every other column,
    so that the choice is the same on every run. Copies of a key are reduced
    before the shuffle, however many there are."""
    rest = [c for c in rows.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return rows.groupBy(key).agg(best).select(
        *[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in rows.columns]
    )


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row's values and of which of them are NULL."""
    return F.xxhash64(*columns, *[F.isnull(c) for c in columns])


def index_changes(
    source: DataFrame,
    index: DataFrame,
    columns: Sequence[str],
    order: Sequence[str] = (),
    key: str = KEY,
) -> DataFrame:
    """What makes ``index`` equal ``source`` in ``columns``: (<key>, op, row_hash)
    with op insert, update or delete; unchanged keys do not appear.

    Only keys and row hashes are shuffled, never texts or vectors. Keys must be
    unique in the index. Where they may repeat in the source, ``order`` says which
    row counts: the last one by it."""
    values = [c for c in columns if c != key]
    return changes_to(source, index.select(key, row_hash(values).alias("_old")), columns, order, key)


def changes_to(
    source: DataFrame, held: DataFrame, columns: Sequence[str], order: Sequence[str] = (), key: str = KEY
) -> DataFrame:
    """The same with an index of which keys and row hashes are at hand: ``held`` has <key> and ``_old``."""
    values = [c for c in columns if c != key]
    new = source.select(key, *order, row_hash(values).alias("_new"))
    if order:
        new = latest_per_key(new, order, key).select(key, "_new")
    op = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .otherwise("update")
    )
    return (
        new.join(held, key, "full_outer")
        .where(~F.col("_new").eqNullSafe(F.col("_old")))
        .select(key, op.alias("op"), F.col("_new").alias("row_hash"))
    )


def apply_changes(
    index: DataFrame,
    source: DataFrame,
    changes: DataFrame,
    columns: Sequence[str],
    order: Sequence[str] = (),
    key: str = KEY,
) -> DataFrame:
    """The index after the changes: rows of keys without a change stay, inserted
    and updated ones come from the source, found by key and hash. Applying again
    changes nothing. With changes read from a table, Spark knows their size: a
    small set goes to the rows, and neither index nor source is shuffled."""
    values = [c for c in columns if c != key]
    came = changes.where(F.col("op") != "delete").select(key, "row_hash")
    taken = source.withColumn("row_hash", row_hash(values)).join(came, [key, "row_hash"], "left_semi")
    taken = taken.select(*columns)
    if order:
        taken = taken.dropDuplicates([key])
    kept = index.select(*columns).join(changes.select(key), key, "left_anti")
    return kept.select(*columns).unionByName(taken)


def tally(status: DataFrame, good: Sequence[str], column: str = "status") -> DataFrame:
    """How many entries of a status table are good, are not, and are there."""
    ok = F.coalesce(F.col(column).isin(list(good)), F.lit(False))
    return status.agg(
        F.count_if(ok).alias("success_count"),
        F.count_if(~ok).alias("fail_count"),
        F.count("*").alias("total_count"),
    )
