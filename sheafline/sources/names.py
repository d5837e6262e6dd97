"""The tables by the names their users query: a set of views per category over
the partitioned tables, and the shared ones."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

from sheafline import fixed_values as fv
from sheafline.sources import buckets, files, tables
from sheafline.sources.tables import Tables

# Layer -> table of it, schema and suffix of a category's view.
LAYERS = {
    "bronze": ("bronze", "bronze_documents"),
    "silver": ("silver", "silver_documents"),
    "chunks": ("silver", "silver_document_chunks"),
    "gold": ("gold", "gold_document_embeddings"),
}


def publish(
    spark: SparkSession,
    at: Tables,
    categories: list[str],
    slugs: Mapping[str, str] = fv.CATEGORY_SLUGS,
) -> list[str]:
    """Create the views and return their names. A category's view is a pruned
    read of its partition, its comment names the category. Layers without data yet
    are left out. No two categories share a view: see ``view_slugs``."""
    made = []
    named = view_slugs(categories, slugs)
    for schema in ("staging", "bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    shared = {
        "staging.staging_documents": at.ledger,
        "staging.staging_document_versions": tables.snapshot_path(spark, at.versions),
        "gold.gold_embeddings": tables.snapshot_path(spark, at.unified),
    }
    for name, path in shared.items():
        if path and files.exists(spark, path):
            made.append(_view(spark, name, path, "all categories"))
    made += _index_view(spark, "gold.gold_embeddings_index", at.index)
    for layer, (schema, suffix) in LAYERS.items():
        path = getattr(at, layer)
        if not files.exists(spark, path):
            continue
        for category in categories:
            name = f"{schema}.{named[category]}_{suffix}"
            made.append(_view(spark, name, path, f"category {category}", category))
    return made


def _index_view(spark, name: str, root: str) -> list[str]:
    """The index as its last commit left it; later ones show when it is published again."""
    places = buckets.manifest(spark, buckets.Keyed(root, "")).places
    if not places:
        return []
    held = " OR ".join(
        f"(`commit` = {c} AND bucket IN ({', '.join(str(b) for b in sorted(places) if places[b] == c)}))"
        for c in sorted(set(places.values()))
    )
    path = f"{root}/data"
    found = spark.read.parquet(path).schema.names
    columns = ", ".join(f"`{c}`" for c in found if c not in ("commit", "bucket", "row_hash"))
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT 'all categories' AS SELECT {columns} FROM parquet.`{path}` WHERE {held}")
    return [name]


def view_slugs(categories: list[str], slugs: Mapping[str, str] = fv.CATEGORY_SLUGS) -> dict[str, str]:
    """The name of each category's tables. A name that Spark's catalog does not take
    is replaced by the start of its digest, and one that an earlier category has
    already gets that added; so a category's name may depend on the others only
    where both would have the same one."""
    out: dict[str, str] = {}
    for category in sorted(categories, key=lambda c: (c not in slugs, c)):
        slug = slugs.get(category, category.lower())
        digest = hashlib.sha256(category.encode()).hexdigest()[:12]
        if not re.fullmatch(r"\w+", slug, re.ASCII):
            slug = f"category_{digest}"
        out[category] = slug if slug not in out.values() else f"{slug}_{digest}"
    return out


def _view(spark, name: str, path: str, comment: str, category: str | None = None) -> str:
    """A category's view reads its own folders, so nothing depends on how Spark would
    understand the folders' names: 007 and 7 are two categories. Where a category
    has no rows yet the view is empty until it is published again."""
    found = spark.read.parquet(path).schema.names
    columns = ", ".join(f"`{c}`" for c in found if c not in ("category", "batch"))
    rows = f"parquet.`{path}`"
    if category is not None:
        folder = "category=" + spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(category)
        within = [f"{path}/{b}" for b in files.folders(spark, path)] if "batch" in found else [path]
        if any(folder in files.folders(spark, w) for w in within):
            rows = f"parquet.`{files.literal(path)}/{'batch=*/' if 'batch' in found else ''}{files.literal(folder)}`"
        else:
            rows += " WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT {_text(comment)} AS SELECT {columns} FROM {rows}")
    return name


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
