"""Reading parsed documents held as VARIANT:
``{"document": {"elements": [{type, page, content, description}], "pages": […]},
"error_status": …}``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheafline.functions.text import has_text

_VARIANTS = "array<variant>"


def _array(parsed: Column, path: str) -> Column:
    return F.try_variant_get(parsed, path, _VARIANTS)


def elements(parsed: Column) -> Column:
    return _array(parsed, "$.document.elements")


def field(element: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(element, f"$.{name}", kind)


def _paragraphs(items: Column) -> Column:
    return F.array_join(items, "\n\n")


def element_text(parsed: Column) -> Column:
    """Contents of everything but figures, as paragraphs."""
    kept = F.filter(
        elements(parsed),
        lambda e: (field(e, "type") != "figure") & has_text(field(e, "content")),
    )
    return F.coalesce(_paragraphs(F.transform(kept, lambda e: field(e, "content"))), F.lit(""))


def figure_text(parsed: Column) -> Column:
    """What figures show: description, else content."""
    kept = F.filter(
        elements(parsed),
        lambda e: (field(e, "type") == "figure")
        & (has_text(field(e, "description")) | has_text(field(e, "content"))),
    )
    said = F.transform(kept, lambda e: F.coalesce(field(e, "description"), field(e, "content")))
    return F.coalesce(_paragraphs(said), F.lit(""))


def page_count(parsed: Column) -> Column:
    return F.size(_array(parsed, "$.document.pages"))


def error_status(parsed: Column) -> Column:
    return field(parsed, "error_status")
