"""Text cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from sheafline import fixed_values as fv


def decode(content: Column, repair: bool = False) -> Column:
    """Bytes to text. ``repair`` replaces invalid UTF-8 instead of keeping it."""
    text = content.cast("string")
    return F.make_valid_utf8(text) if repair else text


def tidy(text: Column) -> Column:
    """Runs of 3+ newlines become 2, then spaces (only spaces) are trimmed. The
    plain search in front spares most texts the regex."""
    runs = F.contains(text, F.lit("\n\n\n"))
    return F.trim(F.when(runs, F.regexp_replace(text, fv.BLANK_LINES, "\n\n")).otherwise(text))


def has_text(text: Column) -> Column:
    """Not NULL and more than spaces."""
    return text.isNotNull() & (F.trim(text) != "")


_TABLE_STEPS = (
    (fv.ROW_END, "\n"),
    (fv.CELL_END, " | "),
    (fv.ANY_TAG, ""),
    (fv.TRAILING_BAR, ""),
)


def _strip_tables(text: Column) -> Column:
    return reduce(lambda t, s: F.regexp_replace(t, *s), _TABLE_STEPS, text)


def html_element(text: Column) -> Column:
    """HTML tables of one element as lines of ``a | b``."""
    return F.trim(_strip_tables(text))


def html_document(text: Column) -> Column:
    """Same for a whole document, which also gets its blank lines collapsed."""
    return tidy(_strip_tables(text))


def preview(text: Column, chars: int = fv.PREVIEW_CHARS) -> Column:
    return F.substring(text, 1, chars)
