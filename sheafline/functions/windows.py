"""Cutting a text into windows, with built-in expressions only.

A window starts every ``step`` characters and is ``size`` characters long. One
regex yields them all: the lookahead captures up to ``size`` characters, the
match itself consumes ``step``. It walks the text once, so the cost is linear in
the length of the text; taking a substring per window would walk from the start
of the text each time. Characters are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheafline import fixed_values as fv
from sheafline.settings import ChunkSpec


def has_character(text: Column) -> Column:
    """Is there anything but white space? The first character mostly settles it:
    visible ASCII, or anything beyond the last white space there is (U+3000).
    Only else the regex is asked, which has to convert the text."""
    first = F.ascii(text)
    return first.between(0x21, 0x7E) | (first > 0x3000) | text.rlike(fv.NOT_BLANK)


def texts(text: Column, spec: ChunkSpec) -> Column:
    """The windows as array<string>, blank ones too; empty for NULL."""
    text = F.coalesce(text, F.lit(""))
    if spec.mode == "none":
        return F.array_compact(F.array(F.when(text != "", text)))
    regex = f"(?s)(?=(.{{1,{spec.size}}})).{{1,{spec.step}}}"
    return F.regexp_extract_all(text, F.lit(regex), F.lit(1))


def kept_texts(text: Column, spec: ChunkSpec) -> Column:
    """The windows that are not blank."""
    return F.filter(texts(text, spec), has_character)


def chunks(text: Column, spec: ChunkSpec) -> Column:
    """Windows that are not blank, numbered 0, 1, 2 … without gaps:
    array<struct<chunk_index, chunk_text, start_offset, end_offset>>. NULL and
    blank texts give an empty array; offsets are into the untrimmed text."""
    step = 0 if spec.mode == "none" else spec.step
    placed = F.transform(
        texts(text, spec),
        lambda part, i: F.struct((i * F.lit(step)).alias("start"), part.alias("text")),
    )
    return F.transform(
        F.filter(placed, lambda w: has_character(w["text"])),
        lambda w, i: F.struct(
            i.alias("chunk_index"),
            w["text"].alias("chunk_text"),
            w["start"].alias("start_offset"),
            (w["start"] + F.length(w["text"])).alias("end_offset"),
        ),
    )
