"""Text normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col

NULL_TEXT = "null"
# Phrases about the layout of a two-image prompt, replaced in this order.
LAYOUT_PHRASES = [
    ("located in the right half of the original frame, ", "located "),
    ("located in the right half of the frame, ", "located "),
    ("located in the right half, ", "located "),
    ("positioned in the right half of the original frame, ", "positioned "),
    ("positioned in the right half of the frame, ", "positioned "),
    ("positioned in the right half, ", "positioned "),
    ("in the right half of the original frame, ", ""),
    ("in the right half of the frame, ", ""),
    ("in the right half, ", ""),
]
#: Sentence that stands in for a null line before it is encoded.
NULL_SENTENCE = "The target person is not visible."


def comma_list(text: Column | str) -> Column:
    """Parts between commas, trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(col(text), ","), lambda x: F.trim(x)), lambda x: x != "")


def line_or_null(line: Column | str) -> Column:
    """The trimmed line; an empty one becomes the null text."""
    line = F.trim(F.coalesce(col(line), F.lit("")))
    return F.when(line == "", NULL_TEXT).otherwise(line)


def is_null_text(line: Column | str) -> Column:
    return F.lower(F.trim(F.coalesce(col(line), F.lit("")))) == NULL_TEXT


def encoded_text(line: Column | str, sentence: str = NULL_SENTENCE) -> Column:
    return F.when(is_null_text(line), F.lit(sentence)).otherwise(F.trim(col(line)))


def squeezed(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(text), r"\s+", " "))


def normalized(text: Column | str, replacements: list[tuple[str, str]] = LAYOUT_PHRASES) -> Column:
    """White space squeezed, then phrases replaced in order; an empty result is the null text."""
    out = squeezed(F.coalesce(col(text), F.lit("")))
    for old, new in replacements:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.when(out == "", NULL_TEXT).otherwise(out)


def html_escaped(text: Column | str) -> Column:
    out = col(text)
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def dash_if_empty(text: Column | str) -> Column:
    return F.when(F.coalesce(col(text), F.lit("")) == "", "-").otherwise(col(text))
