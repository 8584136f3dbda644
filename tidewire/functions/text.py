"""Text projections: whitespace, previews, HTML stripping, numbers, keys."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREVIEW_CHARS = 280

# The code points Python's str.split() treats as whitespace. Java's \s is ASCII-only and the
# Unicode property lacks U+001C..U+001F. The property is one lookup per character, several
# times faster than listing the ranges.
WHITESPACE = r"\p{IsWhite_Space}\x1c-\x1f"

TAG = r"<[^>]+>"


def strip(c: Column) -> Column:
    """Trim Unicode whitespace on both ends. A run is tried at its start only, so time is linear."""
    return F.regexp_replace(c, rf"\A[{WHITESPACE}]+|(?<![{WHITESPACE}])[{WHITESPACE}]+\z", "")


def collapse(c: Column) -> Column:
    """Whitespace runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"[{WHITESPACE}]+", " "))


def is_blank(c: Column) -> Column:
    """Null, empty or whitespace only. Looks for one non-space character, so it stops early."""
    return ~F.coalesce(c.rlike(f"[^{WHITESPACE}]"), F.lit(False))


def content_preview(c: Column, size: int = PREVIEW_CHARS) -> Column:
    flat = collapse(F.coalesce(c, F.lit("")))
    cut = F.concat(F.rtrim(F.substring(flat, 1, size)), F.lit("…"))
    return F.when(F.length(flat) <= size, flat).otherwise(cut)


@F.pandas_udf(T.StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


def strip_html(c: Column) -> Column:
    """Tags to spaces, then entities, then whitespace.

    Spark has no entity decoder, so that one step is an Arrow UDF. Tags are removed before it
    and rows without an ampersand are handed over as null, to keep the transfer small.
    """
    bare = F.regexp_replace(c, TAG, " ")
    has_entity = c.contains("&")
    return collapse(F.when(has_entity, _unescape(F.when(has_entity, bare))).otherwise(bare))


def optional_int(c: Column) -> Column:
    """Integer where the value is one, else null."""
    return c.try_cast("bigint")


def entity_key(source: Column, entity_id: Column) -> Column:
    return F.concat(source, F.lit(":"), entity_id)


def task_key(source: Column, kind: Column, url: Column) -> Column:
    return F.concat(source, F.lit(":"), kind, F.lit(":"), url)


def non_empty(c: Column) -> Column:
    """Empty strings become null."""
    return F.when(c != "", c)


def display_title(title: Column, content: Column) -> Column:
    return F.coalesce(non_empty(title), non_empty(content_preview(content)), F.lit("(untitled)"))
