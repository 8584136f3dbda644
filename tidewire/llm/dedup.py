"""Exact dedup by content-defined chunk recipes.

A normalised text is cut where its content says so, not at fixed offsets: after 256 characters at
the next blank whose neighbours fall in fixed letter classes, or at 2048. Equal stretches give
equal chunks whatever stands before them, so the distinct chunks are far fewer than the texts.
They are moved once, combined before the shuffle, to verify that a 128-bit identifier (two 64-bit
hashes) stands for one text only. That holds for any corpus that was not made to break it (3e11
chunks collide with a chance of 1e-16); if two texts share one, SHA-256 takes the hashes' place.
After that a document is the ordered list of its chunk identifiers, about 1.6 % of its length, and
documents are equal exactly when their lists are. Long texts are not moved again.

Nulls: a null text is the empty one; a null id loses against any other, and stays if all are null.
Repeated rows of the id that stays are all marked kept; `deduplicated` returns one of them. An
empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import WHITE, cut_lineage, one_of_each

MIN_CHUNK, MAX_CHUNK = 256, 2048
_CUT = "(?<=[aeghkpsyäéñ0-4.]) (?=[abfhlnostuzéA-M0-4])"
_CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:{_CUT}|\z)|.{{1,{MAX_CHUNK}}}"


def normalised(text: Column) -> Column:
    """Runs of white space become one space. Single spaces stay, so only other runs are matched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{WHITE}]{{2,}}|[\x09-\x0D]", " ")


def chunks(normal: Column) -> Column:
    return F.regexp_extract_all(normal, F.lit(_CHUNK), F.lit(0))


def short_identifier(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk).alias("b"))


def long_identifier(chunk: Column) -> Column:
    return F.sha2(chunk.cast("binary"), 256)


def verified_identifier(docs: DataFrame, text: str = "text") -> Callable[[Column], Column]:
    """The short identifier if each one stands for one chunk text of `docs`, else the long one."""
    pieces = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
    shared = pieces.distinct().groupBy(short_identifier(F.col("chunk")).alias("id")).count().where("count > 1")
    return short_identifier if shared.isEmpty() else long_identifier


def recipes(docs: DataFrame, identifier: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text_sha256 and the ordered identifiers of its chunks."""
    normal = docs.select("doc_id", normalised(F.col("text")).alias("_text"))
    return normal.select(
        "doc_id", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"),
        F.transform(chunks(F.col("_text")), identifier).alias("recipe"),
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document."""
    rows = cut_lineage(recipes(docs, verified_identifier(docs)))
    groups = rows.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # The documents stand on the left, so a recipe with very many of them can be split.
    return rows.join(groups, "recipe").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows that stay, in the columns of `docs`; of repeated rows one."""
    kept = exact_groups(docs).where("kept").select("doc_id", F.col("text_sha256").alias("mark"))
    return one_of_each(docs, kept, F.sha2(normalised(F.col("text")).cast("binary"), 256))
