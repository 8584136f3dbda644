"""Read queries over the stored tables. Arguments are checked before a plan is built."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.payloads import topic_ids
from tidewire.functions.text import content_preview, display_title, non_empty
from tidewire.functions.times import effective_time
from tidewire.operators.runs import run_rows

# Allowed sources, id pattern and paging bounds of the read API.
SOURCES = frozenset({"bilibili", "xueqiu"})
ENTITY_ID = re.compile(r"^[A-Za-z0-9_.:-]{1,128}$")
MAX_LIMIT = 200
MAX_OFFSET = 10_000


def check_source(source: str | None, allowed: Collection[str] = SOURCES) -> None:
    if source is not None and source not in allowed:
        raise ValueError(f"unknown source: {source}")


def check_entity_id(entity_id: str) -> None:
    if not ENTITY_ID.match(entity_id):
        raise ValueError("invalid entity id")


def valid_entity_id(c: Column) -> Column:
    """The same test on a column; null is not valid."""
    return F.coalesce(c.rlike(rf"\A(?:{ENTITY_ID.pattern.strip('^$')})\z"), F.lit(False))


def valid_source(c: Column, allowed: Collection[str] = SOURCES) -> Column:
    """Whether a source may be asked for; null asks for all."""
    return c.isNull() | c.isin(*sorted(allowed))


def check_page(limit: int, offset: int = 0) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{MAX_LIMIT}")
    if not 0 <= offset <= MAX_OFFSET:
        raise ValueError(f"offset must be within 0..{MAX_OFFSET}")


def by_source(df: DataFrame, source: str | None) -> DataFrame:
    return df if source is None else df.where(F.col("source") == source)


def latest_run(runs: DataFrame) -> DataFrame:
    return run_rows(runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1))


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    check_page(limit)
    return run_rows(runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit))


def recent_errors(
    errors: DataFrame, limit: int = 50, source: str | None = None, allowed: Collection[str] = SOURCES
) -> DataFrame:
    check_page(limit)
    check_source(source, allowed)
    newest = by_source(errors, source).orderBy(F.desc("created_at"), "source", "url", "error_message").limit(limit)
    return newest.select(
        "created_at", *[F.coalesce(c, F.lit("")).alias(c) for c in ("source", "url", "error_message")]
    )


def _order() -> list[Column]:
    return [effective_time(F.col("published_at"), F.col("fetched_at")).desc(), F.col("source_entity_id"), F.col("source")]


def recent_posts(
    posts: DataFrame,
    limit: int = 50,
    offset: int = 0,
    source: str | None = None,
    allowed: Collection[str] = SOURCES,
) -> DataFrame:
    """One listing page. The preview is computed after the limit, on the page's rows only."""
    check_page(limit, offset)
    check_source(source, allowed)
    page = by_source(posts, source).orderBy(*_order()).offset(offset).limit(limit)
    return page.select(
        "source", "source_entity_id", "canonical_url",
        non_empty(F.col("author_entity_id")).alias("author_entity_id"),
        "title",
        content_preview(F.col("content_text")).alias("content_preview"),
        "published_at", "fetched_at", "like_count", "comment_count",
    )


def has_next(posts: DataFrame, limit: int, offset: int = 0, source: str | None = None,
             allowed: Collection[str] = SOURCES) -> DataFrame:
    """One row: shown range and whether the page is full, which is the listing's next flag."""
    size = F.count("*").cast("bigint")
    return recent_posts(posts, limit, offset, source, allowed).agg(
        F.lit(offset + 1).cast("bigint").alias("shown_from"),
        (size + F.lit(offset)).alias("shown_to"),
        (size == limit).alias("has_next"),
    )


def post_cards(posts: DataFrame) -> DataFrame:
    """Display projection: title or preview, effective time, counts with zero for unknown."""
    return posts.select(
        "source", "source_entity_id",
        display_title(F.col("title"), F.col("content_preview")).alias("title"),
        effective_time(F.col("published_at"), F.col("fetched_at")).alias("shown_at"),
        F.coalesce("like_count", F.lit(0)).cast("bigint").alias("likes"),
        F.coalesce("comment_count", F.lit(0)).cast("bigint").alias("replies"),
    )


def get_post(posts: DataFrame, source: str, entity_id: str, allowed: Collection[str] = SOURCES) -> DataFrame:
    check_source(source, allowed)
    check_entity_id(entity_id)
    found = posts.where((F.col("source") == source) & (F.col("source_entity_id") == entity_id)).limit(1)
    topics = F.col("raw_topic_ids")
    if dict(posts.dtypes).get("raw_topic_ids") == "string":
        topics = topic_ids(topics)
    return found.withColumns(
        {
            "content_text": F.coalesce("content_text", F.lit("")),
            "author_entity_id": non_empty(F.col("author_entity_id")),
            "raw_topic_ids": F.coalesce(topics, F.array().cast("array<string>")),
        }
    )


def post_comments(comments: DataFrame, source: str, post_id: str) -> DataFrame:
    """Comments of one post, oldest first."""
    mine = comments.where((F.col("source") == source) & (F.col("post_entity_id") == post_id))
    return mine.orderBy(F.coalesce("published_at", "fetched_at"), "source_entity_id")


def post_detail(
    posts: DataFrame, comments: DataFrame, source: str, entity_id: str, allowed: Collection[str] = SOURCES
) -> tuple[DataFrame, DataFrame]:
    """The post (no row when unknown) and its ordered comments."""
    return get_post(posts, source, entity_id, allowed), post_comments(comments, source, entity_id)


def recent_url_activity(url_state: DataFrame, now: Column) -> DataFrame:
    """Number of URLs fetched within the last hour."""
    recent = F.col("last_fetched_at") >= now - F.expr("interval 1 hour")
    return url_state.agg(F.count_if(recent).cast("bigint").alias("recent_urls"))
