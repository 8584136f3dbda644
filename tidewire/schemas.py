"""Explicit schemas of the entity and state tables, and the closed-schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _L, _I, _B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
_TS = T.TimestampType()


def _table(required: dict[str, T.DataType], optional: dict[str, T.DataType] | None = None) -> T.StructType:
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    fields += [T.StructField(n, t, True) for n, t in (optional or {}).items()]
    return T.StructType(fields)


AUTHORS = _table(
    {"source": _S, "source_entity_id": _S},
    {"username": _S, "display_name": _S, "profile_url": _S, "bio": _S, "followers": _L, "following": _L,
     "fetched_at": _TS},
)
POSTS = _table(
    {"source": _S, "source_entity_id": _S},
    {"canonical_url": _S, "author_entity_id": _S, "title": _S, "content_text": _S, "language": _S,
     "published_at": _TS, "fetched_at": _TS, "like_count": _L, "comment_count": _L, "repost_count": _L,
     "raw_topic_ids": T.ArrayType(_S)},
)
COMMENTS = _table(
    {"source": _S, "source_entity_id": _S},
    {"post_entity_id": _S, "canonical_url": _S, "author_entity_id": _S, "parent_comment_entity_id": _S,
     "content_text": _S, "published_at": _TS, "fetched_at": _TS, "like_count": _L},
)
RUN_COUNTERS = (
    "seeds_processed", "tasks_enqueued", "pages_fetched", "posts_written", "comments_written",
    "authors_written", "blocked_responses", "errors", "skipped_tasks",
)
CRAWL_RUNS = _table(
    {"run_id": _S},
    {"started_at": _TS, "finished_at": _TS, "status": _S, **{c: _L for c in RUN_COUNTERS}},
)
CRAWL_ERRORS = _table({}, {"created_at": _TS, "source": _S, "url": _S, "error_message": _S})

URL_STATE = _table(
    {"url": _S},
    {"source": _S, "kind": _S, "seed_name": _S, "first_seen_at": _TS, "last_seen_at": _TS,
     "last_fetched_at": _TS, "last_status": _I},
)
ITEM_STATE = _table(
    {"source": _S, "source_entity_id": _S},
    {"canonical_url": _S, "last_fetched_at": _TS, "last_comment_refresh_at": _TS, "metadata_json": _S},
)
SEED_RUNS = _table(
    {"run_id": _S},
    {"logical_set_name": _S, "generator_name": _S, "started_at": _TS, "finished_at": _TS, "status": _S,
     "item_count": _L, "error_message": _S},
)
SEED_ITEMS = _table(
    {"logical_set_name": _S, "generator_name": _S, "item_kind": _S, "item_value": _S},
    {"first_seen_at": _TS, "last_seen_at": _TS},
)
# One row per chunk of a compiled set; small sets have exactly one chunk.
COMPILED_SEEDS = _table(
    {"seed_set_name": _S, "chunk": _L},
    {"seed_json": _S, "refreshed_at": _TS},
)

# Item kinds of the seed catalog and the array each one fills.
SEED_KINDS = {
    "post_url": "post_urls",
    "bilibili_video_target": "bilibili_video_targets",
    "bilibili_space_url": "bilibili_space_urls",
    "stock_id": "stock_ids",
    "topic_id": "topic_ids",
    "user_id": "user_ids",
}
HOMEPAGE_KIND = "discover_homepage"

SEED_DEFINITION = T.StructType(
    [T.StructField("name", _S), T.StructField("discover_homepage", _B)]
    + [T.StructField(name, T.ArrayType(_S)) for name in SEED_KINDS.values()]
)

FRONTIER = _table(
    {"source": _S, "kind": _S, "url": _S},
    {"seed_name": _S, "priority": _I, "metadata": T.MapType(_S, _S), "seq": _L},
)
# A captured response. `url` is the task's URL; listings and comment threads have several pages
# and sections: `main`, `search` (hits for the owner's name) and `reply` (answers to the comment
# `root_id`, paged on their own). A page may have been captured several times.
RAW_PAGES = _table(
    {"url": _S},
    {"page_no": _I, "section": _S, "root_id": _S, "status_code": _I, "text": _S, "error_message": _S, "proxy_url": _S, "fetched_at": _TS},
)
STOCK_UNIVERSE = _table({"stock_id": _S}, {"market": _S, "board": _S, "tags": T.ArrayType(_S)})
RANKING = _table(
    {"stock_id": _S},
    {"trade_date": T.DateType(), "market": _S, "ranking_mode": _S, "rank": _I},
)

ENTITY_TABLES = {
    "authors": AUTHORS, "posts": POSTS, "comments": COMMENTS,
    "crawl_runs": CRAWL_RUNS, "crawl_errors": CRAWL_ERRORS,
}
STATE_TABLES = {
    "url_state": URL_STATE, "item_state": ITEM_STATE, "generated_seed_runs": SEED_RUNS,
    "generated_seed_items": SEED_ITEMS, "compiled_seed_sets": COMPILED_SEEDS,
}
TABLE_KEYS = {
    "authors": ["source", "source_entity_id"],
    "posts": ["source", "source_entity_id"],
    "comments": ["source", "source_entity_id"],
    "crawl_runs": ["run_id"],
    "crawl_errors": [],
    "url_state": ["url"],
    "item_state": ["source", "source_entity_id"],
    "generated_seed_runs": ["run_id"],
    "generated_seed_items": ["logical_set_name", "generator_name", "item_kind", "item_value"],
    "compiled_seed_sets": ["seed_set_name", "chunk"],
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reject unknown or missing required columns; add absent optional ones as typed nulls."""
    known = set(schema.names)
    extra = [c for c in df.columns if c not in known]
    missing = [f.name for f in schema if not f.nullable and f.name not in df.columns]
    if extra or missing:
        raise ValueError(f"columns do not fit the schema: unknown {extra}, missing {missing}")
    from pyspark.sql import functions as F

    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
