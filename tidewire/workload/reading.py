"""Read queries, threads and the SQL surface over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.payloads import topic_ids
from tidewire.operators import readers, runs, threads
from tidewire.plans import dashboard, sqlsurface
from tidewire.workload import views as V
from tidewire.workload.registry import Tables, query

# RE2 class equal to the whitespace the preview collapses.
_WS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _flat(column: str) -> str:
    return f"trim(regexp_replace({column}, '{_WS}', ' ', 'g'))"


def _preview(column: str) -> str:
    flat = _flat(column)
    return f"CASE WHEN length({flat}) <= 280 THEN {flat} ELSE rtrim(substring({flat}, 1, 280)) || '…' END"


_POST_COLUMNS = f"""source, source_entity_id, canonical_url, nullif(author_entity_id, '') AS author_entity_id, title,
  {_preview('content_text')} AS content_preview, published_at, fetched_at, like_count, comment_count"""
_POST_ORDER = "ORDER BY coalesce(published_at, fetched_at) DESC, source_entity_id, source"


@query("recent_posts", f"WITH p AS ({V.POSTS_SQL}) SELECT {_POST_COLUMNS} FROM p {_POST_ORDER} LIMIT 50 OFFSET 100")
def recent_posts(t: Tables) -> DataFrame:
    return readers.recent_posts(V.posts(t), limit=50, offset=100)


@query(
    "recent_posts_by_source",
    f"""WITH p AS ({V.POSTS_SQL}), page AS (
SELECT * FROM p WHERE source = '1-URGENT' {_POST_ORDER} LIMIT 200)
SELECT source, source_entity_id, coalesce(nullif(title, ''), nullif({_preview('content_text')}, ''), '(untitled)') AS title,
  coalesce(published_at, fetched_at) AS shown_at, coalesce(like_count, 0) AS likes, coalesce(comment_count, 0) AS replies
FROM page""",
)
def recent_posts_by_source(t: Tables) -> DataFrame:
    page = readers.recent_posts(V.posts(t), limit=200, source="1-URGENT", allowed=V.PRIORITIES)
    return readers.post_cards(page)


@query(
    "listing_has_next",
    f"""WITH p AS ({V.POSTS_SQL}), page AS (SELECT * FROM p WHERE source = '5-LOW' LIMIT 200 OFFSET 1000)
SELECT 1001 AS shown_from, 1000 + count(*) AS shown_to, count(*) = 200 AS has_next FROM page""",
)
def listing_has_next(t: Tables) -> DataFrame:
    return readers.has_next(V.posts(t), limit=200, offset=1000, source="5-LOW", allowed=V.PRIORITIES)


@query(
    "content_preview",
    f"""SELECT doc_id, {_preview('text')} AS preview, length({_preview('text')}) AS preview_chars FROM documents""",
)
def content_preview(t: Tables) -> DataFrame:
    shown = t.documents.select("doc_id", text.content_preview(F.col("text")).alias("preview"))
    return shown.withColumn("preview_chars", F.length("preview").cast("bigint"))


_RUN_COLUMNS = """run_id, started_at, finished_at, coalesce(status, '') AS status,
  coalesce(seeds_processed, 0) AS seeds_processed, coalesce(tasks_enqueued, 0) AS tasks_enqueued,
  coalesce(pages_fetched, 0) AS pages_fetched, coalesce(posts_written, 0) AS posts_written,
  coalesce(comments_written, 0) AS comments_written, coalesce(authors_written, 0) AS authors_written,
  coalesce(blocked_responses, 0) AS blocked_responses, coalesce(errors, 0) AS errors,
  coalesce(skipped_tasks, 0) AS skipped_tasks"""


@query("latest_run", f"WITH r AS ({V.RUNS_SQL}) SELECT {_RUN_COLUMNS} FROM r ORDER BY started_at DESC LIMIT 1")
def latest_run(t: Tables) -> DataFrame:
    return readers.latest_run(V.runs(t))


@query("recent_runs", f"WITH r AS ({V.RUNS_SQL}) SELECT {_RUN_COLUMNS} FROM r ORDER BY started_at DESC LIMIT 20")
def recent_runs(t: Tables) -> DataFrame:
    return readers.recent_runs(V.runs(t), limit=20)


@query(
    "run_durations",
    f"""WITH r AS ({V.RUNS_SQL}), d AS (SELECT run_id, date_sub('millisecond', started_at, finished_at) AS ms FROM r)
SELECT run_id, ms AS duration_ms, CASE WHEN ms IS NULL THEN '—' WHEN ms < 1000 THEN ms || ' ms'
  WHEN ms < 60000 THEN ((ms + 50) // 100) // 10 || '.' || ((ms + 50) // 100) % 10 || ' s'
  ELSE ((ms + 3000) // 6000) // 10 || '.' || ((ms + 3000) // 6000) % 10 || ' m' END AS duration
FROM d""",
)
def run_durations(t: Tables) -> DataFrame:
    return runs.with_duration(V.runs(t)).select("run_id", "duration_ms", "duration")


@query(
    "recent_errors",
    f"""WITH e AS ({V.ERRORS_SQL}) SELECT created_at, source, url, coalesce(error_message, '') AS error_message
FROM e WHERE source = 'bilibili' ORDER BY created_at DESC, source, url, error_message LIMIT 50""",
)
def recent_errors(t: Tables) -> DataFrame:
    return readers.recent_errors(V.errors(t), limit=50, source="bilibili")


@query(
    "post_detail",
    f"""WITH p AS ({V.DOC_POSTS_SQL}), c AS ({V.COMMENTS_SQL})
SELECT p.source_entity_id AS post_id, p.title, p.language, p.author_entity_id AS author, c.source_entity_id AS comment_id,
  c.author_entity_id AS comment_author, coalesce(c.published_at, c.fetched_at) AS comment_time
FROM p LEFT JOIN c ON c.source = p.source AND c.post_entity_id = p.source_entity_id
WHERE p.source = 'xueqiu' AND p.source_entity_id = '7'""",
)
def post_detail(t: Tables) -> DataFrame:
    posts = V.doc_posts(t).withColumn("raw_topic_ids", F.lit('["a"]'))
    post, comments = readers.post_detail(posts, V.comments(t), "xueqiu", "7")
    head = post.select(
        "source",
        F.col("source_entity_id").alias("post_id"),
        "title",
        "language",
        F.col("author_entity_id").alias("author"),
    )
    body = comments.select(
        "source",
        F.col("post_entity_id").alias("post_id"),
        F.col("source_entity_id").alias("comment_id"),
        F.col("author_entity_id").alias("comment_author"),
        F.coalesce("published_at", "fetched_at").alias("comment_time"),
    )
    return head.join(body, ["source", "post_id"], "left").drop("source")


@query(
    "post_comments",
    f"""WITH p AS ({V.DOC_POSTS_SQL}), c AS ({V.COMMENTS_SQL})
SELECT p.source, p.source_entity_id AS post_entity_id, p.title AS post_title, c.source_entity_id AS comment_id,
  c.author_entity_id AS comment_author, coalesce(c.published_at, c.fetched_at) AS comment_time, c.content_text AS comment_text
FROM p LEFT JOIN c ON c.source = p.source AND c.post_entity_id = p.source_entity_id""",
)
def post_comments(t: Tables) -> DataFrame:
    return threads.with_comments(V.doc_posts(t), V.comments(t))


@query(
    "owner_comments",
    f"""WITH p AS ({V.DOC_POSTS_SQL}), c AS ({V.COMMENTS_SQL})
SELECT c.source, c.post_entity_id, c.source_entity_id, c.author_entity_id
FROM c LEFT JOIN p ON p.source = c.source AND p.source_entity_id = c.post_entity_id
WHERE p.author_entity_id IS NULL OR p.author_entity_id = c.author_entity_id""",
)
def owner_comments(t: Tables) -> DataFrame:
    kept = threads.owner_comments(V.comments(t), V.doc_posts(t), source="xueqiu")
    return kept.select("source", "post_entity_id", "source_entity_id", "author_entity_id")


_TREE_SQL = f"""WITH RECURSIVE c AS ({V.COMMENTS_SQL}),
linked AS (SELECT c.post_entity_id, c.source_entity_id, c.parent_comment_entity_id AS parent, p.source_entity_id AS found
  FROM c LEFT JOIN c AS p ON p.post_entity_id = c.post_entity_id AND p.source_entity_id = c.parent_comment_entity_id),
tree AS (
  SELECT post_entity_id, source_entity_id, source_entity_id AS root_id, 0 AS depth, parent IS NOT NULL AS is_orphan FROM linked WHERE found IS NULL
  UNION ALL
  SELECT l.post_entity_id, l.source_entity_id, t.root_id, t.depth + 1, FALSE
  FROM linked l JOIN tree t ON l.post_entity_id = t.post_entity_id AND l.found = t.source_entity_id)
"""
_TREE_COLUMNS = "post_entity_id, source_entity_id, root_id, CAST(depth AS BIGINT) AS depth, is_orphan"


@query("comment_tree", f"{_TREE_SQL} SELECT {_TREE_COLUMNS} FROM tree")
def comment_tree(t: Tables) -> DataFrame:
    return threads.comment_tree(V.comments(t)).drop("source", "in_cycle")


@query(
    "comment_tree_strict",
    f"""{_TREE_SQL} SELECT {_TREE_COLUMNS} FROM tree
WHERE depth = 0 OR NOT EXISTS (SELECT 1 FROM tree r WHERE r.is_orphan AND r.source_entity_id = tree.root_id)""",
)
def comment_tree_strict(t: Tables) -> DataFrame:
    return threads.comment_tree(V.comments(t), strict=True).drop("source", "in_cycle")


@query(
    "recent_url_activity",
    f"""WITH s AS ({V.URL_STATE_SQL}) SELECT count(*) AS recent_urls FROM s
WHERE last_fetched_at >= {V.AS_OF_SQL} - INTERVAL 1 HOUR""",
)
def recent_url_activity(t: Tables) -> DataFrame:
    return readers.recent_url_activity(V.url_state(t), V.as_of())


@query(
    "topic_ids_coerce",
    """WITH raw AS (
SELECT event_id, CASE event_id % 6 WHEN 0 THEN '["' || event_type || '", ' || user_id || ']' WHEN 1 THEN props WHEN 2 THEN ''
  WHEN 3 THEN NULL WHEN 4 THEN '[broken' ELSE '[' || user_id || ']' END AS topics FROM events)
SELECT event_id, CASE WHEN topics LIKE '[%]' THEN array_to_string(from_json(topics, '["VARCHAR"]'), '|') ELSE '' END AS topics,
  CAST(CASE WHEN topics LIKE '[%]' THEN json_array_length(topics) ELSE 0 END AS BIGINT) AS n_topics FROM raw""",
)
def topic_ids_coerce(t: Tables) -> DataFrame:
    which, user = F.col("event_id") % 6, F.col("user_id").cast("string")
    raw = (
        F.when(which == 0, F.concat(F.lit('["'), F.col("event_type"), F.lit('", '), user, F.lit("]")))
        .when(which == 1, F.col("props"))
        .when(which == 2, "")
        .when(which == 4, "[broken")
        .when(which == 5, F.concat(F.lit("["), user, F.lit("]")))
    )
    topics = t.events.select("event_id", topic_ids(raw).alias("_ids"))
    return topics.select(
        "event_id", F.array_join("_ids", "|").alias("topics"), F.size("_ids").cast("bigint").alias("n_topics")
    )


@query(
    "status_overview",
    f"""WITH r AS ({V.RUNS_SQL}), e AS ({V.ERRORS_SQL}), s AS ({V.URL_STATE_SQL}), i AS ({V.SEED_ITEMS_SQL}),
last AS (SELECT * FROM r ORDER BY started_at DESC LIMIT 1)
SELECT 'latest_run' AS section, run_id AS name, started_at AS at, tasks_enqueued AS n FROM last
UNION ALL SELECT * FROM (SELECT 'recent_runs', run_id, started_at, tasks_enqueued FROM r ORDER BY started_at DESC LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'recent_errors', url, created_at, length(coalesce(error_message, '')) FROM e ORDER BY created_at DESC, source, url, error_message LIMIT 20)
UNION ALL SELECT 'in_flight_urls', '', NULL, count(*) FROM s WHERE last_fetched_at >= {V.AS_OF_SQL} - INTERVAL 1 HOUR
UNION ALL SELECT 'seed_sets', logical_set_name, {V.AS_OF_SQL}, count(DISTINCT (item_kind, item_value)) FILTER (item_kind <> 'discover_homepage') FROM i GROUP BY logical_set_name""",
)
def status_overview(t: Tables) -> DataFrame:
    from tidewire.operators import seeds as S

    items = V.seed_items(t)
    names = items.select(F.col("logical_set_name").alias("name")).distinct()
    documents = S.seed_documents(names, S.compile_items(items), V.as_of())
    parts = dashboard.status(V.runs(t), V.errors(t), V.url_state(t), documents, now=V.as_of())
    return dashboard.overview(parts)


@query(
    "sql_surface",
    f"""WITH p AS ({V.POSTS_SQL}) SELECT source, count(*) AS posts, count(published_at) AS dated, max(comment_count) AS most_comments
FROM p GROUP BY source""",
)
def sql_surface(t: Tables) -> DataFrame:
    sqlsurface.register_views(t.spark, {"stored_posts": V.posts(t)})
    return sqlsurface.run_sql(
        t.spark,
        """SELECT source, count(*) AS posts, count(published_at) AS dated, max(comment_count) AS most_comments
           FROM stored_posts GROUP BY source""",
    )
