"""The test tables seen as this engine's relations, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.workload.registry import Tables

AS_OF = "2024-01-31 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def _text(c: str):
    return F.col(c).cast("string")


# --- posts, from orders -------------------------------------------------------------------

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

POSTS_SQL = """
SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS source_entity_id,
       'https://p.example/' || o_orderkey AS canonical_url,
       CASE WHEN o_custkey % 10 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS author_entity_id,
       CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN '' ELSE 'order ' || o_orderkey END AS title,
       '  order' || chr(10) || ' ' || o_orderkey || '   by ' || o_custkey || ' ' AS content_text,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS published_at,
       o_orderdate + INTERVAL 1 DAY AS fetched_at,
       CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 1000 END AS like_count,
       o_orderkey % 50 AS comment_count
FROM orders"""


def posts(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    ordered = F.col("o_orderdate").cast("timestamp")
    key = _text("o_orderkey")
    return t.orders.select(
        F.col("o_orderpriority").alias("source"),
        key.alias("source_entity_id"),
        F.concat(F.lit("https://p.example/"), key).alias("canonical_url"),
        F.when(F.col("o_custkey") % 10 == 0, "").otherwise(_text("o_custkey")).alias("author_entity_id"),
        F.when(status == "F", None).when(status == "O", "").otherwise(F.concat(F.lit("order "), key)).alias("title"),
        F.concat(F.lit("  order\n "), key, F.lit("   by "), _text("o_custkey"), F.lit(" ")).alias("content_text"),
        F.when(status != "P", ordered).alias("published_at"),
        (ordered + F.expr("interval 1 day")).alias("fetched_at"),
        F.when(status != "F", F.col("o_custkey") % 1000).alias("like_count"),
        (F.col("o_orderkey") % 50).alias("comment_count"),
    )


# --- threads: a document is a post, a conversation its comments --------------------------

DOC_POSTS_SQL = """
SELECT 'xueqiu' AS source, CAST(doc_id AS VARCHAR) AS source_entity_id, 'https://d.example/' || doc_id AS canonical_url,
       CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'user' ELSE 'assistant' END AS author_entity_id,
       source AS title, text AS content_text, lang AS language
FROM documents"""

COMMENTS_SQL = """
SELECT 'xueqiu' AS source, conv_id || ':' || turn AS source_entity_id, CAST(conv_id AS VARCHAR) AS post_entity_id,
       CASE WHEN role <> 'system' THEN role END AS author_entity_id,
       CASE WHEN turn IN (3, 4) THEN conv_id || ':gone' WHEN turn > 0 THEN conv_id || ':' || ((turn - 1) // 2) END AS parent_comment_entity_id,
       text AS content_text,
       CASE WHEN turn % 3 <> 0 THEN TIMESTAMP '2024-01-01' + to_minutes(conv_id * 10 + 20 - turn) END AS published_at,
       TIMESTAMP '2024-02-01' + to_seconds(turn) AS fetched_at
FROM conversations"""


def doc_posts(t: Tables) -> DataFrame:
    doc = F.col("doc_id")
    return t.documents.select(
        F.lit("xueqiu").alias("source"),
        _text("doc_id").alias("source_entity_id"),
        F.concat(F.lit("https://d.example/"), _text("doc_id")).alias("canonical_url"),
        F.when(doc % 3 == 1, "user").when(doc % 3 == 2, "assistant").alias("author_entity_id"),
        F.col("source").alias("title"),
        F.col("text").alias("content_text"),
        F.col("lang").alias("language"),
    )


def comments(t: Tables) -> DataFrame:
    conv, turn = _text("conv_id"), F.col("turn")
    parent = F.floor((turn - 1) / 2).cast("bigint").cast("string")
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(
        mins=(F.col("conv_id") * 10 + 20 - turn).cast("int")
    )
    return t.conversations.select(
        F.lit("xueqiu").alias("source"),
        F.concat(conv, F.lit(":"), turn.cast("string")).alias("source_entity_id"),
        conv.alias("post_entity_id"),
        F.when(F.col("role") != "system", F.col("role")).alias("author_entity_id"),
        # Answers to the second turn lost their parent, so they and what hangs below are orphans.
        F.when(turn.isin(3, 4), F.concat(conv, F.lit(":gone")))
        .when(turn > 0, F.concat(conv, F.lit(":"), parent)).alias("parent_comment_entity_id"),
        F.col("text").alias("content_text"),
        F.when(turn % 3 != 0, at).alias("published_at"),
        (F.lit("2024-02-01").cast("timestamp") + F.make_dt_interval(secs=turn.cast("decimal(18,6)"))).alias("fetched_at"),
    )


# --- runs and errors, from events ---------------------------------------------------------

RUNS_SQL = """
SELECT 'run-' || strftime(ts, '%Y-%m-%d') AS run_id, min(ts) AS started_at,
       CASE WHEN any_value(day(ts)) % 7 <> 0 THEN max(ts) END AS finished_at,
       CASE WHEN any_value(day(ts)) % 5 = 0 THEN NULL WHEN any_value(day(ts)) % 2 = 0 THEN 'succeeded' ELSE 'failed' END AS status,
       count(*) FILTER (event_type = 'signup') AS seeds_processed, count(*) AS tasks_enqueued,
       count(*) FILTER (event_type = 'view') AS pages_fetched, count(*) FILTER (event_type = 'click') AS posts_written,
       count(*) FILTER (event_type = 'purchase') AS comments_written, CAST(NULL AS BIGINT) AS authors_written,
       count(*) FILTER (event_type = 'error' AND user_id % 2 = 0) AS blocked_responses,
       count(*) FILTER (event_type = 'error') AS errors,
       CASE WHEN any_value(day(ts)) % 3 <> 0 THEN count(*) FILTER (user_id % 10 = 0) END AS skipped_tasks
FROM events GROUP BY strftime(ts, '%Y-%m-%d')"""

ERRORS_SQL = """
SELECT ts AS created_at, CASE WHEN user_id % 2 = 0 THEN 'bilibili' ELSE 'xueqiu' END AS source,
       'https://e.example/' || user_id AS url, CASE WHEN user_id % 7 <> 0 THEN 'failed with ' || props END AS error_message
FROM events WHERE event_type = 'error'"""


def runs(t: Tables) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    day = F.dayofmonth("_day")
    grouped = t.events.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.to_date("ts").alias("_day")).agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("_last"),
        F.count_if(kind == "signup").alias("seeds_processed"),
        F.count("*").alias("tasks_enqueued"),
        F.count_if(kind == "view").alias("pages_fetched"),
        F.count_if(kind == "click").alias("posts_written"),
        F.count_if(kind == "purchase").alias("comments_written"),
        F.count_if((kind == "error") & (user % 2 == 0)).alias("blocked_responses"),
        F.count_if(kind == "error").alias("errors"),
        F.count_if(user % 10 == 0).alias("_skipped"),
    )
    return grouped.select(
        F.concat(F.lit("run-"), F.date_format("_day", "yyyy-MM-dd")).alias("run_id"),
        "started_at",
        F.when(day % 7 != 0, F.col("_last")).alias("finished_at"),
        F.when(day % 5 == 0, None).when(day % 2 == 0, "succeeded").otherwise("failed").alias("status"),
        "seeds_processed", "tasks_enqueued", "pages_fetched", "posts_written", "comments_written",
        F.lit(None).cast("bigint").alias("authors_written"),
        "blocked_responses", "errors",
        F.when(day % 3 != 0, F.col("_skipped")).alias("skipped_tasks"),
    )


def errors(t: Tables) -> DataFrame:
    user = F.col("user_id")
    return t.events.where("event_type = 'error'").select(
        F.col("ts").cast("timestamp").alias("created_at"),
        F.when(user % 2 == 0, "bilibili").otherwise("xueqiu").alias("source"),
        F.concat(F.lit("https://e.example/"), user.cast("string")).alias("url"),
        F.when(user % 7 != 0, F.concat(F.lit("failed with "), F.col("props"))).alias("error_message"),
    )


# --- URL state and frontier, from events ---------------------------------------------------

URL_STATE_SQL = """
SELECT 'https://e.example/' || user_id AS url, CASE WHEN user_id % 2 = 0 THEN 'bilibili' ELSE 'xueqiu' END AS source,
       'fetch_post' AS kind, 'seed' || (user_id % 5) AS seed_name, min(ts) AS first_seen_at, max(ts) AS last_seen_at,
       CASE WHEN user_id % 10 <> 0 THEN max(ts) END AS last_fetched_at, CAST(200 + user_id % 4 AS INTEGER) AS last_status
FROM events GROUP BY user_id"""

FRONTIER_SQL = """
SELECT CASE WHEN user_id % 2 = 0 THEN 'bilibili' ELSE 'xueqiu' END AS source,
       CASE event_type WHEN 'view' THEN 'discover' WHEN 'purchase' THEN 'discover' WHEN 'signup' THEN 'refresh_comments' ELSE 'fetch_post' END AS kind,
       CASE WHEN user_id % 4 = 0 THEN 'https://e.example/new/' ELSE 'https://e.example/' END || user_id AS url,
       'seed' || (user_id % 5) AS seed_name,
       CASE event_type WHEN 'view' THEN 120 WHEN 'purchase' THEN 120 WHEN 'signup' THEN 300 WHEN 'click' THEN 150 ELSE 200 END AS priority,
       CASE WHEN event_type = 'purchase' THEN 'space' END AS seed_kind,
       CASE WHEN user_id % 3 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) ELSE 0 END AS pubdate, event_id AS seq
FROM events"""


def url_state(t: Tables) -> DataFrame:
    user = F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    return t.events.groupBy("user_id").agg(F.min(ts).alias("first_seen_at"), F.max(ts).alias("last_seen_at")).select(
        F.concat(F.lit("https://e.example/"), user.cast("string")).alias("url"),
        F.when(user % 2 == 0, "bilibili").otherwise("xueqiu").alias("source"),
        F.lit("fetch_post").alias("kind"),
        F.concat(F.lit("seed"), (user % 5).cast("string")).alias("seed_name"),
        "first_seen_at",
        "last_seen_at",
        F.when(user % 10 != 0, F.col("last_seen_at")).alias("last_fetched_at"),
        (200 + user % 4).cast("int").alias("last_status"),
    )


def frontier(t: Tables) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    dated = F.map_from_arrays(
        F.array(F.lit("pubdate_ts")), F.array(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    )
    space = F.map_from_arrays(F.array(F.lit("seed_kind")), F.array(F.lit("space")))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return t.events.select(
        F.when(user % 2 == 0, "bilibili").otherwise("xueqiu").alias("source"),
        F.when(kind.isin("view", "purchase"), "discover").when(kind == "signup", "refresh_comments")
        .otherwise("fetch_post").alias("kind"),
        F.concat(
            F.when(user % 4 == 0, "https://e.example/new/").otherwise("https://e.example/"), user.cast("string")
        ).alias("url"),
        F.concat(F.lit("seed"), (user % 5).cast("string")).alias("seed_name"),
        F.when(kind.isin("view", "purchase"), 120).when(kind == "signup", 300).when(kind == "click", 150)
        .otherwise(200).alias("priority"),
        F.map_concat(
            F.when(user % 3 != 0, dated).otherwise(none), F.when(kind == "purchase", space).otherwise(none)
        ).alias("metadata"),
        F.col("event_id").alias("seq"),
    )


# --- seed items, from events; universe from part; ranking from lineitem ------------------------

SEED_ITEMS_SQL = """
SELECT event_type AS logical_set_name, 'gen' || (user_id % 2) AS generator_name,
       CASE user_id % 7 WHEN 0 THEN 'discover_homepage' WHEN 1 THEN 'post_url' WHEN 2 THEN 'bilibili_video_target'
            WHEN 3 THEN 'bilibili_space_url' WHEN 4 THEN 'stock_id' WHEN 5 THEN 'topic_id' ELSE 'user_id' END AS item_kind,
       CASE WHEN user_id % 7 = 0 THEN CASE WHEN user_id % 2 = 0 THEN 'True' ELSE 'no' END ELSE 'v' || user_id END AS item_value,
       min(ts) AS first_seen_at, max(ts) AS last_seen_at
FROM events GROUP BY ALL"""

# Fixed order of the kinds above.
_KINDS = (
    "discover_homepage", "post_url", "bilibili_video_target", "bilibili_space_url", "stock_id", "topic_id", "user_id",
)


def seed_items(t: Tables) -> DataFrame:
    user = F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    home = F.when(user % 2 == 0, "True").otherwise("no")
    return t.events.groupBy(
        F.col("event_type").alias("logical_set_name"),
        F.concat(F.lit("gen"), (user % 2).cast("string")).alias("generator_name"),
        F.element_at(kinds, (user % 7 + 1).cast("int")).alias("item_kind"),
        F.when(user % 7 == 0, home).otherwise(F.concat(F.lit("v"), user.cast("string"))).alias("item_value"),
    ).agg(F.min(ts).alias("first_seen_at"), F.max(ts).alias("last_seen_at"))


UNIVERSE_SQL = """
SELECT replace(p_brand, '#', '') || '-' || p_partkey AS stock_id, p_type AS market, p_brand AS board, string_split(p_name, ' ') AS tags
FROM part"""

RANKING_SQL = """
SELECT 'S' || l_partkey AS stock_id, CAST(l_shipdate AS DATE) AS trade_date, l_returnflag AS market,
       l_linestatus AS ranking_mode, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS rank
FROM lineitem"""


def universe(t: Tables) -> DataFrame:
    return t.part.select(
        F.concat(F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("-"), _text("p_partkey")).alias("stock_id"),
        F.col("p_type").alias("market"),
        F.col("p_brand").alias("board"),
        F.split("p_name", " ").alias("tags"),
    )


def ranking(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("S"), _text("l_partkey")).alias("stock_id"),
        F.to_date("l_shipdate").alias("trade_date"),
        F.col("l_returnflag").alias("market"),
        F.col("l_linestatus").alias("ranking_mode"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("rank"),
    )
