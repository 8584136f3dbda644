"""Upserts, state updates and merge on read over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators import frontier as FR
from tidewire.operators.upsert import last_by_key, update_by_key, upsert
from tidewire.session import run_dir
from tidewire.sources.tables import LogTable
from tidewire.workload import views as V
from tidewire.workload.registry import Tables, query

AUTHORS_SQL = """
SELECT 'xueqiu' AS source, CAST(c_custkey AS VARCHAR) AS source_entity_id, c_name AS display_name,
  CAST(c_nationkey AS BIGINT) AS followers FROM customer"""

# A batch that renames every customer with an order, in order of o_orderkey, so some keys repeat.
_BATCH_SQL = """
SELECT 'xueqiu' AS source, CAST(o_custkey AS VARCHAR) AS source_entity_id,
  o_orderpriority || '-' || o_orderkey AS display_name, CAST(o_orderkey AS BIGINT) AS followers, o_orderkey AS seq
FROM orders"""
_LAST_SQL = f"""batch AS ({_BATCH_SQL}), newest AS (
SELECT source, source_entity_id, arg_max(display_name, seq) AS display_name, arg_max(followers, seq) AS followers FROM batch GROUP BY ALL)"""


def authors(t: Tables) -> DataFrame:
    return t.customer.select(
        F.lit("xueqiu").alias("source"),
        F.col("c_custkey").cast("string").alias("source_entity_id"),
        F.col("c_name").alias("display_name"),
        F.col("c_nationkey").cast("bigint").alias("followers"),
    )


def author_batch(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        F.lit("xueqiu").alias("source"),
        F.col("o_custkey").cast("string").alias("source_entity_id"),
        F.concat(F.col("o_orderpriority"), F.lit("-"), key.cast("string")).alias("display_name"),
        key.cast("bigint").alias("followers"),
        key.alias("seq"),
    )


_KEYS = ["source", "source_entity_id"]


@query(
    "upsert_latest",
    f"""WITH a AS ({AUTHORS_SQL}), {_LAST_SQL}
SELECT source, source_entity_id, CASE WHEN n.source IS NULL THEN a.display_name ELSE n.display_name END AS display_name,
  CASE WHEN n.source IS NULL THEN a.followers ELSE n.followers END AS followers
FROM a FULL JOIN newest n USING (source, source_entity_id)""",
)
def upsert_latest(t: Tables) -> DataFrame:
    return upsert(authors(t), author_batch(t), _KEYS, ["seq"])


@query(
    "upsert_preserve",
    f"""WITH a AS ({AUTHORS_SQL}), {_LAST_SQL}
SELECT source, source_entity_id, CASE WHEN n.source IS NULL THEN a.display_name ELSE n.display_name END AS display_name,
  CASE WHEN a.source IS NULL THEN n.followers ELSE a.followers END AS followers
FROM a FULL JOIN newest n USING (source, source_entity_id)""",
)
def upsert_preserve(t: Tables) -> DataFrame:
    return upsert(authors(t), author_batch(t), _KEYS, ["seq"], preserve=["followers"])


@query(
    "merge_on_read",
    """SELECT CAST(user_id AS VARCHAR) AS source, event_type AS source_entity_id, arg_max(props, event_id) AS content_text, max(event_id) AS last_seq
FROM events GROUP BY user_id, event_type""",
)
def merge_on_read(t: Tables) -> DataFrame:
    log = t.events.select(
        F.col("user_id").cast("string").alias("source"),
        F.col("event_type").alias("source_entity_id"),
        F.col("props").alias("content_text"),
        F.col("event_id").alias("last_seq"),
    )
    return last_by_key(log, _KEYS, ["last_seq"])


_STORED_SQL = f"""WITH a AS ({AUTHORS_SQL}), {_LAST_SQL}
SELECT source, source_entity_id, CASE WHEN n.source IS NULL THEN a.display_name ELSE n.display_name END AS display_name,
  CASE WHEN n.source IS NULL THEN a.followers ELSE n.followers END AS followers
FROM a FULL JOIN newest n USING (source, source_entity_id)"""


@query("log_table_upsert", _STORED_SQL)
def log_table_upsert(t: Tables) -> DataFrame:
    """Two batches written to a stored table, with a snapshot in between, read back merged."""
    table = LogTable.named(t.spark, run_dir(t.spark, "log-table"), "authors")
    table.append(authors(t), batch_id=1)
    table.compact()
    table.append(author_batch(t), batch_id=2, order=["seq"])
    return table.read().select(*_KEYS, "display_name", "followers")


@query("two_writers_upsert", _STORED_SQL)
def two_writers_upsert(t: Tables) -> DataFrame:
    """Two writers whose batch ids are equal; the later one wins per key, nothing else is lost."""
    table = LogTable.named(t.spark, run_dir(t.spark, "two-writers"), "authors")
    table.append(authors(t), 0, writer="loader")
    table.append(author_batch(t), 0, ["seq"], "renamer")
    return table.read().select(*_KEYS, "display_name", "followers")


@query("write_after_compaction", _STORED_SQL)
def write_after_compaction(t: Tables) -> DataFrame:
    """A batch whose id is below those the snapshot covers, then a second compaction."""
    table = LogTable.named(t.spark, run_dir(t.spark, "late-batch"), "authors")
    table.append(authors(t), batch_id=7)
    table.compact()
    table.append(author_batch(t), batch_id=3, order=["seq"])
    table.compact()
    return table.read().select(*_KEYS, "display_name", "followers")


@query(
    "update_fetched",
    f"""WITH s AS ({V.URL_STATE_SQL}), u AS (
SELECT 'https://e.example/' || user_id AS url, max(event_id) AS last_id FROM events GROUP BY user_id),
l AS (SELECT u.url, CASE WHEN e.event_type = 'view' THEN NULL ELSE CAST(300 + e.event_id % 100 AS INTEGER) END AS status
  FROM u JOIN events e ON e.event_id = u.last_id)
SELECT s.url, s.kind, CASE WHEN l.url IS NULL THEN s.last_fetched_at ELSE {V.AS_OF_SQL} END AS last_fetched_at,
  CASE WHEN l.url IS NULL THEN s.last_status ELSE l.status END AS last_status FROM s LEFT JOIN l USING (url)""",
)
def update_fetched(t: Tables) -> DataFrame:
    """Mark URLs fetched; a null status overwrites, unknown URLs are not inserted."""
    updates = t.events.select(
        F.concat(F.lit("https://e.example/"), F.col("user_id").cast("string")).alias("url"),
        V.as_of().alias("last_fetched_at"),
        F.when(F.col("event_type") != "view", 300 + F.col("event_id") % 100).cast("int").alias("last_status"),
        F.col("event_id").alias("seq"),
    )
    unknown = updates.withColumn("url", F.concat("url", F.lit("/unknown")))
    marked = update_by_key(V.url_state(t), updates.unionByName(unknown), ["url"], ["seq"])
    return marked.select("url", "kind", "last_fetched_at", "last_status")


@query(
    "comment_refresh_due",
    f"""WITH p AS ({V.POSTS_SQL}), st AS (
SELECT '1-URGENT' AS source, CAST(user_id AS VARCHAR) AS source_entity_id, CASE WHEN user_id % 9 <> 0 THEN max(ts) END AS at FROM events GROUP BY user_id)
SELECT p.source, p.source_entity_id FROM p LEFT JOIN st USING (source, source_entity_id)
WHERE st.at IS NULL OR st.at <= {V.AS_OF_SQL} - INTERVAL 600 MINUTE""",
)
def comment_refresh_due(t: Tables) -> DataFrame:
    user = F.col("user_id")
    state = t.events.groupBy("user_id").agg(F.max(F.col("ts").cast("timestamp")).alias("_at")).select(
        F.lit("1-URGENT").alias("source"),
        user.cast("string").alias("source_entity_id"),
        F.when(user % 9 != 0, F.col("_at")).alias("last_comment_refresh_at"),
    )
    due = FR.comments_due(V.posts(t), state, now=V.as_of(), min_age=600)
    return due.select("source", "source_entity_id")
