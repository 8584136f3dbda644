"""Stored tables, captured pages, the SQL surface, the registries and argument checks over the test tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import payloads as J
from tidewire.functions.times import strict_time
from tidewire.operators import readers
from tidewire.plans import sqlsurface
from tidewire.schemas import RAW_PAGES, conform
from tidewire.session import run_dir
from tidewire.sources import captures, datasets
from tidewire.sources.registry import ADAPTERS
from tidewire.sources.tables import ALL_TABLES, create_tables, scan
from tidewire.workload import views as V
from tidewire.workload.crawl import seeds as seed_rows
from tidewire.workload.registry import Tables, query


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


_COLUMNS_SQL = ", ".join(f"('{name}', {len(schema)})" for name, schema in ALL_TABLES.items())


@query(
    "stored_tables",
    f"""WITH filled AS (SELECT 'posts' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'url_state', count(DISTINCT user_id) FROM events
UNION ALL SELECT 'crawl_errors', count(*) FROM events WHERE event_type = 'error')
SELECT t.name AS table_name, t.columns, coalesce(n, 0) AS n FROM (VALUES {_COLUMNS_SQL}) t(name, columns) LEFT JOIN filled ON t.name = table_name""",
)
def stored_tables(t: Tables) -> DataFrame:
    """All tables created twice, three filled, each found in the listing and scanned with its schema."""
    database = f"feed_{uuid.uuid4().hex}"
    create_tables(t.spark, database)
    for name, rows in (("posts", V.posts(t)), ("url_state", V.url_state(t)), ("crawl_errors", V.errors(t))):
        conform(rows, ALL_TABLES[name]).write.insertInto(f"{database}.{name}")
    create_tables(t.spark, database)
    found = []
    for row in sqlsurface.list_tables(t.spark, database).collect():
        name = row["tableName"]
        location = t.spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").where("col_name = 'Location'").first()["data_type"]
        rows = scan(t.spark, name, location)
        found.append(rows.agg(F.lit(name).alias("table_name"), F.lit(len(rows.columns)).alias("columns"), F.count(F.lit(1)).alias("n")))
    return _union(found)


@query(
    "sql_guard",
    """SELECT 'read' AS verdict, 'posts' AS what, count(*) AS n FROM orders
UNION ALL SELECT 'read', 'sources', count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'read', 'tables', 2
UNION ALL SELECT 'refused', what, (SELECT count(*) FROM orders) FROM (SELECT unnest(['insert', 'with insert', 'create', 'drop', 'set', 'cache']) AS what)""",
)
def sql_guard(t: Tables) -> DataFrame:
    """Statements over registered views: reading ones run, changing ones are refused and change nothing."""
    own = f"v{uuid.uuid4().hex}"
    posts, errors = f"{own}_posts", f"{own}_errors"
    sqlsurface.register_views(t.spark, {posts: V.posts(t), errors: V.errors(t)})
    reading = {
        "posts": f"(SELECT count(*) AS n FROM {posts});",
        "sources": f"WITH s AS (SELECT DISTINCT source FROM {posts}) SELECT count(*) AS n FROM s",
    }
    found = [
        sqlsurface.run_sql(t.spark, sql).select(F.lit("read").alias("verdict"), F.lit(what).alias("what"), F.col("n").cast("bigint").alias("n"))
        for what, sql in reading.items()
    ]
    shown = sqlsurface.run_sql(t.spark, "SHOW TABLES").where(F.col("tableName").startswith(own))
    found.append(shown.agg(F.lit("read").alias("verdict"), F.lit("tables").alias("what"), F.count(F.lit(1)).alias("n")))
    changing = {
        "insert": f"INSERT INTO {posts} SELECT * FROM {posts}", "with insert": f"WITH s AS (SELECT 1) INSERT INTO {posts} SELECT * FROM s",
        "create": f"CREATE TABLE {own} AS SELECT * FROM {posts}", "drop": f"DROP VIEW {posts}", "set": "SET spark.sql.ansi.enabled=false", "cache": f"CACHE TABLE {posts}",
    }
    for what, sql in changing.items():
        try:
            sqlsurface.run_sql(t.spark, sql)
        except ValueError:
            left = t.spark.table(posts).agg(F.count(F.lit(1)).alias("n"))
            found.append(left.select(F.lit("refused").alias("verdict"), F.lit(what).alias("what"), "n"))
    return _union(found)


@query(
    "captured_newest",
    """WITH c AS (SELECT page_id, url, html, unnest(CASE page_id % 4 WHEN 0 THEN [1] WHEN 1 THEN [1, 2] WHEN 2 THEN [2, 9] ELSE [9] END) AS day FROM pages),
k AS (SELECT url, max(day) AS day FROM c WHERE day <= 5 GROUP BY url)
SELECT url, day, min(day || html) AS text FROM c JOIN k USING (url, day) GROUP BY url, day""",
)
def captured_newest(t: Tables) -> DataFrame:
    """Pages captured on several days, read up to the fifth: the newest capture of each."""
    home = run_dir(t.spark, "captured")
    number = F.col("page_id") % 4
    days = F.when(number == 0, F.array(F.lit(1))).when(number == 1, F.array(F.lit(1), F.lit(2))).when(number == 2, F.array(F.lit(2), F.lit(9))).otherwise(F.array(F.lit(9)))
    rows = t.pages.select("url", "html", F.explode(days).alias("day")).select(
        "url", F.lit(1).alias("page_no"), F.lit("main").alias("section"), F.lit(200).alias("status_code"),
        F.concat(F.col("day").cast("string"), "html").alias("text"), F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)).alias("fetched_at"),
    )
    conform(rows, RAW_PAGES).write.parquet(home)
    now = datetime(2024, 1, 5, tzinfo=timezone.utc)
    pages = datasets.read_pages(t.spark, home, until=now)
    found = captures.newest(pages, pages.select("url").distinct(), F.lit(now).cast("timestamp"))
    return found.select("url", F.dayofmonth("fetched_at").alias("day"), "text")


@query(
    "registered_sources",
    """WITH p AS (SELECT *, len(string_split(p_name, ' ')) AS words FROM part)
SELECT 'xueqiu' AS source, 'discover' AS kind, CAST(sum(words + 1 + CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS BIGINT) AS tasks FROM p
UNION ALL SELECT source, kind, count(*) FROM p, (VALUES ('xueqiu', 'fetch_post'), ('bilibili', 'fetch_post'), ('bilibili', 'discover'), ('plain', 'discover')) s(source, kind) GROUP BY ALL""",
)
def registered_sources(t: Tables) -> DataFrame:
    """Every seed offered to every registered source, and to one that is plugged in."""
    def expand(seeds: DataFrame) -> DataFrame:
        return seeds.select(F.lit("plain").alias("source"), F.lit("discover").alias("kind"), F.explode("topic_ids").alias("url"))

    sources = {**ADAPTERS, "plain": SimpleNamespace(SOURCE="plain", expand=expand)}
    tasks = _union([a.expand(seed_rows(t)).select("source", "kind") for a in sources.values()])
    return tasks.groupBy("source", "kind").agg(F.count("*").alias("tasks"))


_ID_SQL = "CASE doc_id % 5 WHEN 0 THEN CAST(doc_id AS VARCHAR) WHEN 1 THEN lang || ':' || doc_id || '.a_b-c' WHEN 2 THEN doc_id || ' x' WHEN 3 THEN repeat('a', CAST(120 + doc_id % 20 AS INTEGER)) ELSE '' END"


@query(
    "argument_checks",
    f"""SELECT doc_id, regexp_full_match({_ID_SQL}, '[A-Za-z0-9_.:-]{{1,128}}') AS id_valid,
  CASE WHEN doc_id % 3 = 0 THEN TRUE ELSE doc_id % 3 = 1 END AS source_valid FROM documents""",
)
def argument_checks(t: Tables) -> DataFrame:
    doc, key = F.col("doc_id"), F.col("doc_id").cast("string")
    made = (
        F.when(doc % 5 == 0, key).when(doc % 5 == 1, F.concat("lang", F.lit(":"), key, F.lit(".a_b-c"))).when(doc % 5 == 2, F.concat(key, F.lit(" x")))
        .when(doc % 5 == 3, F.repeat(F.lit("a"), (120 + doc % 20).cast("int"))).otherwise("")
    )
    source = F.when(doc % 3 == 0, F.lit(None).cast("string")).when(doc % 3 == 1, "bilibili").otherwise("elsewhere")
    return t.documents.select("doc_id", readers.valid_entity_id(made).alias("id_valid"), readers.valid_source(source).alias("source_valid"))


@query("stored_times", "SELECT event_id, ts AS at, ts - INTERVAL 8 HOUR AS at_offset FROM events")
def stored_times(t: Tables) -> DataFrame:
    """Times kept as ISO text, without and with an offset, read back."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.events.select(
        "event_id", strict_time(text).alias("at"), strict_time(F.concat(text, F.lit("+08:00"))).alias("at_offset"),
    )


@query(
    "json_counts",
    """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 2 THEN 1 WHEN 3 THEN p_size WHEN 5 THEN -p_size WHEN 6 THEN p_size * 1000 WHEN 7 THEN 0 END AS n FROM part""",
)
def json_counts(t: Tables) -> DataFrame:
    """Counts as JSON writes them: integers, fractions, true, text, text that is none, negatives, exponents, false."""
    shape, size = F.col("p_partkey") % 8, F.col("p_size").cast("string")
    text = (
        F.when(shape == 0, size).when(shape == 1, F.concat(size, F.lit(".9"))).when(shape == 2, "true").when(shape == 3, F.concat(F.lit('" '), size, F.lit(' "')))
        .when(shape == 4, F.concat(F.lit('"'), size, F.lit('.9"'))).when(shape == 5, F.concat(F.lit("-"), size, F.lit(".5"))).when(shape == 6, F.concat(size, F.lit("e3")))
        .otherwise("false")
    )
    body = J.parse(F.concat(F.lit('{"stat":{"like":'), text, F.lit("}}")))
    return t.part.select("p_partkey", J.whole(J.field(body, "stat.like", "variant")).alias("n"))
