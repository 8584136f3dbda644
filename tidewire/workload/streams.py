"""Streaming jobs replaying the test tables in three arrivals, restarted for each; they return what was stored."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidewire.operators.frontier import FreshnessPolicy
from tidewire.operators.seeds import active_items
from tidewire.session import run_dir
from tidewire.sources.tables import LogTable
from tidewire.streaming import jobs
from tidewire.workload import views as V
from tidewire.workload.parsing import article_pages
from tidewire.workload.registry import Tables, query


# Rows of a stream's whole input for each state partition; the activity count holds each in twelve windows.
STATE_ROWS = 200_000


def _in_three(t: Tables, home: str, rows: DataFrame, part: Column, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Feed rows to a stream in three arrivals; the job is started anew for each and runs to the end of it."""
    source = rows.withColumn("_part", part)
    schema = source.drop("_part").schema
    for n in range(3):
        source.where(F.col("_part") == n).drop("_part").write.mode("append").parquet(f"{home}/source")
        start(t.spark.readStream.schema(schema).parquet(f"{home}/source")).awaitTermination()


@contextmanager
def _state_partitions(t: Tables, rows: DataFrame) -> Iterator[None]:
    """Streams started within have a state partition for every STATE_ROWS of `rows`, and no fewer than usual.

    Their number is fixed by a stream's first start, so it is chosen from all that will arrive."""
    key = "spark.sql.shuffle.partitions"
    usual = t.spark.conf.get(key)
    t.spark.conf.set(key, str(max(int(usual), -(-rows.count() // STATE_ROWS))))
    try:
        yield
    finally:
        t.spark.conf.set(key, usual)


def _thirds(column: str) -> Column:
    return F.pmod(F.col(column), F.lit(3))


def _author_events(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").cast("string").alias("source"),
        F.col("event_type").alias("source_entity_id"),
        F.col("props").alias("display_name"),
        F.col("event_id").alias("followers"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.col("event_id").alias("seq"),
    )


# Arrival: events by number modulo three, then by number.
_ARRIVAL_SQL = "event_id % 3 * 1000000000000 + event_id"


@query(
    "stream_upsert",
    f"""SELECT CAST(user_id AS VARCHAR) AS source, event_type AS source_entity_id, arg_max(props, {_ARRIVAL_SQL}) AS display_name,
  arg_max(event_id, {_ARRIVAL_SQL}) AS followers FROM events GROUP BY user_id, event_type""",
)
def stream_upsert(t: Tables) -> DataFrame:
    """The last arrival wins, over three arrivals and two restarts."""
    home = run_dir(t.spark, "stream-upsert")
    table = LogTable.named(t.spark, home, "authors")
    _in_three(t, home, _author_events(t), _thirds("seq"), lambda rows: jobs.upsert_stream(rows, table, ["seq"], f"{home}/checkpoint"))
    return table.read().select("source", "source_entity_id", "display_name", "followers")


# The last ten days arrive first, then the first ten, then those between.
_LATE_SQL = "CASE WHEN day(ts) > 20 THEN 0 WHEN day(ts) <= 10 THEN 1 ELSE 2 END"
_EVENT_KEY = "user_id, event_type"


@query(
    "stream_event_time",
    f"""WITH e AS (SELECT *, {_LATE_SQL} AS part FROM events),
a AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY {_EVENT_KEY} ORDER BY part DESC, event_id DESC) = 1),
n AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY {_EVENT_KEY} ORDER BY ts DESC, part DESC, event_id DESC) = 1)
SELECT 'arrival' AS mode, CAST(user_id AS VARCHAR) AS source, event_type AS source_entity_id, event_id AS followers, ts AS fetched_at FROM a
UNION ALL SELECT 'event time', CAST(user_id AS VARCHAR), event_type, event_id, ts FROM n
UNION ALL SELECT 'watermark', CAST(user_id AS VARCHAR), event_type, NULL, max(ts) FROM e WHERE part = 0 GROUP BY {_EVENT_KEY}""",
)
def stream_event_time(t: Tables) -> DataFrame:
    """Three arrivals, two of them late, under each rule: last arrival, newest event, newest event that
    is not five days behind the newest one seen."""
    late = F.when(F.dayofmonth("fetched_at") > 20, 0).when(F.dayofmonth("fetched_at") <= 10, 1).otherwise(2)
    out = None
    for mode in ("arrival", "event time", "watermark"):
        home = run_dir(t.spark, "stream-event-time")
        table = LogTable.named(t.spark, home, "authors")

        def start(rows: DataFrame, mode=mode, table=table, home=home) -> StreamingQuery:
            if mode == "arrival":
                return jobs.upsert_stream(rows, table, ["seq"], f"{home}/checkpoint")
            delay = "5 days" if mode == "watermark" else None
            return jobs.upsert_by_event_time(rows, table, "fetched_at", ["seq"], f"{home}/checkpoint", delay=delay)

        _in_three(t, home, _author_events(t), late, start)
        number = F.lit(None).cast("bigint") if mode == "watermark" else F.col("followers")
        rows = table.read().select(F.lit(mode).alias("mode"), "source", "source_entity_id", number.alias("followers"), "fetched_at")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "stream_articles",
    """WITH p AS (SELECT page_id, page_id % 6 AS shape FROM pages)
SELECT 'post' AS kind, CAST(page_id + 1000000 AS VARCHAR) AS id, shape FROM p WHERE shape IN (0, 1, 2, 4)
UNION ALL SELECT 'author', CASE WHEN page_id > 0 THEN CAST(page_id AS VARCHAR) ELSE 'unknown' END, NULL FROM p WHERE shape IN (0, 1)
UNION ALL SELECT 'error', 'https://xueqiu.com/' || page_id || '/' || (page_id + 1000000) || '?x=1#c', NULL FROM p WHERE shape NOT IN (0, 1, 2, 4)""",
)
def stream_articles(t: Tables) -> DataFrame:
    """The poll loop over article pages in three arrivals: posts, authors and errors it stored."""
    home = run_dir(t.spark, "stream-articles")
    pages = article_pages(t).select(
        F.lit("xueqiu").alias("source"), F.lit("fetch_post").alias("kind"), "url", F.lit("s").alias("seed_name"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("metadata"),
        F.lit(200).alias("status_code"), "text",
        F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("string").alias("proxy_url"), "fetched_at",
    )
    part = F.pmod(F.xxhash64("url"), F.lit(3))
    _in_three(t, home, pages, part, lambda rows: jobs.ingest_articles(rows, home, f"{home}/checkpoint"))

    def stored(name: str, kind: str, column: str, shape=None) -> DataFrame:
        rows = LogTable.named(t.spark, home, name).read()
        return rows.select(F.lit(kind).alias("kind"), F.col(column).alias("id"), (F.lit(None).cast("bigint") if shape is None else shape).alias("shape"))

    key = F.col("source_entity_id").cast("bigint") - 1000000
    parts = [stored("posts", "post", "source_entity_id", key % 6), stored("authors", "author", "source_entity_id"), stored("crawl_errors", "error", "url")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_dedupe", "SELECT DISTINCT user_id FROM events")
def stream_dedupe(t: Tables) -> DataFrame:
    """With a delay longer than the data, each key passes once, over three arrivals."""
    home = run_dir(t.spark, "stream-dedupe")
    rows = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")

    def start(stream: DataFrame) -> StreamingQuery:
        once = jobs.without_repeats(stream.select("user_id", "ts"), "ts", ["user_id"], "400 days").select("user_id")
        job = once.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint")
        return job.trigger(availableNow=True).start()

    _in_three(t, home, rows, _thirds("event_id"), start)
    return t.spark.read.schema("user_id bigint").parquet(f"{home}/out")


@query(
    "stream_activity",
    """WITH w AS (SELECT DISTINCT user_id, time_bucket(INTERVAL 5 MINUTE, ts) + to_minutes(5 * k) AS window_end
  FROM events, (SELECT unnest(range(1, 13)) AS k))
SELECT window_end, count(*) AS recent_urls FROM w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY window_end""",
)
def stream_activity(t: Tables) -> DataFrame:
    """Three arrivals of ten days each."""
    home = run_dir(t.spark, "stream-activity")
    rows = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))

    def start(stream: DataFrame) -> StreamingQuery:
        job = jobs.rolling_activity(stream, "ts", "user_id").writeStream.format("parquet").option("path", f"{home}/out")
        return job.option("checkpointLocation", f"{home}/checkpoint").outputMode("append").trigger(availableNow=True).start()

    with _state_partitions(t, rows):
        _in_three(t, home, rows, F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)), start)
    return t.spark.read.schema("window_end timestamp, recent_urls bigint").parquet(f"{home}/out")


@query(
    "stream_claim",
    f"""WITH f AS ({V.FRONTIER_SQL}),
won AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq % 3, priority DESC, pubdate DESC, seq) = 1)
SELECT 'state' AS what, url, source, kind, seed_name, {V.AS_OF_SQL} AS last_fetched_at FROM won
UNION ALL SELECT 'claim', url, source, kind, seed_name, {V.AS_OF_SQL} FROM won""",
)
def stream_claim(t: Tables) -> DataFrame:
    """A URL is claimed by the first arrival that has it and is fresh for the later ones."""
    home = run_dir(t.spark, "stream-claim")
    state = LogTable.named(t.spark, home, "url_state")
    _in_three(t, home, V.frontier(t), _thirds("seq"), lambda rows: jobs.claim_stream(
        rows, state, f"{home}/claims", f"{home}/checkpoint", now=V.as_of, policy=FreshnessPolicy()
    ))
    columns = ["url", "source", "kind", "seed_name"]
    claims = t.spark.read.parquet(f"{home}/claims").select(F.lit("claim").alias("what"), *columns, F.col("claimed_at").alias("last_fetched_at"))
    return state.read().select(F.lit("state").alias("what"), *columns, "last_fetched_at").unionByName(claims)


@query(
    "stream_ttl",
    f"""SELECT event_type AS logical_set_name, 'v' || user_id AS item_value, min(ts) AS first_seen_at, max(ts) AS last_seen_at
FROM events GROUP BY ALL HAVING max(ts) >= {V.AS_OF_SQL} - INTERVAL 1440 MINUTE""",
)
def stream_ttl(t: Tables) -> DataFrame:
    home = run_dir(t.spark, "stream-ttl")
    state = LogTable.named(t.spark, home, "generated_seed_items")
    items = t.events.select(
        F.col("event_type").alias("logical_set_name"),
        F.lit("gen").alias("generator_name"),
        F.lit("user_id").alias("item_kind"),
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("item_value"),
        F.col("ts").cast("timestamp").alias("ts"), "event_id",
    )
    _in_three(t, home, items, _thirds("event_id"), lambda rows: jobs.seed_item_stream(rows, state, f"{home}/checkpoint", "ts"))
    kept = active_items(state.read(), as_of=V.as_of(), ttl_minutes=1440)
    return kept.select("logical_set_name", "item_value", "first_seen_at", "last_seen_at")
