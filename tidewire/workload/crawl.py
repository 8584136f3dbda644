"""Task expansion, frontier, listings and run statistics over the test tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators import frontier as FR
from tidewire.operators import listing, runs
from tidewire.plans.cycle import run_cycle
from tidewire.schemas import RUN_COUNTERS
from tidewire.session import run_dir
from tidewire.sources import forum, video
from tidewire.sources.tables import LogTable
from tidewire.workload import views as V
from tidewire.workload.parsing import article_pages
from tidewire.workload.registry import Tables, query

POLICY = FR.FreshnessPolicy()


def seeds(t: Tables) -> DataFrame:
    """One seed per part, with values for every kind."""
    key = F.col("p_partkey").cast("string")
    none = F.array().cast("array<string>")
    return t.part.select(
        F.concat(F.lit("s"), key).alias("name"),
        (F.col("p_size") > 25).alias("discover_homepage"),
        F.array(F.concat(F.lit("https://xueqiu.com/1/"), key, F.lit("/"))).alias("post_urls"),
        F.array(F.concat(F.lit("av"), key), F.lit("junk")).alias("bilibili_video_targets"),
        F.array(key, F.lit("https://x.y/")).alias("bilibili_space_urls"),
        F.split("p_name", " ").alias("stock_ids"),
        F.array("p_brand").alias("topic_ids"),
        none.alias("user_ids"),
    )


@query(
    "task_expansion",
    """WITH p AS (SELECT 's' || p_partkey AS seed_name, * FROM part)
SELECT seed_name, 'xueqiu' AS source, 'discover' AS kind, 'https://xueqiu.com/' AS url, 100 AS priority, 'homepage' AS seed_kind, NULL AS item FROM p WHERE p_size > 25
UNION ALL SELECT seed_name, 'xueqiu', 'fetch_post', 'https://xueqiu.com/1/' || p_partkey, 200, 'post_url', NULL FROM p
UNION ALL SELECT seed_name, 'xueqiu', 'discover', 'https://xueqiu.com/query/v1/symbol/search/status.json?count=20&comment=0&symbol=' || w || '&hl=0&source=all&sort=time&page=1&q=&type=90', 120, 'stock', w
  FROM (SELECT seed_name, unnest(string_split(p_name, ' ')) AS w FROM p)
UNION ALL SELECT seed_name, 'xueqiu', 'discover', 'https://xueqiu.com/k?q=' || replace(p_brand, '#', '%23'), 120, 'topic', p_brand FROM p
UNION ALL SELECT seed_name, 'bilibili', 'fetch_post', 'https://www.bilibili.com/video/av' || p_partkey, 200, NULL, 'av' || p_partkey FROM p
UNION ALL SELECT seed_name, 'bilibili', 'discover', 'https://space.bilibili.com/' || p_partkey, 120, 'space', CAST(p_partkey AS VARCHAR) FROM p""",
)
def task_expansion(t: Tables) -> DataFrame:
    s = seeds(t)
    tasks = forum.expand(s).unionByName(video.expand(s))
    meta = F.col("metadata")
    item = F.coalesce(meta["stock_id"], meta["topic_id"], meta["user_id"], meta["video_target"], meta["mid"])
    return tasks.select("seed_name", "source", "kind", "url", "priority", meta["seed_kind"].alias("seed_kind"), item.alias("item"))


@query(
    "comment_tasks",
    f"""WITH p AS ({V.POSTS_SQL})
SELECT 'xueqiu' AS source, 'https://xueqiu.com/statuses/comments.json?id=' || source_entity_id || '&count=20&page=1' AS url, 300 AS priority,
  source_entity_id AS post_id, NULL AS owner_mid FROM p
UNION ALL SELECT 'bilibili', 'https://api.bilibili.com/x/v2/reply/main?oid=' || source_entity_id || '&type=1&mode=3&pn=1&ps=30&next=0', 300, source_entity_id, author_entity_id FROM p""",
)
def comment_tasks(t: Tables) -> DataFrame:
    posts = V.posts(t).withColumn("seed_name", F.lit("s"))
    tasks = forum.comment_tasks(posts).unionByName(video.comment_tasks(posts))
    return tasks.select(
        "source", "url", "priority", F.col("metadata")["post_id"].alias("post_id"), F.col("metadata")["owner_mid"].alias("owner_mid")
    )


_QUEUE = "ORDER BY priority DESC, pubdate DESC, seq"


@query(
    "frontier_order",
    f"WITH f AS ({V.FRONTIER_SQL}) SELECT seq, url, priority, row_number() OVER ({_QUEUE}) AS queue_pos FROM f",
)
def frontier_order(t: Tables) -> DataFrame:
    ordered = FR.in_queue_order(V.frontier(t)).select("seq", "url", "priority")
    return FR.with_positions(ordered)


_GATED_SQL = f"""f AS ({V.FRONTIER_SQL}), s AS ({V.URL_STATE_SQL}),
aged AS (SELECT f.*, CASE WHEN kind IN ('discover', 'refresh_comments') THEN 60 ELSE 360 END AS age FROM f),
open AS (SELECT a.*, s.first_seen_at AS old_first, s.last_status AS old_status FROM aged a LEFT JOIN s USING (url)
  WHERE s.last_fetched_at IS NULL OR s.last_fetched_at < {V.AS_OF_SQL} - to_minutes(age)),
won AS (SELECT * FROM open QUALIFY row_number() OVER (PARTITION BY url {_QUEUE}) = 1)"""


@query(
    "frontier_claim",
    f"WITH {_GATED_SQL} SELECT seq, url, kind, seq IN (SELECT seq FROM won) AS claimed FROM f",
)
def frontier_claim(t: Tables) -> DataFrame:
    tasks = FR.claim(V.frontier(t), V.url_state(t), now=V.as_of(), policy=POLICY)
    return tasks.select("seq", "url", "kind", "claimed")


@query(
    "frontier_claim_state",
    f"""WITH {_GATED_SQL} SELECT url, source, kind, seed_name, coalesce(old_first, {V.AS_OF_SQL}) AS first_seen_at,
  {V.AS_OF_SQL} AS last_seen_at, {V.AS_OF_SQL} AS last_fetched_at, old_status AS last_status FROM won""",
)
def frontier_claim_state(t: Tables) -> DataFrame:
    winners = FR.claim_winners(V.frontier(t), V.url_state(t), now=V.as_of(), policy=POLICY)
    return FR.claimed_state(winners, now=V.as_of())


@query(
    "frontier_policy",
    f"""WITH f AS ({V.FRONTIER_SQL}) SELECT source, kind, seed_kind, CASE WHEN kind = 'discover' AND source = 'bilibili' AND seed_kind = 'space' THEN 45
  WHEN kind IN ('discover', 'refresh_comments') THEN 30 ELSE 360 END AS min_age, count(*) AS tasks FROM f GROUP BY ALL""",
)
def frontier_policy(t: Tables) -> DataFrame:
    policy = FR.FreshnessPolicy(comment_refresh=30, space_discovery=45)
    return V.frontier(t).groupBy(
        "source", "kind", F.col("metadata")["seed_kind"].alias("seed_kind"), FR.min_age_minutes(policy).alias("min_age")
    ).agg(F.count("*").alias("tasks"))


# Listings: an event is a video seen on a page of its user's list; errors are search hits.
_VIDEO_SQL = """
SELECT CAST(user_id AS VARCHAR) AS mid, CASE WHEN event_type = 'error' THEN 'search' ELSE 'space' END AS section, event_id AS page_no,
  pos, 'BV' || (event_id % 13 * 2 + pos) AS bvid, CASE WHEN event_id % 5 > 0 THEN event_id % 5 END AS aid,
  CASE WHEN pos = 0 THEN event_id + 1 END AS pubdate_ts, pos = 1 AND event_type = 'error' AND event_id % 2 = 0 AS other
FROM events, (SELECT unnest([0, 1]) AS pos)"""


def listing_payloads(t: Tables) -> DataFrame:
    """One listing page per event with two videos; on even search pages the second has another owner."""
    user, event = F.col("user_id").cast("string"), F.col("event_id")
    search = F.col("event_type") == "error"
    def hit(pos: int):
        mid = user if pos == 0 else F.when(event % 2 == 0, F.concat(user, F.lit("x"))).otherwise(user)
        return F.struct(
            F.concat(F.lit("BV"), (event % 13 * 2 + pos).cast("string")).alias("bvid"),
            (event % 5).alias("aid"),
            mid.alias("mid"),
            (F.lit(0).cast("bigint") if pos else event + 1).alias("pubdate"),
        )

    videos = F.array(hit(0), hit(1))
    own = F.to_json(F.struct(F.struct(F.struct(videos.alias("vlist")).alias("list")).alias("data")))
    return t.events.select(
        user.alias("mid"), event.alias("page_no"),
        F.when(search, "search").otherwise("space").alias("section"),
        F.when(search, F.to_json(videos)).otherwise(own).alias("text"),
    )


_LISTED = "ORDER BY section = 'search', page_no, pos"


@query(
    "space_videos",
    f"""WITH v AS ({_VIDEO_SQL}) SELECT mid, bvid, section, page_no, pos, aid, pubdate_ts FROM v WHERE NOT other
QUALIFY row_number() OVER (PARTITION BY mid, bvid {_LISTED}) = 1""",
)
def space_videos(t: Tables) -> DataFrame:
    return video.space_videos(video.listing_rows(listing_payloads(t)))


@query(
    "space_top_n",
    f"""WITH v AS ({_VIDEO_SQL}), capped AS (SELECT * FROM v WHERE NOT other QUALIFY row_number() OVER (PARTITION BY mid, section {_LISTED}) <= 5)
SELECT mid, bvid, section, page_no, pos FROM capped QUALIFY row_number() OVER (PARTITION BY mid, bvid {_LISTED}) = 1""",
)
def space_top_n(t: Tables) -> DataFrame:
    rows = video.space_videos(video.listing_rows(listing_payloads(t)), max_per_section=5)
    return rows.select("mid", "bvid", "section", "page_no", "pos")


_PAGES_SQL = "SELECT user_id AS post, event_id // 1000 AS page, event_id % 3 AS rpid, event_id FROM events"


@query(
    "page_dedupe",
    f"""WITH r AS ({_PAGES_SQL}), fresh AS (SELECT post, rpid, min(page) AS page FROM r GROUP BY ALL),
pages AS (SELECT post, page, count(DISTINCT rpid) AS ids FROM r GROUP BY ALL),
counts AS (SELECT p.post, p.page, p.ids, count(f.rpid) AS new_ids FROM pages p LEFT JOIN fresh f USING (post, page) GROUP BY ALL),
stops AS (SELECT post, min(page) AS stop FROM counts WHERE new_ids = 0 GROUP BY post)
SELECT r.post, r.page, r.rpid, r.event_id FROM r LEFT JOIN stops USING (post) WHERE stop IS NULL OR r.page < stop""",
)
def page_dedupe(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.col("user_id").alias("post"), F.expr("event_id div 1000").alias("page"), (F.col("event_id") % 3).alias("rpid"), "event_id"
    )
    return listing.until_repeated_page(rows, ["post"], "rpid")


@query(
    "run_stats",
    f"""WITH e AS (SELECT 'run-' || strftime(ts, '%Y-%m-%d') AS run_id, 'seed' || (user_id % 5) AS seed_name, event_type, user_id, event_id,
  event_type <> 'signup' AS page, event_id % 4 <> 0 AS claimed FROM events)
SELECT run_id, count(DISTINCT seed_name) AS seeds_processed, count(*) AS tasks_enqueued, count(*) FILTER (claimed AND page) AS pages_fetched,
  coalesce(sum(user_id % 2) FILTER (claimed AND page), 0)::BIGINT AS posts_written, coalesce(sum(event_id % 9) FILTER (claimed AND NOT page), 0)::BIGINT AS comments_written,
  count(*) FILTER (claimed AND page) AS authors_written, count(*) FILTER (claimed AND page AND event_type = 'error') AS blocked_responses,
  count(*) FILTER (claimed AND page AND event_type = 'error') AS errors, count(*) FILTER (NOT claimed) AS skipped_tasks FROM e GROUP BY run_id""",
)
def run_stats(t: Tables) -> DataFrame:
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    tasks = t.events.select(
        F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.concat(F.lit("seed"), (user % 5).cast("string")).alias("seed_name"),
        F.when(kind == "signup", "refresh_comments").otherwise("fetch_post").alias("kind"),
        (event % 4 != 0).alias("claimed"),
        (kind == "error").alias("blocked"),
        F.when(kind == "error", 1).otherwise(0).alias("errors"),
        (user % 2).alias("posts"),
        (event % 9).alias("comments"),
        F.lit(1).alias("authors"),
    )
    return runs.run_stats(tasks)


@query(
    "discovered_tasks",
    """WITH p AS (SELECT page_id, url AS page, page_id % 3 AS k FROM pages)
SELECT page, 'https://xueqiu.com/' || page_id || '/1' AS url, 150 AS priority, page AS discovered_from, 0 AS pos FROM p WHERE k <> 0
UNION ALL SELECT page, 'https://xueqiu.com/' || page_id || '/2', 150, page, 1 FROM p WHERE k = 1""",
)
def discovered_tasks(t: Tables) -> DataFrame:
    """Discover tasks over the pages: plain pages, pages with post links, stock timelines as JSON."""
    shape, pid = F.col("page_id") % 3, F.col("page_id").cast("string")

    def link(n: str):
        return F.concat(F.lit('<a href="https://xueqiu.com/'), pid, F.lit(f'/{n}">'))

    record = F.struct(F.lit(1).alias("id"), F.col("page_id").alias("user_id"), F.col("html").alias("text"))
    timeline = F.to_json(F.struct(F.array(record).alias("list")))
    text = (
        F.when(shape == 1, F.concat(link("2/"), F.col("html"), link("1"), link("1/")))
        .when(shape == 2, timeline).otherwise(F.col("html"))
    )
    rows = t.pages.select("page_id", "url", text.alias("text"))
    seed_kind = F.when(F.col("page_id") % 3 == 2, "stock").otherwise("homepage")
    tasks = rows.select(
        F.lit("xueqiu").alias("source"), F.lit("discover").alias("kind"), "url", F.lit("s").alias("seed_name"),
        F.lit(120).alias("priority"), F.create_map(F.lit("seed_kind"), seed_kind).alias("metadata"), F.col("page_id").alias("seq"),
    )
    captured = rows.select(
        "url", F.lit(1).alias("page_no"), F.lit("main").alias("section"), F.lit(200).alias("status_code"), "text",
        F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("string").alias("proxy_url"),
        V.as_of().alias("fetched_at"),
    )
    _, found = forum.discover(tasks, captured)
    return found.select(
        F.col("parent.url").alias("page"), "url", "priority", F.col("metadata")["discovered_from"].alias("discovered_from"), "pos"
    )


_SHAPES = "page_id % 6 IN (0, 1, 2, 4)"
_TASK_URL = "'https://xueqiu.com/' || page_id || '/' || (page_id + 1000000) || '?x=1#c'"
_THREAD_URL = "'https://xueqiu.com/statuses/comments.json?id=' || (page_id + 1000000) || '&count=20&page=1'"
# Conversations without a gap up to a turn; a comment listing ends at the first missing page.
_READ_TURNS = """SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations) WHERE turn = place"""
_CYCLE_SQL = f"""
WITH p AS (SELECT page_id, page_id % 6 AS shape, {_SHAPES} AS good, {_TASK_URL} AS url, {_THREAD_URL} AS thread FROM pages),
c AS (SELECT conv_id, turn FROM ({_READ_TURNS}) JOIN p ON conv_id = page_id AND good),
facts AS (SELECT (SELECT count(*) FROM p) AS pages, (SELECT count(*) FROM p WHERE good) AS posts, (SELECT count(*) FROM c) AS comments,
  (SELECT count(*) FROM p WHERE shape IN (0, 1)) AS authors)
SELECT 'post' AS kind, CAST(page_id + 1000000 AS VARCHAR) AS id, 'author ' || CASE WHEN shape IN (0, 1) AND page_id > 0 THEN CAST(page_id AS VARCHAR) ELSE 'none' END AS note FROM p WHERE good
UNION ALL SELECT 'author', CASE WHEN page_id > 0 THEN CAST(page_id AS VARCHAR) ELSE 'unknown' END, 'n' || page_id FROM p WHERE shape IN (0, 1)
UNION ALL SELECT 'error', url, 'Could not parse post payload from ' || url FROM p WHERE NOT good
UNION ALL SELECT 'comment', conv_id || ':' || turn, CAST(conv_id + 1000000 AS VARCHAR) FROM c
UNION ALL SELECT 'url', url, 'fetch_post s-' || url || ' 200' FROM p
UNION ALL SELECT 'url', thread, 'refresh_comments s-' || url || ' 200' FROM p WHERE good
UNION ALL SELECT 'item', CAST(page_id + 1000000 AS VARCHAR), CASE WHEN page_id IN (SELECT conv_id FROM c) THEN 'refreshed' ELSE 'not refreshed' END FROM p WHERE good
UNION ALL SELECT 'run', 'succeeded', concat_ws(' ', pages, pages + posts, pages, posts, comments, authors, 0, pages - posts, 0) FROM facts"""


def _cycle_input(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Seeds and captured pages: every page is a seed, every conversation the comments of the page's post."""
    articles = article_pages(t)
    none = F.array().cast("array<string>")
    seeds = articles.select(
        F.concat(F.lit("s-"), "url").alias("name"), F.lit(False).alias("discover_homepage"), F.array("url").alias("post_urls"),
        *[none.alias(c) for c in ("bilibili_video_targets", "bilibili_space_urls", "stock_ids", "topic_ids", "user_ids")],
    )
    comment = F.struct(F.col("source_entity_id").alias("id"), F.col("content_text").alias("text"))
    post_id = (F.col("post_entity_id").cast("bigint") + 1000000).cast("string")
    threads = V.comments(t).select(
        F.concat(F.lit("https://xueqiu.com/statuses/comments.json?id="), post_id, F.lit("&count=20&page=1")).alias("url"),
        (F.split_part("source_entity_id", F.lit(":"), F.lit(2)).cast("int") + 1).alias("page_no"),
        F.to_json(F.struct(F.array(comment).alias("comments"), F.lit(True).alias("has_more"))).alias("text"),
        V.as_of().alias("fetched_at"),
    )
    captured = articles.withColumn("page_no", F.lit(1)).unionByName(threads).withColumns(
        {"section": F.lit("main"), "status_code": F.lit(200)}
    )
    return seeds, captured


class _NoComments:
    """The forum adapter, but its comment pages cannot be read."""

    def __getattr__(self, name: str):
        return getattr(forum, name)

    def comments(self, tasks: DataFrame, captured: DataFrame) -> DataFrame:
        raise _Unreadable("comment pages")


class _Unreadable(RuntimeError):
    pass


def _cycle_result(t: Tables, root: str, seeds: DataFrame, captured: DataFrame, attempts: Sequence[Any] = (forum,)) -> DataFrame:
    """All tables after the attempts at one cycle, each with its forum adapter, as (kind, id, note), and the run's counters."""
    # Captured pages are a stored table in practice; here they are derived, so they are stored first.
    captured.write.parquet(f"{root}/captured")
    stored = t.spark.read.parquet(f"{root}/captured")
    for adapter in attempts:
        try:
            run_cycle(
                t.spark, root, seeds, stored, run_id="run", batch_id=1, now=datetime(2024, 6, 1, tzinfo=timezone.utc),
                adapters={forum.SOURCE: adapter, video.SOURCE: video},
            )
        except _Unreadable:
            pass
    run = runs.run_rows(LogTable.named(t.spark, root, "crawl_runs").read())

    def table(name: str, kind: str, column: str, *note) -> DataFrame:
        rows = LogTable.named(t.spark, root, name).read()
        return rows.select(F.lit(kind).alias("kind"), F.col(column).alias("id"), F.concat_ws(" ", *note).alias("note"))

    refreshed = F.when(F.col("last_comment_refresh_at").isNull(), "not refreshed").otherwise("refreshed")
    parts = [
        table("posts", "post", "source_entity_id", F.lit("author"), F.coalesce("author_entity_id", F.lit("none"))),
        table("authors", "author", "source_entity_id", "display_name"),
        table("comments", "comment", "source_entity_id", "post_entity_id"),
        table("crawl_errors", "error", "url", "error_message"),
        table("url_state", "url", "url", "kind", "seed_name", F.col("last_status").cast("string")),
        table("item_state", "item", "source_entity_id", refreshed),
        run.select(F.lit("run").alias("kind"), F.col("status").alias("id"), F.concat_ws(" ", *[F.col(c).cast("string") for c in RUN_COUNTERS]).alias("note")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("crawl_cycle", _CYCLE_SQL)
def crawl_cycle(t: Tables) -> DataFrame:
    """A whole cycle over pages captured once."""
    return _cycle_result(t, run_dir(t.spark, "crawl-cycle"), *_cycle_input(t))


@query("crawl_cycle_recaptured", _CYCLE_SQL)
def crawl_cycle_recaptured(t: Tables) -> DataFrame:
    """The same cycle where every page was also captured a day before, blocked, and is captured again
    after the cycle's time, and every fifth capture is stored twice."""
    seeds, captured = _cycle_input(t)
    day = F.expr("INTERVAL 1 DAY")
    before = captured.withColumns({"fetched_at": F.col("fetched_at") - day, "status_code": F.lit(403), "text": F.lit("captcha")})
    after = captured.withColumns({"fetched_at": F.lit("2024-06-02").cast("timestamp"), "text": F.lit("")})
    again = captured.where(F.pmod(F.xxhash64("url"), F.lit(5)) == 0)
    captures = before.unionByName(after).unionByName(again).unionByName(captured)
    return _cycle_result(t, run_dir(t.spark, "crawl-cycle"), seeds, captures)


@query("item_state_cycle", _CYCLE_SQL)
def item_state_cycle(t: Tables) -> DataFrame:
    """A cycle that fails once its posts are stored, and its repetition under the same batch id."""
    return _cycle_result(t, run_dir(t.spark, "crawl-cycle"), *_cycle_input(t), attempts=(_NoComments(), forum))


@query(
    "crawl_cycle_failed",
    f"""
WITH p AS (SELECT page_id, page_id % 6 AS shape, {_SHAPES} AS good, {_TASK_URL} AS url, {_THREAD_URL} AS thread FROM pages),
facts AS (SELECT (SELECT count(*) FROM p) AS pages, (SELECT count(*) FROM p WHERE good) AS posts, (SELECT count(*) FROM p WHERE shape IN (0, 1)) AS authors)
SELECT 'post' AS kind, CAST(page_id + 1000000 AS VARCHAR) AS id, 'author ' || CASE WHEN shape IN (0, 1) AND page_id > 0 THEN CAST(page_id AS VARCHAR) ELSE 'none' END AS note FROM p WHERE good
UNION ALL SELECT 'author', CASE WHEN page_id > 0 THEN CAST(page_id AS VARCHAR) ELSE 'unknown' END, 'n' || page_id FROM p WHERE shape IN (0, 1)
UNION ALL SELECT 'error', url, 'Could not parse post payload from ' || url FROM p WHERE NOT good
UNION ALL SELECT 'url', url, 'fetch_post s-' || url || ' 200' FROM p
UNION ALL SELECT 'url', thread, 'refresh_comments s-' || url FROM p WHERE good
UNION ALL SELECT 'item', CAST(page_id + 1000000 AS VARCHAR), 'not refreshed' FROM p WHERE good
UNION ALL SELECT 'run', 'failed', concat_ws(' ', pages, pages + posts, pages, posts, 0, authors, 0, pages - posts + 1, 0) FROM facts""",
)
def crawl_cycle_failed(t: Tables) -> DataFrame:
    """A cycle that fails at its comments: what was done before is stored and counted, with one error more."""
    return _cycle_result(t, run_dir(t.spark, "crawl-cycle"), *_cycle_input(t), attempts=(_NoComments(),))
