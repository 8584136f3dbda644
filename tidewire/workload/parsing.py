"""Page and payload extraction over the test tables.

The pages table has no article markup, so article pages are made from each page by prepending
meta tags and script blocks derived from its row; the original HTML stays inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import html as H
from tidewire.functions import payloads as J
from tidewire.functions import times
from tidewire.functions import urls as U
from tidewire.functions.staging import compute_once
from tidewire.functions.text import strip_html
from tidewire.sources import forum, video
from tidewire.workload import views as V
from tidewire.workload.reading import _WS
from tidewire.workload.registry import Tables, query

# The entities that occur in the pages table.
_ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&"))


def _stripped(column: str) -> str:
    text = f"regexp_replace({column}, '<[^>]+>', ' ', 'g')"
    for entity, char in _ENTITIES:
        text = f"replace({text}, '{entity}', '{char}')"
    return f"trim(regexp_replace({text}, '{_WS}', ' ', 'g'))"


@query("html_strip", f"SELECT page_id, {_stripped('html')} AS text FROM pages")
def html_strip(t: Tables) -> DataFrame:
    return t.pages.select("page_id", strip_html(F.col("html")).alias("text"))


@query(
    "page_links",
    """SELECT DISTINCT page_id, rtrim(link, '/') AS link FROM (
SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]+)"', 1)) AS link FROM pages)""",
)
def page_links(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.explode(H.page_links(F.col("html"), '/[^"]+')).alias("link"))


def _pid(t: Tables):
    return F.col("page_id").cast("string")


def article_pages(t: Tables) -> DataFrame:
    """One article page per row of pages, of six shapes by page_id."""
    pid = _pid(t)
    shape = F.col("page_id") % 6
    json_user = F.concat(
        F.lit('<script type="application/json"> {"user": {"id": '), pid,
        F.lit(', "name": "n'), pid, F.lit('", "screen_name": ""}, "article": {"description": "json '), pid,
        F.lit('", "like_count": '), pid, F.lit(', "comment_count": 3, "retweet_count": 4}} </script>'),
    )
    json_later = F.lit('<script>{"article": {"content": "later", "comment_count": null}}</script><script>{broken}</script>')
    meta = F.concat(
        F.lit('<meta property="og:title" content="first"><META name="og:title" content="T'), pid,
        F.lit('"><meta property="article:published_time" content="2024-03-01T10:00:00+08:00">'
              '<meta name="og:locale" content="zh_CN"><meta name="description" content="About <b>p</b> &amp; '), pid, F.lit('">'),
    )
    body = F.concat(F.lit('<div id="x" class="big article__bd">Body <b>'), pid, F.lit("</b>&nbsp;end</div>"))
    empty = F.lit('<div data-testid="article-content"> </div>')
    stamp = F.concat(F.lit('<time class="t" datetime="2024-02-0'), (F.col("page_id") % 9 + 1).cast("string"), F.lit(' 08:30">'))
    none = F.lit("")
    prefix = (
        F.when(shape == 0, F.concat(meta, json_user, body))
        .when(shape == 1, F.concat(json_user, json_later, stamp))
        .when(shape == 2, F.concat(meta, stamp))
        .when(shape == 3, F.concat(json_user, empty))
        .when(shape == 4, F.concat(stamp, body))
        .otherwise(none)
    )
    return t.pages.select(
        F.concat(F.lit("https://xueqiu.com/"), pid, F.lit("/"), (F.col("page_id") + 1000000).cast("string"), F.lit("?x=1#c")).alias("url"),
        F.concat(prefix, F.col("html")).alias("text"),
        F.lit("2024-06-01").cast("timestamp").alias("fetched_at"),
    )


_HTML_TITLE = _stripped(r"regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")


@query(
    "page_meta",
    """SELECT page_id, unnest(['og:title', 'article:published_time', 'og:locale', 'description']) AS name,
  unnest(['T' || page_id, '2024-03-01T10:00:00+08:00', 'zh_CN', 'About <b>p</b> &amp; ' || page_id]) AS content
FROM pages WHERE page_id % 6 IN (0, 2)""",
)
def page_meta(t: Tables) -> DataFrame:
    pages = article_pages(t).withColumn("page_id", U.extract_post_id(F.col("url")).cast("bigint") - 1000000)
    return pages.select("page_id", F.explode(H.meta_map(F.col("text"))).alias("name", "content"))


@query(
    "page_json",
    """SELECT page_id, b AS block, CASE WHEN b = 0 THEN page_id END AS user_id FROM (
SELECT page_id, unnest(CASE page_id % 6 WHEN 1 THEN [0, 1] ELSE [0] END) AS b FROM pages WHERE page_id % 6 IN (0, 1, 3))""",
)
def page_json(t: Tables) -> DataFrame:
    pages = article_pages(t).withColumn("page_id", U.extract_post_id(F.col("url")).cast("bigint") - 1000000)
    blocks = pages.select("page_id", F.posexplode(H.embedded_json(F.col("text"))).alias("block", "_json"))
    return blocks.select("page_id", "block", J.field(F.col("_json"), "user.id", "bigint").alias("user_id"))


@query(
    "page_extract",
    f"""WITH p AS (SELECT *, page_id % 6 AS s FROM pages)
SELECT CAST(page_id + 1000000 AS VARCHAR) AS source_entity_id,
  'https://xueqiu.com/' || page_id || '/' || (page_id + 1000000) || '?x=1#c' AS canonical_url,
  CASE WHEN s IN (0, 1, 3) THEN nullif(CAST(page_id AS VARCHAR), '0') END AS author_entity_id,
  CASE WHEN s IN (0, 2) THEN 'T' || page_id ELSE {_HTML_TITLE} END AS title,
  CASE s WHEN 0 THEN 'Body ' || page_id || ' end' WHEN 1 THEN 'later' WHEN 2 THEN 'About p & ' || page_id
    WHEN 4 THEN 'Body ' || page_id || ' end' END AS content_text,
  CASE WHEN s IN (0, 2) THEN 'zh_CN' END AS language,
  CASE WHEN s IN (0, 2) THEN TIMESTAMP '2024-03-01 02:00:00' ELSE TIMESTAMP '2024-02-01 08:30:00' + to_days(CAST(page_id % 9 AS INTEGER)) END AS published_at,
  CASE WHEN s IN (0, 1) THEN page_id END AS like_count, CASE WHEN s = 0 THEN 3 END AS comment_count,
  CASE WHEN s IN (0, 1) THEN 4 END AS repost_count,
  CASE WHEN s IN (0, 1) THEN 'n' || page_id END AS author_name,
  CASE WHEN s IN (0, 1) THEN 'https://xueqiu.com/u/' || nullif(CAST(page_id AS VARCHAR), '0') END AS profile_url
FROM p WHERE s IN (0, 1, 2, 4)""",
)
def page_extract(t: Tables) -> DataFrame:
    rows = H.extract_articles(article_pages(t)).where("post is not null")
    return rows.select(
        *[f"post.{c}" for c in ("source_entity_id", "canonical_url", "author_entity_id", "title", "content_text",
                                "language", "published_at", "like_count", "comment_count", "repost_count")],
        F.col("author.display_name").alias("author_name"),
        "author.profile_url",
    )


@query(
    "timeline_urls",
    """SELECT DISTINCT o_orderkey, link FROM (SELECT o_orderkey, unnest([
  'https://xueqiu.com/' || o_custkey || '/' || o_orderkey, 'https://xueqiu.com/' || (o_custkey + 1000000) || '/' || (o_orderkey + 1),
  'https://xueqiu.com/7/' || o_orderkey]) AS link FROM orders WHERE o_orderkey > 0
UNION ALL SELECT 0, unnest(['https://xueqiu.com/' || (o_custkey + 1000000) || '/1', 'https://xueqiu.com/7/0']) FROM orders WHERE o_orderkey = 0)""",
)
def timeline_urls(t: Tables) -> DataFrame:
    """Per order a payload with a record, a nested retweet without user_id, and links of which one is relative."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    retweet = F.struct((key + 1).alias("id"), F.struct((cust + 1000000).alias("id")).alias("user"))
    record = F.struct(
        key.alias("id"),
        cust.alias("user_id"),
        F.lit("/1/2").alias("target"),
        F.concat(F.lit("https://xueqiu.com/7/"), key.cast("string"), F.lit("/")).alias("url"),
        retweet.alias("retweeted_status"),
    )
    payload = F.to_json(F.struct(F.lit("https://xueqiu.com/9/9").alias("url"), F.struct(F.array(record).alias("list")).alias("data")))
    return t.orders.select("o_orderkey", F.explode(J.timeline_links(payload)).alias("link"))


@query(
    "comment_payload_flatten",
    f"""WITH c AS ({V.COMMENTS_SQL})
SELECT source, source_entity_id, post_entity_id, author_entity_id, parent_comment_entity_id,
  trim(regexp_replace(content_text, '{_WS}', ' ', 'g')) AS content_text, published_at, like_count, pos FROM (
SELECT source, source_entity_id, post_entity_id, author_entity_id, parent_comment_entity_id, '<p>' || content_text || '</p> &lt;b&gt;' AS raw,
  content_text || ' <b>' AS content_text, published_at, length(author_entity_id) AS like_count, 0 AS pos FROM c
UNION ALL SELECT source, source_entity_id || '+', post_entity_id, NULL, '0', NULL, 'described', TIMESTAMP '2026-04-14 20:15:07', NULL, 3 FROM c)""",
)
def comment_payload_flatten(t: Tables) -> DataFrame:
    """One payload per turn: the turn, a record without id, one without text, and a described one."""
    schema_null = F.lit(None).cast("string")

    def record(cid, text, described, at, parent, author, likes):
        return F.struct(
            cid.alias("id"), text.alias("text"), described.alias("description"), at.alias("created_at"),
            parent.alias("reply_id"), F.struct(author.alias("id")).alias("user"), likes.alias("like_count"),
        )

    at = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    cid = F.col("source_entity_id")
    markup = F.concat(F.lit("<p>"), F.col("content_text"), F.lit("</p> &lt;b&gt;"))
    first = F.to_json(record(cid, markup, schema_null, at, F.col("parent_comment_entity_id"),
                             F.col("author_entity_id"), F.length("author_entity_id")))
    no_id = F.to_json(record(schema_null, F.lit("x"), schema_null, at, schema_null, schema_null, F.lit(1)))
    no_text = F.to_json(record(cid, F.lit("<br>"), schema_null, at, schema_null, schema_null, F.lit(1)))
    described = F.to_json(record(F.concat(cid, F.lit("+")), F.lit(""), F.lit("described"), F.lit(1776197707000),
                                 F.lit(0), schema_null, F.lit(None).cast("int")))
    payloads = V.comments(t).select(
        "post_entity_id",
        F.concat(F.lit('{"comments":[],"list":['), F.concat_ws(",", first, no_id, no_text, described, F.lit("7")),
                 F.lit("]}")).alias("text"),
        F.lit("2024-06-01").cast("timestamp").alias("fetched_at"),
    )
    return forum.flatten_comments(payloads).drop("canonical_url", "fetched_at")


@query(
    "reply_payload_flatten",
    f"""WITH c AS ({V.COMMENTS_SQL}), r AS (
SELECT *, CAST(split_part(source_entity_id, ':', 2) AS BIGINT) AS turn FROM c)
SELECT CAST(post_entity_id AS BIGINT) * 100 + turn || '' AS source_entity_id, post_entity_id,
  'https://www.bilibili.com/video/av' || post_entity_id || '#reply' || (CAST(post_entity_id AS BIGINT) * 100 + turn) AS canonical_url,
  author_entity_id, CASE WHEN turn > 1 THEN CAST(turn // 2 AS VARCHAR) END AS parent_comment_entity_id,
  regexp_replace(content_text, '^{_WS}|{_WS}$', '', 'g') AS content_text,
  TIMESTAMP '2024-01-01' + to_seconds(turn) AS published_at, turn AS like_count
FROM r WHERE post_entity_id NOT LIKE '%7' OR author_entity_id = 'user'""",
)
def reply_payload_flatten(t: Tables) -> DataFrame:
    """One payload per turn; posts ending in 7 have a known owner."""
    turn = F.split_part("source_entity_id", F.lit(":"), F.lit(2)).cast("bigint")
    post = F.col("post_entity_id")
    reply = F.struct(
        (post.cast("bigint") * 100 + turn).alias("rpid"),
        F.floor(turn / 2).alias("parent"),
        turn.cast("string").alias("like"),
        (F.lit(1704067200) + turn).alias("ctime"),
        F.struct(F.col("author_entity_id").alias("mid")).alias("member"),
        F.struct(F.concat(F.lit(" "), F.col("content_text"), F.lit("\n")).alias("message")).alias("content"),
    )
    blank = F.to_json(F.struct(F.lit(1).alias("rpid"), F.struct(F.lit(" ").alias("message")).alias("content")))
    payloads = V.comments(t).select(
        post,
        F.concat(F.lit("https://www.bilibili.com/video/av"), post).alias("canonical_url"),
        (turn > 0).alias("is_reply"),
        F.when(post.endswith("7"), "user").alias("owner_mid"),
        F.lit("2024-06-01").cast("timestamp").alias("fetched_at"),
        F.concat(F.lit('{"code":0,"data":{"replies":[null,'), F.to_json(reply), F.lit(","), blank, F.lit("]}}")).alias("text"),
    )
    return video.flatten_replies(payloads).drop("source", "fetched_at", "pos")


def video_payloads(t: Tables) -> DataFrame:
    """One video info payload per part; a description only on even keys, no BV id on every tenth."""
    key = F.col("p_partkey")
    data = F.struct(
        (key + 1).alias("aid"),
        F.when(key % 10 != 0, F.concat(F.lit("BV"), F.lpad(key.cast("string"), 10, "0"))).alias("bvid"),
        F.col("p_name").alias("title"),
        F.when(key % 2 == 0, F.col("p_brand")).otherwise("").alias("desc"),
        (F.lit(1700000000) + key).alias("pubdate"),
        F.struct(F.when(key % 7 != 0, key * 3).alias("mid"), F.col("p_type").alias("name")).alias("owner"),
        F.struct(F.col("p_size").alias("like"), F.lit("n/a").alias("reply"), F.col("p_size").cast("string").alias("share")).alias("stat"),
    )
    return t.part.select(
        F.to_json(F.struct(F.lit(0).alias("code"), data.alias("data"))).alias("text"),
        F.lit("2024-06-01").cast("timestamp").alias("fetched_at"),
    )


def _video_data(t: Tables) -> DataFrame:
    parsed = compute_once(video_payloads(t), {"data": J.field(J.parse(F.col("text")), "data", "variant")})
    return parsed.select("fetched_at", "data")


@query(
    "video_payload_posts",
    """SELECT CAST(p_partkey + 1 AS VARCHAR) AS source_entity_id, 'https://www.bilibili.com/video/BV' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS canonical_url,
  CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_partkey * 3 AS VARCHAR) END AS author_entity_id, p_name AS title,
  CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_name END AS content_text, make_timestamp((1700000000 + p_partkey) * 1000000) AS published_at,
  CAST(p_size AS BIGINT) AS like_count, CAST(NULL AS BIGINT) AS comment_count, CAST(p_size AS BIGINT) AS repost_count
FROM part WHERE p_partkey % 10 <> 0""",
)
def video_payload_posts(t: Tables) -> DataFrame:
    posts = compute_once(_video_data(t), {"post": video.post_struct(F.col("data"), F.col("fetched_at"))})
    return posts.where(video.is_complete(F.col("post"))).select("post.*").drop("source", "language", "fetched_at", "raw_topic_ids")


@query(
    "video_payload_authors",
    """SELECT CAST(p_partkey * 3 AS VARCHAR) AS source_entity_id, p_type AS display_name, 'https://space.bilibili.com/' || (p_partkey * 3) AS profile_url
FROM part WHERE p_partkey % 7 <> 0""",
)
def video_payload_authors(t: Tables) -> DataFrame:
    authors = compute_once(_video_data(t), {"a": video.author_struct(F.col("data"), F.col("fetched_at"))})
    return authors.where("a.source_entity_id is not null").select("a.source_entity_id", "a.display_name", "a.profile_url")


@query(
    "url_ids",
    r"""WITH u AS (
SELECT page_id * 3 AS n, url FROM pages
UNION ALL SELECT page_id * 3 + 1, 'https://xueqiu.com/' || page_id || '/' || (page_id + 999900) || CASE WHEN page_id % 2 = 0 THEN '//' ELSE '' END FROM pages
UNION ALL SELECT page_id * 3 + 2, 'http://X.com/a/' || (page_id + 99900) || ';v=1?q=/1234567' FROM pages)
SELECT n, nullif(regexp_extract(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), ';[^/]*$', ''), '^https?://[^/]*', ''), '/(\d{6,})/?$', 1), '') AS post_id,
  regexp_matches(rtrim(url, '/'), '^https://xueqiu\.com/\d+/\d+$') AS is_post, rtrim(url, '/') AS normal FROM u""",
)
def url_ids(t: Tables) -> DataFrame:
    n, pid = F.col("page_id"), _pid(t)
    tail = F.when(n % 2 == 0, "//").otherwise("")
    made = F.array(
        F.struct((n * 3).alias("n"), F.col("url").alias("url")),
        F.struct((n * 3 + 1).alias("n"), F.concat(F.lit("https://xueqiu.com/"), pid, F.lit("/"), (n + 999900).cast("string"), tail).alias("url")),
        F.struct((n * 3 + 2).alias("n"), F.concat(F.lit("http://X.com/a/"), (n + 99900).cast("string"), F.lit(";v=1?q=/1234567")).alias("url")),
    )
    url = F.col("url")
    return t.pages.select(F.inline(made)).select(
        "n", U.extract_post_id(url).alias("post_id"), U.is_post_url(url).alias("is_post"), U.normalize_url(url).alias("normal")
    )


@query(
    "video_targets",
    r"""WITH v AS (
SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS z, CAST(p_partkey AS VARCHAR) AS k, p_partkey % 9 AS s FROM part),
w AS (SELECT p_partkey, s, z, CASE s WHEN 0 THEN ' bv' || z || ' ' WHEN 1 THEN 'https://www.bilibili.com/video/BV' || z || '?p=1'
  WHEN 2 THEN 'AV' || k WHEN 3 THEN 'https://m.bilibili.com/video/av' || k || '/' WHEN 4 THEN 'x/av' || k || '#r' WHEN 5 THEN 'not-a-video'
  WHEN 6 THEN 'https://space.bilibili.com/' || k || '/video' WHEN 7 THEN ' ' || k || ' ' ELSE '  ' END AS target, p_partkey AS aid0 FROM v)
SELECT p_partkey, target, CASE WHEN s = 0 THEN 'bv' || z WHEN s = 1 THEN 'BV' || z END AS bvid,
  CASE WHEN s IN (2, 3, 4) THEN aid0 END AS aid,
  CASE WHEN s = 0 THEN 'https://www.bilibili.com/video/bv' || z WHEN s = 1 THEN 'https://www.bilibili.com/video/BV' || z
    WHEN s IN (2, 3, 4) THEN 'https://www.bilibili.com/video/av' || aid0 END AS canonical_url,
  CASE WHEN s IN (6, 7) THEN CAST(aid0 AS VARCHAR) END AS space_mid FROM w""",
)
def video_targets(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    padded = F.lpad(key, 10, "0")
    shape = F.col("p_partkey") % 9
    target = (
        F.when(shape == 0, F.concat(F.lit(" bv"), padded, F.lit(" ")))
        .when(shape == 1, F.concat(F.lit("https://www.bilibili.com/video/BV"), padded, F.lit("?p=1")))
        .when(shape == 2, F.concat(F.lit("AV"), key))
        .when(shape == 3, F.concat(F.lit("https://m.bilibili.com/video/av"), key, F.lit("/")))
        .when(shape == 4, F.concat(F.lit("x/av"), key, F.lit("#r")))
        .when(shape == 5, "not-a-video")
        .when(shape == 6, F.concat(F.lit("https://space.bilibili.com/"), key, F.lit("/video")))
        .when(shape == 7, F.concat(F.lit(" "), key, F.lit(" ")))
        .otherwise("  ")
    )
    rows = t.part.select("p_partkey", target.alias("target"))
    parsed = compute_once(rows, {"_t": U.parse_video_target(F.col("target"))})
    return parsed.select(
        "p_partkey", "target", "_t.bvid", "_t.aid", "_t.canonical_url", U.parse_space_mid(F.col("target")).alias("space_mid")
    )


@query(
    "url_builders",
    """WITH q AS (SELECT p_partkey, p_name || '/' || p_brand AS v, replace(replace(p_name, ' ', '%20') || '/' || p_brand, '#', '%23') AS e FROM part)
SELECT p_partkey, 'https://xueqiu.com/S/' || v AS stock, 'https://xueqiu.com/statuses/stock_timeline.json?symbol_id=' || e || '&count=20&source=all&sort=time&page=1' AS timeline,
  'https://xueqiu.com/query/v1/symbol/search/status.json?count=20&comment=0&symbol=' || e || '&hl=0&source=all&sort=time&page=1&q=&type=90' AS search,
  'https://xueqiu.com/k?q=' || e AS topic, 'https://xueqiu.com/u/' || p_partkey AS author,
  'https://xueqiu.com/statuses/comments.json?id=' || p_partkey || '&count=20&page=1' AS forum_comments,
  'https://api.bilibili.com/x/v2/reply/main?oid=' || p_partkey || '&type=1&mode=3&pn=1&ps=30&next=0' AS video_comments FROM q""",
)
def url_builders(t: Tables) -> DataFrame:
    value, key = F.concat("p_name", F.lit("/"), "p_brand"), F.col("p_partkey").cast("string")
    return t.part.select(
        "p_partkey",
        U.stock_url(value).alias("stock"),
        U.stock_timeline_url(value).alias("timeline"),
        U.stock_search_url(value).alias("search"),
        U.topic_url(value).alias("topic"),
        U.user_url(key).alias("author"),
        U.forum_comments_url(key).alias("forum_comments"),
        U.video_comments_url(key).alias("video_comments"),
    )


@query(
    "entity_keys",
    f"""WITH p AS ({V.POSTS_SQL}) SELECT source || ':' || source_entity_id AS entity_key,
  source || ':fetch_post:' || canonical_url AS task_key, canonical_url || '#reply' || source_entity_id AS permalink FROM p""",
)
def entity_keys(t: Tables) -> DataFrame:
    from tidewire.functions.text import entity_key, task_key

    source, eid, url = F.col("source"), F.col("source_entity_id"), F.col("canonical_url")
    return V.posts(t).select(
        entity_key(source, eid).alias("entity_key"),
        task_key(source, F.lit("fetch_post"), url).alias("task_key"),
        U.comment_permalink(url, eid).alias("permalink"),
    )


@query(
    "lenient_times",
    """WITH e AS (SELECT event_id, date_trunc('second', ts) AS s, event_id % 8 AS k FROM events)
SELECT event_id, CASE k WHEN 0 THEN s WHEN 1 THEN s - INTERVAL 8 HOUR WHEN 2 THEN s WHEN 3 THEN date_trunc('day', s)
  WHEN 4 THEN s WHEN 5 THEN s END AS lenient, CASE WHEN k IN (4, 7) THEN CASE k WHEN 4 THEN s ELSE TIMESTAMP '1970-01-01' END END AS epoch FROM e""",
)
def lenient_times(t: Tables) -> DataFrame:
    """ISO with Z and offset, plain, date only, seconds, milliseconds, junk and zero."""
    shape = F.col("event_id") % 8
    s = F.date_trunc("second", F.col("ts").cast("timestamp"))
    seconds = F.unix_seconds(s)
    made = (
        F.when(shape == 0, F.date_format(s, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(shape == 1, F.concat(F.date_format(s, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")))
        .when(shape == 2, F.date_format(s, "yyyy-MM-dd HH:mm:ss"))
        .when(shape == 3, F.date_format(s, "yyyy-MM-dd"))
        .when(shape == 6, F.lit("soon"))
    )
    number = F.when(shape == 4, seconds).when(shape == 5, seconds * 1000).when(shape == 7, 0)
    rows = t.events.select("event_id", made.alias("_s"), number.alias("_n"), shape.alias("_k"))
    return rows.select(
        "event_id",
        F.coalesce(times.lenient_text_time(F.col("_s")), times.lenient_number_time(F.col("_n"))).alias("lenient"),
        times.epoch_seconds(F.when(F.col("_k") != 5, F.col("_n")).cast("string")).alias("epoch"),
    )


@query(
    "fetch_outcome_classes",
    """WITH e AS (SELECT event_id, 'https://e.example/' || user_id AS url, event_id % 7 AS k,
  CASE event_id % 7 WHEN 1 THEN 403 WHEN 2 THEN 0 ELSE 200 END AS st FROM events)
SELECT event_id, k NOT IN (0, 2) AS blocked, CASE WHEN k = 0 THEN NULL
  WHEN k = 2 THEN 'Fetch failed for ' || url || ': dial tcp' || CASE WHEN event_id % 2 = 0 THEN ' via http://p' ELSE '' END
  ELSE 'Blocked response from ' || url END AS error,
  CASE k WHEN 1 THEN 'HTTP 403' WHEN 2 THEN 'dial tcp' WHEN 3 THEN 'invalid JSON payload' WHEN 4 THEN 'API code -412: busy captcha' WHEN 5 THEN 'API code -1: API error -1'
    WHEN 6 THEN 'invalid JSON payload' END AS api_message, k IN (1, 4) AS api_blocked, k IN (1, 4) AS message_blocked FROM e""",
)
def fetch_outcome_classes(t: Tables) -> DataFrame:
    k = F.col("event_id") % 7
    pages = t.events.select(
        "event_id",
        F.concat(F.lit("https://e.example/"), F.col("user_id").cast("string")).alias("url"),
        F.when(k == 1, 403).when(k == 2, 0).otherwise(200).alias("status_code"),
        F.when(k == 0, '{"code":0}').when(k == 1, '{"code":0}').when(k == 3, " \n")
        .when(k == 4, '{"code":-412,"msg":"busy captcha"}').when(k == 5, '{"renderData":1}')
        .when(k == 6, "<html>_waf_</html>").alias("text"),
        F.when(k == 2, "dial tcp").alias("error_message"),
        F.when(F.col("event_id") % 2 == 0, "http://p").alias("proxy_url"),
    )
    return video.with_call(forum.classify(pages)).select(
        "event_id", "blocked", "error",
        F.col("call_message").alias("api_message"),
        F.col("call_blocked").alias("api_blocked"),
        video.message_is_blocked(F.col("call_message")).alias("message_blocked"),
    )
