"""URL predicates, extractors and builders, and video/space target parsing."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.text import is_blank, non_empty, strip

# Site addresses, parts of their URLs, and identifier patterns.
FORUM_BASE = "https://xueqiu.com"
VIDEO_WEB_BASE = "https://www.bilibili.com"
VIDEO_API_BASE = "https://api.bilibili.com"
SPACE_BASE = "https://space.bilibili.com"
COMMENTS_TEMPLATE = "https://xueqiu.com/statuses/comments.json?id={post_id}&count={page_size}&page={page}"
STOCK_PATH, TOPIC_PATH, USER_PATH = "/S/", "/k?q=", "/u/"
TIMELINE_PATH = "/statuses/stock_timeline.json?symbol_id="
TIMELINE_REST = "&count={count}&source=all&sort=time&page={page}"
SEARCH_PATH = "/query/v1/symbol/search/status.json?count={count}&comment=0&symbol="
SEARCH_REST = "&hl=0&source=all&sort=time&page={page}&q=&type=90"
VIDEO_COMMENTS_PATH = "/x/v2/reply/main?oid="
VIDEO_COMMENTS_REST = "&type=1&mode={mode}&pn=1&ps={page_size}&next=0"
POST_URL = r"https://xueqiu\.com/\d+/\d+"
POST_ID = r"/(\d{6,})/?$"
BVID = r"(?i)(BV[a-zA-Z0-9]{10})"
BARE_AV = r"(?i)^av(\d+)$"
VIDEO_PATH = r"(?i)bilibili\.com/video/([^/?#]+)"
ANY_AV = r"(?i)(?:^|/)av(\d+)(?:$|[/?#])"
DEFAULT_PORT = r"^(https://[^/]*):443$|^(http://[^/]*):80$"
SPACE_MID = r"(?i)space\.bilibili\.com/(\d+)"


def _origin(base_url: str) -> str:
    parts = urlsplit(base_url)
    return f"{parts.scheme}://{parts.netloc}"


def _first(c: Column, pattern: str) -> Column:
    return non_empty(F.regexp_extract(c, pattern, 1))


def url_path(url: Column) -> Column:
    """Path without query, fragment and trailing `;params`. Lenient, unlike parse_url."""
    path = F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    # Only the last segment's parameters go; no pattern, so that many semicolons cost no more than few.
    last = F.substring_index(path, "/", -1)
    return F.concat(F.left(path, F.length(path) - F.length(last)), F.substring_index(last, ";", 1))


def url_origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)


def extract_post_id(url: Column) -> Column:
    return _first(url_path(url), POST_ID)


def normalize_url(url: Column) -> Column:
    """Drop all trailing slashes."""
    return F.rtrim(url, F.lit("/"))


def http_url(url: Column) -> Column:
    """Canonical text of a task URL: lower-case scheme and host, no default port, at least the path `/`."""
    head = url_origin(url)
    tail = F.substr(url, F.length(head) + 1)
    slash = F.when(tail.startswith("/"), F.lit("")).otherwise(F.lit("/"))
    origin = F.regexp_replace(F.lower(head), DEFAULT_PORT, "$1$2")
    return F.concat(origin, slash, tail)


def is_post_url(url: Column, pattern: str = POST_URL) -> Column:
    return normalize_url(url).rlike(rf"\A(?:{pattern})\z")


def quote(c: Column) -> Column:
    """Percent-encode keeping `/`, with `%20` for a space."""
    encoded = F.url_encode(c)
    # url_encode writes the form encoding; these four differ.
    for form, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        encoded = F.replace(encoded, F.lit(form), F.lit(plain))
    return encoded


def stock_url(stock_id: Column, base_url: str = FORUM_BASE) -> Column:
    return F.concat(F.lit(_origin(base_url) + STOCK_PATH), stock_id)


def stock_timeline_url(stock_id: Column, base_url: str = FORUM_BASE, page: int = 1, count: int = 20) -> Column:
    return F.concat(
        F.lit(_origin(base_url) + TIMELINE_PATH),
        quote(stock_id),
        F.lit(TIMELINE_REST.format(count=count, page=page)),
    )


def stock_search_url(stock_id: Column, base_url: str = FORUM_BASE, page: int = 1, count: int = 20) -> Column:
    return F.concat(
        F.lit(_origin(base_url) + SEARCH_PATH.format(count=count)),
        quote(stock_id),
        F.lit(SEARCH_REST.format(page=page)),
    )


def topic_url(topic_id: Column, base_url: str = FORUM_BASE) -> Column:
    return F.concat(F.lit(_origin(base_url) + TOPIC_PATH), quote(topic_id))


def user_url(user_id: Column, base_url: str = FORUM_BASE) -> Column:
    return F.concat(F.lit(_origin(base_url) + USER_PATH), user_id)


def forum_comments_url(post_id: Column, template: str = COMMENTS_TEMPLATE, page_size: int = 20, page: int = 1) -> Column:
    head, tail = template.replace("{page_size}", str(page_size)).replace("{page}", str(page)).split("{post_id}")
    return F.concat(F.lit(head), post_id, F.lit(tail))


def video_comments_url(aid: Column, api_base: str = VIDEO_API_BASE, mode: int = 3, page_size: int = 30) -> Column:
    return F.concat(
        F.lit(api_base.rstrip("/") + VIDEO_COMMENTS_PATH),
        quote(aid),
        F.lit(VIDEO_COMMENTS_REST.format(mode=mode, page_size=page_size)),
    )


def comment_permalink(canonical_url: Column, rpid: Column) -> Column:
    return F.concat(canonical_url, F.lit("#reply"), rpid)


def extract_bvid(value: Column) -> Column:
    return _first(value, BVID)


def extract_aid(value: Column) -> Column:
    text = strip(value)
    return F.coalesce(
        _first(text, BARE_AV),
        _first(F.regexp_extract(text, VIDEO_PATH, 1), BARE_AV),
        _first(text, ANY_AV),
    ).try_cast("bigint")


def video_url(bvid: Column, web_base: str = VIDEO_WEB_BASE) -> Column:
    return F.concat(F.lit(f"{web_base.rstrip('/')}/video/"), bvid)


def parse_video_target(value: Column, web_base: str = VIDEO_WEB_BASE) -> Column:
    """struct(canonical_url, bvid, aid); the BV id wins; null when neither is found."""
    bvid = extract_bvid(value)
    aid = F.when(bvid.isNull(), extract_aid(value))
    target = F.coalesce(bvid, F.concat(F.lit("av"), aid.cast("string")))
    found = F.struct(video_url(target, web_base).alias("canonical_url"), bvid.alias("bvid"), aid.alias("aid"))
    return F.when(target.isNotNull(), found)


def parse_space_mid(value: Column) -> Column:
    text = strip(value)
    return F.coalesce(_first(text, SPACE_MID), F.when(~is_blank(text) & text.rlike(r"^\d+$"), text))


def space_url(mid: Column) -> Column:
    return F.concat(F.lit(f"{SPACE_BASE}/"), mid)
