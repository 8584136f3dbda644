"""Video adapter: seed expansion, API payload outcomes, space listings, replies, comment tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import payloads as J
from tidewire.functions import urls as U
from tidewire.functions.staging import compute_once
from tidewire.functions.text import is_blank, non_empty, strip
from tidewire.functions.times import epoch_seconds
from tidewire.operators.listing import cap_per_owner, first_seen, listing_ends, page_novelty
from tidewire.sources import forum
from tidewire.sources.forum import transport_error
from tidewire.sources.tasks import explode_values, metadata, task_rows

SOURCE = "bilibili"

# Task priorities and the statuses and codes that mean a block.
PRIORITY = {"space": 120, "discovered": 180, "video": 200, "comments": 300}
BLOCK_STATUS = (403, 412, 429)
BLOCK_CODE = -412
# Pages of one listing that are asked for at most.
MAX_PAGES = 1000
BLOCK_TEXT = r"\b(403|412|429)\b"


def expand(seeds: DataFrame, web_base: str = U.VIDEO_WEB_BASE) -> DataFrame:
    """Video and space targets to frontier tasks; unparsable targets are dropped."""
    rows = explode_values(seeds, {"video": F.col("bilibili_video_targets"), "space": F.col("bilibili_space_urls")})
    video, space = F.col("seed_kind") == "video", F.col("seed_kind") == "space"
    parsed = compute_once(
        rows,
        {
            "_target": F.when(video, U.parse_video_target(F.col("value"), web_base)),
            "_mid": F.when(space, U.parse_space_mid(F.col("value"))),
        },
    ).where("_target is not null or _mid is not null")
    meta = metadata(
        video_target=F.when(video, F.col("value")),
        bvid=F.col("_target.bvid"),
        aid=F.col("_target.aid"),
        seed_kind=F.when(space, "space"),
        mid=F.col("_mid"),
    )
    return task_rows(
        parsed.select(
            F.lit(SOURCE).alias("source"),
            F.when(video, "fetch_post").otherwise("discover").alias("kind"),
            F.coalesce("_target.canonical_url", U.space_url(F.col("_mid"))).alias("url"),
            "seed_name",
            F.when(video, PRIORITY["video"]).otherwise(PRIORITY["space"]).alias("priority"),
            meta.alias("metadata"),
            "pos",
        )
    )


def with_call(pages: DataFrame) -> DataFrame:
    """Add `_body` (the parsed payload), `call_message` (null means success) and `call_blocked`.

    Built in steps, so that the payload is parsed once however often it is read later.
    """
    body, code, status, transport = F.col("_body"), F.col("_code"), F.col("status_code"), non_empty(F.col("error_message"))
    parsed = compute_once(pages, {"_body": J.parse(F.col("text"))}).withColumn("_code", J.field(body, "code", "bigint"))
    known = F.coalesce(code, F.lit(-1))
    said = F.coalesce(J.first_text(body, "message", "msg"), F.concat(F.lit("API error "), known.cast("string")))
    http_error = F.coalesce(status >= 400, F.lit(False))
    message = (
        F.when(transport.isNotNull(), transport)
        .when(http_error, F.concat(F.lit("HTTP "), status.cast("string")))
        .when(~J.is_object(body), F.lit("invalid JSON payload"))
        .when(known != 0, F.concat(F.lit("API code "), known.cast("string"), F.lit(": "), said))
    )
    blocked = transport.isNull() & F.when(http_error, status.isin(*BLOCK_STATUS)).otherwise(known == BLOCK_CODE)
    return compute_once(parsed, {"call_message": message, "call_blocked": blocked}).drop("_code")


def message_is_blocked(message: Column) -> Column:
    """Block test on an error message of the listing client."""
    return F.coalesce(message.rlike(BLOCK_TEXT), F.lit(False))


def post_struct(data: Column, fetched_at: Column, web_base: str = U.VIDEO_WEB_BASE) -> Column:
    """Video payload to a post; `is_complete` tells whether it has ids and text."""
    return F.struct(
        F.lit(SOURCE).alias("source"),
        J.field(data, "aid").alias("source_entity_id"),
        U.video_url(J.first_text(data, "bvid"), web_base).alias("canonical_url"),
        J.field(data, "owner.mid").alias("author_entity_id"),
        J.field(data, "title").alias("title"),
        J.first_text(data, "desc", "title").alias("content_text"),
        F.lit(None).cast("string").alias("language"),
        epoch_seconds(J.field(data, "pubdate")).alias("published_at"),
        fetched_at.alias("fetched_at"),
        J.whole(J.field(data, "stat.like", "variant")).alias("like_count"),
        J.whole(J.field(data, "stat.reply", "variant")).alias("comment_count"),
        J.whole(J.field(data, "stat.share", "variant")).alias("repost_count"),
        F.array().cast("array<string>").alias("raw_topic_ids"),
    )


def is_complete(post: Column) -> Column:
    needed = ("source_entity_id", "canonical_url", "content_text")
    return reduce(lambda a, b: a & b, [post[c].isNotNull() for c in needed])


def author_struct(data: Column, fetched_at: Column) -> Column:
    """Owner of a video payload; an author without id is none."""
    mid, name = J.field(data, "owner.mid"), J.field(data, "owner.name")
    return F.struct(
        F.lit(SOURCE).alias("source"),
        mid.alias("source_entity_id"),
        name.alias("username"),
        name.alias("display_name"),
        U.space_url(mid).alias("profile_url"),
        F.lit(None).cast("string").alias("bio"),
        F.lit(None).cast("bigint").alias("followers"),
        F.lit(None).cast("bigint").alias("following"),
        fetched_at.alias("fetched_at"),
    )


def with_page(tasks: DataFrame, captured: DataFrame) -> DataFrame:
    return forum.with_page(tasks, captured)


def parse(fetched: DataFrame, web_base: str = U.VIDEO_WEB_BASE) -> DataFrame:
    """Outcome of claimed video tasks joined with their payload; same columns as the forum's."""
    target = U.parse_video_target(F.coalesce(F.col("metadata")["video_target"], F.col("url")), web_base)
    data, post, author, url = F.col("_data"), F.col("_post"), F.col("_author"), F.col("url")
    called = with_call(fetched.withColumn("_known", target.isNotNull()))
    usable = F.col("_known") & F.col("call_message").isNull()
    read = called.withColumn("_data", F.when(usable, J.field(F.col("_body"), "data", "variant")))
    built = read.withColumn("_object", J.is_object(data)).withColumns(
        {
            "_post": post_struct(data, F.col("fetched_at"), web_base),
            "_author": author_struct(data, F.col("fetched_at")),
        }
    )
    good = F.col("_object") & is_complete(post)
    error = (
        F.when(~F.col("_known"), F.concat(F.lit("Could not parse Bilibili video target from "), url))
        .when(F.col("call_message").isNotNull(), transport_error(url, F.col("call_message"), F.col("proxy_url")))
        .when(~F.col("_object"), F.concat(F.lit("Could not parse video metadata from "), url))
        .when(~good, F.concat(F.lit("Could not normalize video payload from "), url))
    )
    return built.withColumns(
        {
            "post": F.when(good, post),
            "author": F.when(good & author["source_entity_id"].isNotNull(), author),
            "blocked": F.col("_known") & F.col("call_blocked"),
            "error": error,
            "links": F.lit(None).cast("array<string>"),
        }
    ).drop("_known", "_body", "_data", "_object", "_post", "_author", "call_message", "call_blocked", "text")


def _parsed(payloads: DataFrame) -> Column:
    """The payload as `with_call` parsed it, or parsed here."""
    return F.col("_body") if "_body" in payloads.columns else J.parse(F.col("text"))


def listing_rows(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Videos of space listing pages (`text`, `mid`, `page_no`, `section`), one row each.

    The section is `space` for the owner's own list, read at data.list.vlist, and `search` for
    search hits, a bare list of which only the owner's count.
    """
    body = F.col("_body")
    parsed = payloads.select(*keep, "mid", "page_no", "section", _parsed(payloads).alias("_body"))
    hits = F.try_variant_get(body, "$", "array<variant>")
    videos = F.when(F.col("section") == "search", hits).otherwise(J.elements(body, "data.list.vlist"))
    rows = parsed.select(*keep, "mid", "page_no", "section", F.posexplode(videos).alias("pos", "_v"))
    v = F.col("_v")
    mine = (F.col("section") != "search") | (J.field(v, "mid") == F.col("mid"))
    fields = compute_once(
        rows.where(J.is_object(v) & mine),
        {
            "_bvid": J.field(v, "bvid", "variant"),
            "_aid": J.whole(J.field(v, "aid", "variant")),
            "_published": J.whole(J.first_usable(v, "created", "pubdate")),
        },
    )
    # Only a JSON string counts as a video id.
    return fields.where(F.schema_of_variant("_bvid") == "STRING").select(
        *keep, "mid", "section", "page_no", "pos",
        F.try_variant_get("_bvid", "$", "string").alias("bvid"),
        F.when(F.col("_aid") > 0, F.col("_aid")).alias("aid"),
        F.when(F.col("_published") > 0, F.col("_published")).alias("pubdate_ts"),
    ).where("bvid <> ''")


def listing_order() -> list[Column]:
    """The owner's list before search hits, then page, then position."""
    return [(F.col("section") == "search").asc(), F.col("page_no"), F.col("pos")]


def space_videos(rows: DataFrame, max_per_section: int | None = None) -> DataFrame:
    """Distinct videos per owner, first seen wins; optionally capped per section, as the
    listing client does before the merge."""
    if max_per_section is not None:
        rows = cap_per_owner(rows, ["mid", "section"], listing_order(), max_per_section)
    return first_seen(rows, ["mid", "bvid"], listing_order())


def space_ends(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Per space `url`: last_page and read_to of the owner's list (see listing_ends).

    `pages` are called pages (`with_call`) with `mid`. The list ends before its first missing,
    failed or empty page and before one without new videos, and after the page with which as
    many distinct videos were seen as it announces in all.
    """
    own = pages.where((F.col("section") != "search") & F.col("page_no").between(1, max_pages))
    listed = own.where(F.col("call_message").isNull())
    fresh = page_novelty(listing_rows(listed, keep=("url",)), ["url"], "bvid", "page_no")
    facts = own.select(
        "url", "page_no", F.col("call_message").isNotNull().alias("_failed"),
        J.whole(J.field(F.col("_body"), "data.page.count", "variant")).alias("_total"),
    ).join(fresh.select("url", "page_no", "new_ids"), ["url", "page_no"], "left")
    # A listing has at most max_pages rows here.
    so_far = F.sum(F.coalesce("new_ids", F.lit(0))).over(Window.partitionBy("url").orderBy("page_no"))
    facts = facts.withColumn("_seen", so_far)
    dead = F.col("_failed") | (F.coalesce("new_ids", F.lit(0)) == 0)
    return listing_ends(facts, ["url"], dead=dead, final=F.coalesce(F.col("_seen") >= F.col("_total"), F.lit(False)), max_pages=max_pages)


def discover(
    tasks: DataFrame, captured: DataFrame, web_base: str = U.VIDEO_WEB_BASE, max_per_section: int | None = None,
    max_pages: int = MAX_PAGES,
) -> tuple[DataFrame, DataFrame]:
    """Outcomes of space tasks, and their listed videos as fetch_post tasks.

    A listing is read page by page to its end (see space_ends); where that is a failed page, its
    error is the task's error. Failed searches only yield nothing. `captured` has one capture a page.
    """
    mid = F.coalesce(F.col("metadata")["mid"], U.parse_space_mid(F.col("url")))
    space = tasks.withColumn("mid", mid)
    pages = with_call(space.select("url", "mid").join(captured, "url"))
    own = F.col("section") != "search"
    ends = space_ends(pages, max_pages)
    # The last page that was read; the struct's page number is what is compared.
    facts = F.struct("page_no", "status_code", F.col("call_message").alias("message"), F.col("call_blocked").alias("blocked"))
    read = pages.where(own).join(ends, "url").where(F.col("page_no") <= F.col("read_to"))
    calls = read.groupBy("url").agg(F.max(facts).alias("_last"))
    fault = F.col("_last.message")
    outcomes = space.join(calls, "url", "left").select(
        *tasks.columns,
        F.coalesce(F.col("_last.status_code"), F.lit(0)).alias("status_code"),
        F.coalesce(F.col("_last.blocked"), F.lit(False)).alias("blocked"),
        F.when(F.col("mid").isNull(), F.concat(F.lit("Could not parse Bilibili space mid from "), F.col("url")))
        .when(
            fault.isNotNull(),
            F.concat(
                F.lit("Fetch failed for space "), F.col("mid"), F.lit(" page "),
                F.col("_last.page_no").cast("string"), F.lit(": "), fault,
            ),
        )
        .when(F.col("_last").isNull(), F.concat(F.lit("Fetch failed for space "), F.col("mid"), F.lit(": no captured page")))
        .alias("error"),
    )
    kept = pages.where(own).join(ends, "url").where(F.col("page_no") <= F.col("last_page")).select(*pages.columns)
    # Hits are a bare list, which is no call that could fail with a code.
    answered = non_empty(F.col("error_message")).isNull() & F.coalesce(F.col("status_code") < 400, F.lit(True))
    good = kept.unionByName(pages.where(~own & answered))
    videos = space_videos(listing_rows(good), max_per_section)
    listed = videos.join(space.select("mid", F.struct(*tasks.columns).alias("parent")), "mid")
    # Position in the merged list, as a sortable number.
    page = F.shiftleft(F.col("page_no").cast("bigint"), 31)
    place = page + F.col("pos") + F.when(F.col("section") == "search", F.lit(1 << 62)).otherwise(F.lit(0).cast("bigint"))
    return outcomes, task_rows(listed.select(
        F.lit(SOURCE).alias("source"),
        F.lit("fetch_post").alias("kind"),
        U.video_url(F.col("bvid"), web_base).alias("url"),
        F.col("parent.seed_name").alias("seed_name"),
        F.lit(PRIORITY["discovered"]).alias("priority"),
        metadata(
            video_target=F.col("bvid"), bvid=F.col("bvid"), discovered_from=F.col("parent.url"),
            owner_mid=F.col("mid"), aid=F.col("aid"), pubdate_ts=F.col("pubdate_ts"),
        ).alias("metadata"),
        "parent",
        place.cast("bigint").alias("pos"),
    ))


def flatten_replies(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Comments of reply payloads (`text`, `post_entity_id`, `canonical_url`, `is_reply`,
    `owner_mid`, `fetched_at`); with a known owner only the owner's comments remain."""
    replies = J.elements(_parsed(payloads), "data.replies")
    known = list(dict.fromkeys([*keep, "post_entity_id", "canonical_url", "is_reply", "owner_mid", "fetched_at"]))
    r = F.col("_r")
    fields = compute_once(
        payloads.select(*known, F.posexplode(replies).alias("pos", "_r")).where(J.is_object(r)),
        {
            "_rpid": J.field(r, "rpid"),
            "_author": J.field(r, "member.mid"),
            "_parent": J.field(r, "parent"),
            "_message": J.field(r, "content.message"),
        },
    )
    rpid, author, parent, message = (F.col(c) for c in ("_rpid", "_author", "_parent", "_message"))
    mine = F.col("owner_mid").isNull() | F.coalesce(author == F.col("owner_mid"), F.lit(False))
    return fields.where(rpid.isNotNull() & ~is_blank(message) & mine).select(
        *keep,
        F.lit(SOURCE).alias("source"),
        rpid.alias("source_entity_id"),
        "post_entity_id",
        U.comment_permalink(F.col("canonical_url"), rpid).alias("canonical_url"),
        author.alias("author_entity_id"),
        F.when(F.col("is_reply") & (parent != "0"), parent).alias("parent_comment_entity_id"),
        strip(message).alias("content_text"),
        epoch_seconds(J.field(r, "ctime")).alias("published_at"),
        "fetched_at",
        J.whole(J.field(r, "like", "variant")).alias("like_count"),
        "pos",
    )


def comment_tasks(posts: DataFrame, api_base: str = U.VIDEO_API_BASE, mode: int = 3, page_size: int = 30) -> DataFrame:
    return posts.select(
        F.lit(SOURCE).alias("source"),
        F.lit("refresh_comments").alias("kind"),
        U.video_comments_url(F.col("source_entity_id"), api_base, mode, page_size).alias("url"),
        "seed_name",
        F.lit(PRIORITY["comments"]).alias("priority"),
        metadata(
            post_id=F.col("source_entity_id"), canonical_url=F.col("canonical_url"),
            owner_mid=F.col("author_entity_id"),
        ).alias("metadata"),
    )


def root_comment_ends(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Per `url`, how far its pages of root comments (called pages, section `main`) are read.

    They end before the first missing, failed or empty page and before one that has ids, all of
    them seen, and after the first page whose cursor says so; a page without a cursor is the last one.
    """
    body = F.col("_body")
    cursor_end = F.coalesce(J.field(body, "data.cursor.is_end", "boolean"), F.lit(True))
    cursor_next = F.coalesce(J.whole(J.field(body, "data.cursor.next", "variant")), F.lit(0))
    # Whether a page repeats is judged on all its ids, before any comment is dropped.
    ids = pages.where("call_message IS NULL").select("url", "page_no", F.explode(J.elements(body, "data.replies")).alias("_r"))
    fresh = page_novelty(ids.select("url", "page_no", J.field(F.col("_r"), "rpid").alias("rpid")), ["url"], "rpid", "page_no")
    facts = pages.select("url", "page_no", (cursor_end | (cursor_next <= 0)).alias("_final")).join(fresh, ["url", "page_no"], "left")
    dead = F.col("ids").isNull() | ((F.col("ids") > 0) & (F.col("new_ids") == 0))
    return listing_ends(facts, ["url"], dead=dead, final=F.col("_final"), max_pages=max_pages)


def reply_ends(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Per (`url`, `root_id`), how far the pages of answers to a root comment are read: to the
    first missing, failed or empty page, or through the first one whose cursor ends it or is absent."""
    body = F.col("_body")
    facts = pages.select(
        "url", "root_id", "page_no", F.coalesce(J.field(body, "data.cursor.is_end", "boolean"), F.lit(True)).alias("_final"),
        (F.col("call_message").isNotNull() | (F.size(J.elements(body, "data.replies")) <= 0)).alias("_empty"),
    )
    return listing_ends(facts, ["url", "root_id"], dead=F.coalesce("_empty", F.lit(True)), final=F.col("_final"), max_pages=max_pages)


def comments(tasks: DataFrame, captured: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Comments of refresh tasks, from root pages (`main`) and answer pages (`reply`).

    Both listings are read to their ends; answers are read for root comments only that were read
    themselves and say they have some. `captured` has one capture a page.
    """
    meta = F.col("metadata")
    pages = tasks.select(
        "url", meta["post_id"].alias("post_entity_id"), meta["canonical_url"].alias("canonical_url"),
        meta["owner_mid"].alias("owner_mid"),
    ).join(captured.where("section in ('main', 'reply')"), "url")
    if "root_id" not in pages.columns:
        pages = pages.withColumn("root_id", F.lit(None).cast("string"))
    called = with_call(pages)
    root, answers = called.where("section = 'main'"), called.where("section = 'reply'")
    within = F.col("page_no") <= F.col("last_page")
    read = root.join(root_comment_ends(root, max_pages), "url").where(within).drop("last_page", "read_to")
    r = F.col("_r")
    asked = read.select("url", F.explode(J.elements(F.col("_body"), "data.replies")).alias("_r")).select(
        "url", J.field(r, "rpid").alias("root_id"), J.whole(J.field(r, "rcount", "variant")).alias("_n")
    ).where("root_id IS NOT NULL AND _n > 0").select("url", "root_id").distinct()
    ends = reply_ends(answers, max_pages).join(asked, ["url", "root_id"], "left_semi")
    below = answers.join(ends, ["url", "root_id"]).where(within).drop("last_page", "read_to")
    good = read.withColumn("is_reply", F.lit(False)).unionByName(below.withColumn("is_reply", F.lit(True)))
    return flatten_replies(good, keep=("url", "page_no", "is_reply")).drop("is_reply")
