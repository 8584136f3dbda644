"""Seed refresh and a whole crawl cycle on hand-made pages."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewire.operators.frontier import FreshnessPolicy
from tidewire.plans.cycle import run_cycle
from tidewire.plans.refresh import check_catalog, ensure_seeds, refresh_seeds
from tidewire.schemas import SEED_DEFINITION, SEED_KINDS
from tidewire.session import shared_dir
from tidewire.sources.tables import LogTable

NOW = datetime(2026, 4, 15, 12, tzinfo=timezone.utc)
CATALOG = {
    "logical_sets": [{"name": "core", "generators": ["m", "u"]}, {"name": "hot", "generators": ["r"]}],
    "generators": [
        {"name": "m", "type": "manual", "discover_homepage": True, "post_urls": ["https://xueqiu.com/1/100001"],
         "user_ids": ["b", "a", "a"]},
        {"name": "u", "type": "stock_universe", "markets": ["SH"], "limit": 1,
         "stocks": [{"stock_id": "SH2", "market": "SH"}, {"stock_id": "SH1", "market": "SH"}, {"stock_id": "SZ1", "market": "SZ"}]},
        {"name": "r", "type": "longhubang", "top_n": 2, "entries": [
            {"stock_id": "X", "trade_date": date(2026, 4, 14), "rank": 2}, {"stock_id": "Y", "trade_date": date(2026, 4, 14), "rank": 1},
            {"stock_id": "X", "trade_date": date(2026, 4, 15)}]},
    ],
}


def test_refresh_compiles_and_expires(spark, tmp_path):
    root = str(tmp_path)
    totals = refresh_seeds(spark, root, CATALOG, now=NOW, batch_id=1).first()
    assert (totals.generator_runs, totals.generated_items) == (3, 5 + 1 + 2 - 0)
    seeds = {r.name: r for r in ensure_seeds(spark, root, CATALOG, now=NOW, batch_id=2).collect()}
    assert seeds["core"].user_ids == ["a", "b"]
    assert seeds["core"].stock_ids == ["SH1"]
    assert seeds["core"].discover_homepage and not seeds["hot"].discover_homepage
    assert seeds["hot"].stock_ids == ["X", "Y"]

    # A value dropped from the catalog stays until its TTL has passed.
    changed = {**CATALOG, "generators": [{**CATALOG["generators"][0], "user_ids": ["c"]}, *CATALOG["generators"][1:]]}
    soon = ensure_seeds(spark, root, changed, now=NOW + timedelta(minutes=60), batch_id=3, seed_set="core").first()
    assert soon.user_ids == ["a", "b", "c"]
    late = ensure_seeds(spark, root, changed, now=NOW + timedelta(minutes=2000), batch_id=4, seed_set="core").first()
    assert late.user_ids == ["c"]
    items = LogTable.named(spark, root, "generated_seed_items").read().where("item_value = 'c'").first()
    assert items.first_seen_at < items.last_seen_at


def test_failed_generator_is_logged(spark, tmp_path):
    broken = {
        "logical_sets": [{"name": "s", "generators": ["ok", "bad"]}],
        "generators": [{"name": "ok", "type": "manual", "user_ids": ["1"]}, {"name": "bad", "type": "stock_universe"}],
    }
    with pytest.raises(ValueError, match="needs a dataset_path"):
        refresh_seeds(spark, str(tmp_path), broken, now=NOW, batch_id=1)
    runs = {r.generator_name: r for r in LogTable.named(spark, str(tmp_path), "generated_seed_runs").read().collect()}
    assert runs["ok"].status == "succeeded" and runs["ok"].item_count == 1
    assert runs["bad"].status == "failed" and "dataset_path" in runs["bad"].error_message
    assert LogTable.named(spark, str(tmp_path), "generated_seed_items").read().count() == 1


@pytest.mark.parametrize("catalog, message", [
    ({"logical_sets": [{"name": "a"}, {"name": "a"}], "generators": []}, "duplicate set: a"),
    ({"logical_sets": [{"name": "a", "generators": ["x"]}], "generators": []}, "unknown generator: a x"),
])
def test_catalog_is_checked(spark, catalog, message):
    with pytest.raises(ValueError, match=message):
        check_catalog(spark, catalog)


def _seeds(spark, **values):
    row = {"name": "core", "discover_homepage": True, **{c: [] for c in SEED_KINDS.values()}, **values}
    return spark.createDataFrame([tuple(row[n] for n in SEED_DEFINITION.names)], SEED_DEFINITION)


ARTICLE = (
    '<title>t</title><script>{{"user": {{"id": {user}, "screen_name": "n"}}}}</script>'
    '<div class="article__bd"><p>body {n}</p></div>'
)


def _captured(spark):
    post = "https://xueqiu.com/7/"
    comments = "https://xueqiu.com/statuses/comments.json?id={}&count=20&page=1"
    video_comments = "https://api.bilibili.com/x/v2/reply/main?oid=11&type=1&mode=3&pn=1&ps=30&next=0"
    video = {"code": 0, "data": {"aid": 11, "bvid": "BV0000000001", "title": "v", "desc": "", "pubdate": 1700000000,
                                 "owner": {"mid": 5, "name": "o"}, "stat": {"like": 1}}}
    own = {"data": {"list": {"vlist": [{"bvid": "BV0000000001", "aid": 11, "created": 9}]}}, "code": 0}
    def reply_page(rpid, final=False):
        rows = [{"rpid": rpid, "rcount": 1, "member": {"mid": "5"}, "content": {"message": " mine "}, "ctime": 1},
                {"rpid": 2, "member": {"mid": "6"}, "content": {"message": "other"}, "ctime": 1}]
        return json.dumps({"code": 0, "data": {"replies": rows, "cursor": {"is_end": final, "next": 5}}})

    answer = {"code": 0, "data": {"replies": [{"rpid": 9, "parent": 1, "member": {"mid": "5"}, "content": {"message": "a"}}]}}
    rows = [
        ("https://xueqiu.com/", 1, "main", 200, f'<a href="{post}100001/"></a><a href="{post}100002"></a><a href="{post}100003"></a>'),
        (post + "100001", 1, "main", 200, ARTICLE.format(user=7, n=1)),
        (post + "100002", 1, "main", 403, "captcha"),
        ("https://xueqiu.com/8/100004", 1, "main", 200, ARTICLE.format(user=8, n=4)),
        (comments.format("100001"), 1, "main", 200, json.dumps({"comments": [{"id": 1, "text": "c1"}], "has_more": True})),
        (comments.format("100001"), 2, "main", 200, json.dumps({"comments": [{"id": 2, "text": "c2", "reply_id": 1}]})),
        (comments.format("100001"), 3, "main", 200, json.dumps({"comments": [{"id": 3, "text": "past the end"}]})),
        (comments.format("100004"), 1, "main", 200, "{broken"),
        ("https://space.bilibili.com/5", 1, "main", 200, json.dumps(own)),
        ("https://space.bilibili.com/5", 2, "main", 412, ""),
        ("https://www.bilibili.com/video/BV0000000001", 1, "main", 200, json.dumps(video)),
        (video_comments, 1, "main", 200, reply_page(1)),
        (video_comments, 2, "main", 200, reply_page(3)),
        (video_comments, 3, "main", 200, reply_page(3)),  # nothing new: the listing ends before it
        (video_comments, 4, "main", 200, reply_page(4)),
        (video_comments, 1, "reply", 200, json.dumps(answer)),
    ]
    schema = "url string, page_no int, section string, status_code int, text string"
    df = spark.createDataFrame(rows, schema).withColumn("root_id", F.when(F.col("section") == "reply", "1"))
    return df.withColumn("fetched_at", F.lit(NOW).cast("timestamp"))


def test_cycle(spark, tmp_path):
    root = str(tmp_path)
    seeds = _seeds(spark, post_urls=["https://xueqiu.com/8/100004/", "https://xueqiu.com/7/100001"], bilibili_space_urls=["5"])
    captured = _captured(spark)
    run = run_cycle(spark, root, seeds, captured, run_id="r1", batch_id=1, now=NOW).first()
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("cycle-*"))
    # Seeds: homepage, two posts, one space. Discovered: three posts, one video. Comments: three.
    assert run.tasks_enqueued == 4 + 4 + 3
    assert run.skipped_tasks == 1  # 100001 was claimed as a seed already
    assert run.pages_fetched == 2 + 2 + 3
    assert run.posts_written == 3 and run.authors_written == 3
    # Blocked: the 403 page and page 2 of the space. The third discovered post was not captured.
    assert run.blocked_responses == 2 and run.errors == 3
    assert run.comments_written == 5
    assert run.status == "succeeded" and run.seeds_processed == 1

    def ids(table):
        return sorted(r.source_entity_id for r in LogTable.named(spark, root, table).read().collect())

    assert ids("posts") == ["100001", "100004", "11"]
    assert ids("comments") == ["1", "1", "2", "3", "9"]
    assert ids("authors") == ["5", "7", "8"]
    errors = sorted(r.error_message for r in LogTable.named(spark, root, "crawl_errors").read().collect())
    assert errors == [
        "Blocked response from https://xueqiu.com/7/100002",
        "Fetch failed for https://xueqiu.com/7/100003: no captured page",
        "Fetch failed for space 5 page 2: HTTP 412",
    ]
    urls = {r.url: r for r in LogTable.named(spark, root, "url_state").read().collect()}
    assert urls["https://xueqiu.com/7/100002"].last_status == 403
    assert urls["https://xueqiu.com/8/100004"].last_status == 200
    items = {r.source_entity_id: r for r in LogTable.named(spark, root, "item_state").read().collect()}
    assert items["100001"].last_comment_refresh_at is not None
    assert items["100004"].last_comment_refresh_at is None  # nothing came back

    # The same cycle again under its id changes nothing.
    again = run_cycle(spark, root, seeds, captured, run_id="r1", batch_id=1, now=NOW).first()
    assert again.asDict() | {"finished_at": 0} == run.asDict() | {"finished_at": 0}
    assert ids("posts") == ["100001", "100004", "11"]

    # Ten minutes later everything is still fresh.
    later = run_cycle(spark, root, seeds, captured, run_id="r2", batch_id=2, now=NOW + timedelta(minutes=10)).first()
    assert later.pages_fetched == 0 and later.skipped_tasks == later.tasks_enqueued == 4
    # A day later the posts are fetched again and replace the old rows.
    run_cycle(spark, root, seeds, captured, run_id="r3", batch_id=3, now=NOW + timedelta(days=1),
              policy=FreshnessPolicy())
    assert ids("posts") == ["100001", "100004", "11"]


def test_failed_cycle_is_recorded(spark, tmp_path):
    seeds = _seeds(spark, bilibili_video_targets=["av1"])

    class Broken:
        SOURCE = "xueqiu"

        def __getattr__(self, name):
            raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        run_cycle(spark, str(tmp_path), seeds, _captured(spark), run_id="x", batch_id=1, now=NOW, adapters={"xueqiu": Broken()})
    row = LogTable.named(spark, str(tmp_path), "crawl_runs").read().first()
    assert row.status == "failed" and row.errors == 1


def test_video_listing_ends(spark):
    """The last page by cursor is kept, pages after it are not; an empty page ends a listing too."""
    from tidewire.sources import video

    def page(rpid, end):
        rows = [{"rpid": rpid, "content": {"message": "m"}}] if rpid else []
        return json.dumps({"code": 0, "data": {"replies": rows, "cursor": {"is_end": end, "next": 1}}})

    listings = {
        "cursor": [page(1, False), page(2, True), page(3, False)],
        "empty": [page(1, False), page(0, False), page(3, False)],
        "failed": [page(1, False), "{", page(3, False)],
        "no cursor": ['{"code":0,"data":{"replies":[{"rpid":1,"content":{"message":"m"}}]}}', page(2, False)],
    }
    rows = [(u, i + 1, "main", 200, t, None) for u, pages in listings.items() for i, t in enumerate(pages)]
    captured = spark.createDataFrame(
        rows, "url string, page_no int, section string, status_code int, text string, error_message string"
    ).withColumn("fetched_at", F.current_timestamp())
    tasks = captured.select("url").distinct().withColumn(
        "metadata", F.create_map(F.lit("post_id"), F.col("url"), F.lit("canonical_url"), F.lit("https://v"))
    )
    got = sorted((r.url, r.source_entity_id) for r in video.comments(tasks, captured).collect())
    assert got == [("cursor", "1"), ("cursor", "2"), ("empty", "1"), ("failed", "1"), ("no cursor", "1")]
