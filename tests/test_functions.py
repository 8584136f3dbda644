"""Column functions against tables of inputs and expected outputs."""

from __future__ import annotations

import os
import subprocess
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewire.functions import html as H
from tidewire.functions import payloads as J
from tidewire.functions import text, times
from tidewire.functions import urls as U
from tidewire.sources import datasets, forum, video

UTC = timezone.utc


def run(spark, values, build, kind="string"):
    """Apply a column function to a list of values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def times_of(spark, values, build, kind="string"):
    micros = run(spark, values, lambda c: F.unix_micros(build(c)), kind)
    return [None if m is None else datetime.fromtimestamp(m / 1e6, UTC).replace(tzinfo=None) for m in micros]


def test_preview(spark):
    long = "word " * 100
    got = run(spark, [None, "", " a\n\tb  c　d\x1ce ", "x" * 280, "x" * 281, long, "a" * 279 + " bb"], text.content_preview)
    assert got[:5] == ["", "", "a b c d e", "x" * 280, "x" * 280 + "…"]
    assert got[5] == long[:280].rstrip() + "…" and len(got[5]) <= 281
    assert got[6] == "a" * 279 + "…"


def test_strip_html(spark):
    cases = {
        "<p>a</p><b>b</b>": "a b",
        "&lt;i&gt; &amp;amp; &eacute;&#39;&nbsp;x": "<i> &amp; é' x",
        "a < b": "a < b",
        "<br/>": "",
        "1 &notit; &copy2": "1 ¬it; ©2",
    }
    assert run(spark, list(cases), text.strip_html) == list(cases.values())
    assert run(spark, [None], text.strip_html) == [None]


def test_small_text(spark):
    assert run(spark, ["1", " 5 ", "1.5", "x", None, ""], text.optional_int) == [1, 5, None, None, None, None]
    assert run(spark, ["", " 　\n", "a", None], text.is_blank) == [True, True, False, True]
    assert run(spark, ["　 a b \x1f"], text.strip) == ["a b"]


def test_lenient_text_time(spark):
    cases = {
        "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05+08:00": datetime(2024, 1, 1, 19, 4, 5),
        " 2024-01-02 03:04:05.250 ": datetime(2024, 1, 2, 3, 4, 5, 250000),
        "2024-01-02 03:04": datetime(2024, 1, 2, 3, 4),
        "2024-01-02": datetime(2024, 1, 2),
        "20240102": datetime(2024, 1, 2),
        "2024-1-2 3:4:5": datetime(2024, 1, 2, 3, 4, 5),
        "2024": None,
        "2024-05": None,
        "2024-13-01": None,
        "yesterday": None,
        "10:00": None,
        "": None,
    }
    assert times_of(spark, list(cases), times.lenient_text_time) == list(cases.values())


def test_number_times(spark):
    ms = times_of(spark, [1776205307000.0, 1776205307.0, 0.0, None], times.lenient_number_time, "double")
    assert ms == [datetime(2026, 4, 14, 22, 21, 47)] * 2 + [None, None]
    got = times_of(spark, ["0", "1.5", "", "x", None], times.epoch_seconds)
    assert got == [datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 0, 1, 500000), None, None, None]


def test_strict_time_raises(spark):
    with pytest.raises(PySparkException):
        run(spark, ["soon"], lambda c: times.strict_time(c).cast("string"))


def test_duration_label(spark):
    got = run(spark, [None, 0, 999, 1000, 59949, 60000, 90000, 3600000], times.duration_label, "bigint")
    assert got == ["—", "0 ms", "999 ms", "1.0 s", "59.9 s", "1.0 m", "1.5 m", "60.0 m"]


def test_urls(spark):
    ids = {
        "https://xueqiu.com/1/987654321": "987654321",
        "https://xueqiu.com/1/987654321/?a=1#b": "987654321",
        "https://xueqiu.com/1/12345": None,
        "https://xueqiu.com/x?u=/987654321": None,
        "https://xueqiu.com/1/987654;p": "987654",
        "/5/1234567": "1234567",
    }
    assert run(spark, list(ids), U.extract_post_id) == list(ids.values())
    posts = {"https://xueqiu.com/1/2": True, "https://xueqiu.com/1/2//": True, "https://xueqiu.com/1": False,
             "/1/2": False, "http://xueqiu.com/1/2": False, "https://xueqiuxcom/1/2": False}
    assert run(spark, list(posts), U.is_post_url) == list(posts.values())
    canon = {"https://xueqiu.com": "https://xueqiu.com/", "HTTPS://XueQiu.com/A?b": "https://xueqiu.com/A?b",
             "https://x.com?q=1": "https://x.com/?q=1"}
    assert run(spark, list(canon), U.http_url) == list(canon.values())
    assert run(spark, ["a b/c~d*e+f#贵"], U.quote) == ["a%20b/c~d%2Ae%2Bf%23%E8%B4%B5"]


def test_video_targets(spark):
    cases = {
        "https://www.bilibili.com/video/BV1xx411c7mD?p=2": ("https://www.bilibili.com/video/BV1xx411c7mD", "BV1xx411c7mD", None),
        "BV1xx411c7mD": ("https://www.bilibili.com/video/BV1xx411c7mD", "BV1xx411c7mD", None),
        " av170001 ": ("https://www.bilibili.com/video/av170001", None, 170001),
        "https://www.bilibili.com/video/av170001/": ("https://www.bilibili.com/video/av170001", None, 170001),
        "not-a-video": None,
        "": None,
        "av12x": None,
    }
    got = run(spark, list(cases), U.parse_video_target)
    assert [None if g is None else tuple(g) for g in got] == list(cases.values())
    spaces = {"https://space.bilibili.com/123/video": "123", " 42 ": "42", "x42": None, "": None}
    assert run(spark, list(spaces), U.parse_space_mid) == list(spaces.values())


def test_topic_ids(spark):
    got = run(spark, ['["a", 1]', "", None, "{}", "[bad", "[]"], J.topic_ids)
    assert got == [["a", "1"], [], [], [], [], []]


def test_timeline_links(spark):
    nested = (
        '{"data":{"x":[{"id":1,"user":{"id":2},"retweeted_status":{"id":3,"user_id":4,"status":{"url":"https://xueqiu.com/5/6/"}}}]},'
        '"url":"https://xueqiu.com/9/9"}'
    )
    listed = '[{"list":[[{"target":"/1/2","status_id":8,"user_id":"7"}]]}, {"id":0,"user_id":1}]'
    got = run(spark, [nested, listed, "{}", "not json", None], J.timeline_links)
    assert got[0] == ["https://xueqiu.com/2/1", "https://xueqiu.com/4/3", "https://xueqiu.com/5/6"]
    assert got[1] == ["https://xueqiu.com/7/8"]
    assert got[2:] == [[], None, None]
    deep = '{"a":' * 400 + '[{"id":1,"user_id":2}]' + "}" * 400
    assert run(spark, [deep], J.timeline_links) == [["https://xueqiu.com/2/1"]]


def test_unreadable_payloads_end_no_job(spark):
    number, depth = '{"id":' + "9" * 5000 + "}", "[" * 200_000
    assert run(spark, [number, depth, listed_post()], J.timeline_links) == [None, None, ["https://xueqiu.com/7/8"]]


def listed_post():
    return '[{"id":8,"user_id":7}]'


def test_workers_need_no_installed_package(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from tidewire.functions import payloads, text
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
rows = spark.createDataFrame([({listed_post()!r}, "a &amp; b")], "p string, h string")
print(rows.select(payloads.timeline_links(F.col("p")), text.strip_html(F.col("h"))).first())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "https://xueqiu.com/7/8" in done.stdout and "a & b" in done.stdout, done.stderr[-2000:]


def test_page_parts(spark):
    page = (
        '<META name="a" content="1"><meta content="x" name="b"><meta property="a" id="z" content="2">'
        '<a href="https://xueqiu.com/2/3/">x</a><a href="https://xueqiu.com/1/2">y</a><a href="https://xueqiu.com/1/2/">z</a>'
        '<script>{"k": [1, {"z": 2}]}</script><script>var a = {};</script><script> {"broken </script><script>[1]</script>'
    )
    assert run(spark, [page], H.meta_map) == [{"a": "2"}]
    assert run(spark, [page], H.page_links) == [["https://xueqiu.com/1/2", "https://xueqiu.com/2/3"]]
    blocks = run(spark, [page], lambda c: F.transform(H.embedded_json(c), lambda x: F.to_json(x)))
    assert blocks == [['{"k":[1,{"z":2}]}']]


URL = "https://xueqiu.com/1234567890/987654321"
SCRIPT = (
    '<script>{"article":{"description":"from json","like_count":88,"comment_count":12,"retweet_count":5},'
    '"user":{"id":1234567890,"screen_name":"name"}}</script>'
)


def articles(spark, *pages, url=URL):
    df = spark.createDataFrame([(i, url, p) for i, p in enumerate(pages)], "i int, url string, text string")
    rows = H.extract_articles(df.withColumn("fetched_at", F.current_timestamp())).orderBy("i").collect()
    return [(r.post, r.author) for r in rows]


def test_article(spark):
    page = (
        '<html><head><title>plain &amp; title</title><meta property="og:title" content="OG">'
        f'<meta property="og:url" content="{URL}"><meta property="article:published_time" content="2026-04-15T10:00:00+08:00">'
        f'</head><body>{SCRIPT}<div class="x article__bd y"><p>first</p><p>second &lt;3</p></div></body></html>'
    )
    (post, author), = articles(spark, page)
    assert (post.source_entity_id, post.title, post.content_text) == ("987654321", "OG", "first second <3")
    assert (post.like_count, post.comment_count, post.repost_count) == (88, 12, 5)
    assert (author.source_entity_id, author.display_name) == ("1234567890", "name")
    assert author.profile_url == "https://xueqiu.com/u/1234567890"
    assert post.raw_topic_ids == []


def test_article_precedence(spark):
    body = '<div data-testid="article-content">body</div>'
    later = '<script>{"article":{"content":"newer","like_count":null}}</script>'
    results = articles(
        spark,
        SCRIPT,                                              # JSON text alone
        SCRIPT + '<div class="article__bd"> <br> </div>',    # an empty body replaces it: no post
        SCRIPT + later,                                      # later blocks override, null included
        '<meta name="description" content="d &amp; e">',     # description as last resort
        '<meta property="og:description" content="od"><title> T\n1 </title>',
        body + '<div class="status-content">two</div>',      # the first body wins
        "<p>nothing</p>",
        body + '<script>{"user":{"name":"only"}}</script>',  # a name without id
        body + '<meta name="twitter:title" content="tw"><time x datetime="2024-01-02">',
    )
    texts = [p and p.content_text for p, _ in results]
    assert texts == ["from json", None, "newer", "d & e", "od", "body", None, "body", "body"]
    assert (results[2][0].like_count, results[2][0].comment_count) == (None, 12)
    assert results[4][0].title == "T 1" and results[3][0].title is None
    assert results[7][1].source_entity_id == "unknown" and results[7][1].profile_url is None
    assert results[8][0].title == "tw" and results[8][0].published_at is not None
    assert results[5][1] is None
    assert articles(spark, SCRIPT, url="https://xueqiu.com/1/2") == [(None, None)]


def test_comment_payload(spark):
    payload = (
        '{"comments":[{"id":1001,"text":"<b>one</b>","created_at":1776205307000,"user":{"id":5},"like_count":3},'
        '{"id":2,"text":"","description":"two","created_at":0,"created_at_text":"2024-01-02","reply_id":2001},'
        '{"id":3,"text":"x","reply_id":0}, {"id":null,"text":"x"}, {"id":4,"text":" "}, "junk"]}'
    )
    df = spark.createDataFrame([(payload, "p")], "text string, post_entity_id string").withColumn("fetched_at", F.current_timestamp())
    rows = {r.source_entity_id: r for r in forum.flatten_comments(df).withColumn("published_at", F.col("published_at").cast("string")).collect()}
    assert sorted(rows) == ["1001", "2", "3"]
    assert (rows["1001"].content_text, rows["1001"].author_entity_id, rows["1001"].like_count) == ("one", "5", 3)
    assert rows["1001"].published_at == "2026-04-14 22:21:47"
    assert (rows["2"].content_text, rows["2"].parent_comment_entity_id, rows["2"].published_at) == ("two", "2001", "2024-01-02 00:00:00")
    assert rows["3"].parent_comment_entity_id == "0"


def test_reply_payload(spark):
    payload = (
        '{"data":{"replies":[{"rpid":1,"parent":0,"member":{"mid":"9"},"content":{"message":" hi "},"ctime":0,"like":"x"},'
        '{"rpid":2,"parent":7,"member":{"mid":8},"content":{"message":"yo"}},{"rpid":3,"content":{"message":"  "}},{"content":{"message":"no id"}}]}}'
    )
    rows = [(payload, "11", "https://v/11", True, None), (payload, "12", "https://v/12", True, "9"), (payload, "13", "https://v/13", False, None)]
    df = spark.createDataFrame(rows, "text string, post_entity_id string, canonical_url string, is_reply boolean, owner_mid string")
    got = video.flatten_replies(df.withColumn("fetched_at", F.current_timestamp())).collect()
    kept = sorted((r.post_entity_id, r.source_entity_id, r.parent_comment_entity_id) for r in got)
    assert kept == [("11", "1", None), ("11", "2", "7"), ("12", "1", None), ("13", "1", None), ("13", "2", None)]
    first = next(r for r in got if r.post_entity_id == "11" and r.source_entity_id == "1")
    assert (first.content_text, first.like_count, first.canonical_url) == ("hi", None, "https://v/11#reply1")


def test_ranking_page(spark):
    html = (
        'x<script>var pagedata={"sbgg_all":{"result":{"data":['
        '{"SECURITY_CODE":"600519","MARKET_SUFFIX":"SH","TRADE_DATE":"2026-04-14 00:00:00","BILLBOARD_NET_AMT":1.5},'
        '{"SECURITY_CODE":"","MARKET_SUFFIX":"SH","TRADE_DATE":"2026-04-14 00:00:00"},'
        '{"SECURITY_CODE":"002594","MARKET_SUFFIX":"SZ","TRADE_DATE":"2026-04-14 00:00:00","BILLBOARD_NET_AMT":-2}]}}};\n</script>'
    )
    df = spark.createDataFrame([(html,)], "text string")
    rows = sorted((r.rank, r.stock_id, r.ranking_mode, str(r.trade_date)) for r in datasets.ranking_rows(df).collect())
    assert rows == [(1, "SH600519", "net_buy", "2026-04-14"), (3, "SZ002594", "net_sell", "2026-04-14")]
    for bad in ("<html>", "var pagedata={}", 'var pagedata={"a" 1};\n</script>'):
        with pytest.raises((PySparkException, Py4JError)):
            datasets.ranking_rows(spark.createDataFrame([(bad,)], "text string")).collect()


def test_outcomes(spark):
    rows = [
        (200, "ok", None, None), (0, "", "dial tcp failed", "http://p"), (403, "x", None, None), (200, " ", None, None),
        (200, "a captcha b", None, None), (200, "a CAPTCHA b", None, None), (None, "x", None, None),
    ]
    df = spark.createDataFrame(rows, "status_code int, text string, error_message string, proxy_url string").withColumn("url", F.lit("u"))
    got = [(r.blocked, r.error) for r in forum.classify(df).collect()]
    blocked = (True, "Blocked response from u")
    assert got == [(False, None), (False, "Fetch failed for u: dial tcp failed via http://p"), blocked, blocked, blocked, (False, None), (False, None)]


def test_video_outcomes(spark):
    ok = '{"code":0,"data":{"aid":1,"bvid":"BV0000000001","title":"t","desc":"","owner":{"mid":3},"stat":{}}}'
    rows = [
        ("av1", 200, ok), ("nothing", 200, ok), ("av1", 412, ""), ("av1", 200, '{"code":-412,"message":"m"}'), ("av1", 200, '{"code":-404}'),
        ("av1", 200, '{"code":0,"data":[]}'), ("av1", 200, '{"code":0,"data":{"aid":1}}'), ("av1", 200, "<html>"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, target string, status_code int, text string")
    df = df.select("*", F.lit("u").alias("url"), F.create_map(F.lit("video_target"), "target").alias("metadata"),
                   F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("string").alias("proxy_url"),
                   F.current_timestamp().alias("fetched_at"))
    got = video.parse(df).orderBy("i").collect()
    assert [r.error for r in got] == [
        None, "Could not parse Bilibili video target from u", "Fetch failed for u: HTTP 412", "Fetch failed for u: API code -412: m",
        "Fetch failed for u: API code -404: API error -404", "Could not parse video metadata from u",
        "Could not normalize video payload from u", "Fetch failed for u: invalid JSON payload",
    ]
    assert [r.blocked for r in got] == [False, False, True, True, False, False, False, False]
    assert got[0].post.content_text == "t" and got[0].author.source_entity_id == "3"
    assert all(r.post is None for r in got[1:])
