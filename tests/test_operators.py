"""Operators on small hand-made relations, boundaries included."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.operators import frontier as FR
from tidewire.operators import listing, readers, runs, seeds, threads
from tidewire.operators.upsert import last_by_key, update_by_key, upsert
from tidewire.plans import dashboard

AT = datetime(2026, 4, 15, 12)


def ts(text):
    return F.lit(text).cast("timestamp")


NOW = "2026-04-15 12:00:00"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_last_by_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", i, f"v{i}") for i in range(50)] + [("b", 1, "x")], "k string, seq int, v string")
    newest = last_by_key(df, ["k"], ["seq"])
    assert rows(newest, "k", "v") == [("a", "v49"), ("b", "x")]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1, 1), ("b", 1, None), ("c", 1, 3)], "k string, v int, first int")
    batch = spark.createDataFrame([("a", 8, 80, 2), ("a", 9, 90, 1), ("b", 7, 70, 1), ("d", 5, 50, 1)], "k string, v int, first int, seq int")
    assert rows(upsert(target, batch, ["k"], ["seq"]), "k", "v", "first") == [("a", 8, 80), ("b", 7, 70), ("c", 1, 3), ("d", 5, 50)]
    kept = upsert(target, batch, ["k"], ["seq"], preserve=["first"])
    assert rows(kept, "k", "v", "first") == [("a", 8, 1), ("b", 7, None), ("c", 1, 3), ("d", 5, 50)]
    assert rows(upsert(target, batch.limit(0), ["k"], ["seq"]), "k", "v") == [("a", 1), ("b", 1), ("c", 1)]
    twice = upsert(upsert(target, batch, ["k"], ["seq"]), batch, ["k"], ["seq"])
    assert rows(twice, "k", "v") == rows(upsert(target, batch, ["k"], ["seq"]), "k", "v")


def test_update_by_key(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, status int")
    updates = spark.createDataFrame([("a", 5, 1), ("a", None, 2), ("z", 9, 1)], "k string, status int, seq int")
    assert rows(update_by_key(target, updates, ["k"], ["seq"]), "k", "status") == [("a", None), ("b", 2)]


TASK = "url string, kind string, source string, seed_name string, priority int, metadata map<string,string>, seq long"


def tasks(spark, *items):
    full = [(u, k, s, "seed", p, m, i) for i, (u, k, s, p, m) in enumerate(items)]
    return spark.createDataFrame(full, TASK)


def state(spark, *items):
    df = spark.createDataFrame(list(items), "url string, fetched string")
    fetched = F.col("fetched").cast("timestamp")
    return df.select(
        "url", F.lit("xueqiu").alias("source"), F.lit("old").alias("kind"), F.lit("old").alias("seed_name"),
        ts("2026-01-01").alias("first_seen_at"), ts("2026-01-01").alias("last_seen_at"), fetched.alias("last_fetched_at"),
        F.lit(200).alias("last_status"),
    )


def test_queue_order_and_positions(spark):
    df = tasks(
        spark,
        ("low", "discover", "x", 100, {}), ("old", "fetch_post", "x", 180, {"pubdate_ts": "5"}),
        ("new", "fetch_post", "x", 180, {"pubdate_ts": "9"}), ("fifo1", "fetch_post", "x", 180, {"pubdate_ts": "bad"}),
        ("fifo2", "fetch_post", "x", 180, {}), ("top", "refresh_comments", "x", 300, {}),
    )
    placed = FR.with_positions(FR.in_queue_order(df.repartition(4)))
    order = [r.url for r in placed.orderBy("queue_pos").collect()]
    assert order == ["top", "new", "old", "fifo1", "fifo2", "low"]
    assert sorted(r.queue_pos for r in placed.collect()) == [1, 2, 3, 4, 5, 6]


def test_claim_boundaries(spark):
    df = tasks(
        spark,
        ("edge", "fetch_post", "x", 1, {}), ("stale", "fetch_post", "x", 1, {}), ("never", "fetch_post", "x", 1, {}), ("new", "fetch_post", "x", 1, {}),
        # The first task of `mixed` is too fresh for a post, the second is not for a discovery.
        ("mixed", "fetch_post", "x", 9, {}), ("mixed", "discover", "x", 1, {}), ("mixed", "discover", "x", 1, {}),
        ("space", "discover", "bilibili", 1, {"seed_kind": "space"}), ("space2", "discover", "xueqiu", 1, {"seed_kind": "space"}),
    )
    stored = state(
        spark, ("edge", "2026-04-15 06:00:00"), ("stale", "2026-04-15 05:59:59.999999"), ("never", None), ("mixed", "2026-04-15 10:00:00"),
        ("space", "2026-04-15 11:45:00"), ("space2", "2026-04-15 11:45:00"),
    )
    policy = FR.FreshnessPolicy(post_recrawl=360, comment_refresh=60, space_discovery=10)
    claimed = FR.claim(df, stored, now=ts(NOW), policy=policy)
    assert [r.seq for r in claimed.where("claimed").orderBy("seq").collect()] == [1, 2, 3, 5, 7]
    assert claimed.count() == 9
    images = FR.claimed_state(FR.claim_winners(df, stored, now=ts(NOW), policy=policy), now=ts(NOW))
    by_url = {r.url: r for r in images.collect()}
    assert by_url["new"].last_status is None and by_url["stale"].last_status == 200
    assert by_url["stale"].first_seen_at < by_url["new"].first_seen_at
    assert by_url["mixed"].kind == "discover" and by_url["mixed"].seed_name == "seed"


def test_a_hot_url_is_claimed_once(spark):
    hot = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("url"), F.lit("fetch_post").alias("kind"),
        F.lit("x").alias("source"), F.lit("s").alias("seed_name"), (F.col("id") % 7).cast("int").alias("priority"),
        F.create_map(F.lit("a"), F.lit("b")).alias("metadata"), F.col("id").alias("seq"),
    )
    winners = FR.claim_winners(hot, state(spark, ("none", None)), now=ts(NOW), policy=FR.FreshnessPolicy())
    assert winners.groupBy("url").count().where("count > 1").count() == 0
    assert winners.count() == 5000 - 1667 + 1
    assert winners.where("url = 'hot'").first().seq == 6


def test_comments_due_includes_the_boundary(spark):
    posts = spark.createDataFrame([("x", i) for i in "abcd"], "source string, source_entity_id string")
    known = spark.createDataFrame(
        [("x", "a", "2026-04-15 11:00:00"), ("x", "b", "2026-04-15 11:00:01"), ("x", "c", None)],
        "source string, source_entity_id string, at string",
    ).select("source", "source_entity_id", F.col("at").cast("timestamp").alias("last_comment_refresh_at"))
    assert rows(FR.comments_due(posts, known, now=ts(NOW), min_age=60), "source_entity_id") == [("a",), ("c",), ("d",)]


def test_stock_universe(spark):
    data = [
        ("SZ000858", "SZ", "main", ["wine"]), ("SH600519", "SH", "main", ["wine", "big"]), ("SH688001", "SH", "star", ["wine"]),
        ("SH600001", "SH", "main", ["st", "wine"]), ("SH600002", None, "main", ["wine"]), ("SH600003", "SH", "main", None),
        ("SH600004", "SH", "main", [None, "wine"]),
    ]
    df = spark.createDataFrame(data, "stock_id string, market string, board string, tags array<string>")
    got = seeds.stock_universe_items(df, markets=["SH", "SZ"], boards=["main"], prefixes=["SH600", "SZ000"],
                                     include_tags=["wine"], exclude_tags=["st"])
    assert rows(got, "value") == [("SH600004",), ("SH600519",), ("SZ000858",)]
    assert [r.value for r in seeds.stock_universe_items(df, limit=2).collect()] == ["SH600001", "SH600002"]
    assert rows(seeds.stock_universe_items(df, exclude_tags=["st"], markets=["SH"], boards=["main"]), "value") == [
        ("SH600003",), ("SH600004",), ("SH600519",)]


def test_ranking(spark):
    data = [
        ("SH600519", date(2026, 4, 14), "SH", "net_buy", 2), ("SZ002594", date(2026, 4, 14), "SZ", "net_buy", None),
        ("SH600519", date(2026, 4, 13), "SH", "net_buy", 1), ("SZ000001", date(2026, 4, 1), "SZ", "net_buy", 1),
        ("SH600000", date(2026, 4, 14), "SH", "net_sell", 1), ("AA", date(2026, 4, 14), "SZ", "net_buy", None),
        ("ZZ", date(2026, 4, 15), "SZ", "net_buy", 9),
    ]
    df = spark.createDataFrame(data, "stock_id string, trade_date date, market string, ranking_mode string, rank int")
    got = seeds.ranking_items(df, as_of=AT, days_window=3, ranking_modes=["net_buy"])
    assert [r.value for r in got.collect()] == ["ZZ", "SH600519", "AA", "SZ002594"]
    assert [r.value for r in seeds.ranking_items(df, as_of=AT, top_n=2).collect()] == ["ZZ", "SH600000"]
    edge = seeds.ranking_items(df, as_of=AT, days_window=15, markets=["SZ"])
    assert "SZ000001" in [r.value for r in edge.collect()]
    assert "SZ000001" not in [r.value for r in seeds.ranking_items(df, as_of=AT, days_window=14).collect()]


def test_ttl_and_refresh_boundaries(spark):
    items = spark.createDataFrame([("a", "2026-04-15 11:50:00"), ("b", "2026-04-15 11:49:59")], "v string, s string").select(
        "v", F.col("s").cast("timestamp").alias("last_seen_at"))
    assert rows(seeds.active_items(items, as_of=ts(NOW), ttl_minutes=10), "v") == [("a",)]
    snapshots = spark.createDataFrame([("a", "2026-04-15 11:00:00"), ("b", "2026-04-15 11:00:01")], "seed_set_name string, s string").select(
        "seed_set_name", F.col("s").cast("timestamp").alias("refreshed_at"))

    def due(*names):
        targets = spark.createDataFrame([(n,) for n in names], "name string")
        return seeds.needs_refresh(targets, snapshots, as_of=ts(NOW), refresh_minutes=60).first()[0]

    assert due("a") and not due("b") and due("b", "c") and not due()


def test_compiled_documents_split_and_stay_whole(spark):
    items = spark.range(2500).select(
        F.when(F.col("id") < 2400, "huge").otherwise("small").alias("logical_set_name"), F.lit("g").alias("generator_name"),
        F.lit("stock_id").alias("item_kind"), F.concat(F.lit("s"), F.col("id") % 2450).alias("item_value"))
    names = spark.createDataFrame([("huge",), ("small",), ("empty",)], "name string")
    docs = seeds.seed_documents(names, seeds.compile_items(items), ts(NOW), chunk_items=100)
    per_set = {r.seed_set_name: r["count"] for r in docs.groupBy("seed_set_name").count().collect()}
    assert per_set["empty"] == per_set["small"] == 1 and per_set["huge"] > 10
    counts = {r.name: r.stock_count for r in seeds.seed_inventory(seeds.read_documents(docs)).collect()}
    assert counts == {"empty": 0, "huge": 2400, "small": 100}
    seed = seeds.read_documents(docs, "small").first()
    assert seed.stock_ids == sorted(seed.stock_ids) and seed.post_urls == []


def test_set_that_shrinks_below_the_chunk_size(spark):
    """Chunks of the larger snapshot stay stored, but neither readers, inventory nor status count them."""
    names = spark.createDataFrame([("s",), ("other",)], "name string")
    compiled = spark.range(50).select(F.lit("s").alias("seed_set_name"), F.lit("stock_id").alias("kind"), F.col("id").cast("string").alias("value"))
    large = seeds.seed_documents(names, compiled, ts("2026-01-01"), chunk_items=10)
    small = seeds.seed_documents(names.where("name = 's'"), compiled.where("value < 5"), ts("2026-01-02"), chunk_items=10)
    stored = small.unionByName(large.join(small, ["seed_set_name", "chunk"], "left_anti"))
    assert stored.where("seed_set_name = 's'").count() > 1
    definitions = seeds.read_documents(stored)
    assert sorted(len(r.stock_ids) for r in definitions.collect()) == [0, 5]
    assert {r.name: r.stock_count for r in seeds.seed_inventory(definitions).collect()} == {"s": 5, "other": 0}
    runs = spark.createDataFrame([], schemas.CRAWL_RUNS)
    errors = spark.createDataFrame([], schemas.CRAWL_ERRORS)
    urls = spark.createDataFrame([], schemas.URL_STATE)
    report = dashboard.overview(dashboard.status(runs, errors, urls, stored, now=ts(NOW)))
    assert {r.name: r.n for r in report.where("section = 'seed_sets'").collect()} == {"s": 5, "other": 0}


COMMENT = "source string, post_entity_id string, source_entity_id string, parent_comment_entity_id string"


def comments(spark, *items):
    df = spark.createDataFrame([("x", *i) for i in items], COMMENT)
    return df.withColumns({"published_at": F.lit(None).cast("timestamp"), "fetched_at": ts(NOW)})


def test_comment_tree(spark):
    df = comments(
        spark, ("p", "1", None), ("p", "2", "1"), ("p", "3", "2"), ("p", "o", "gone"), ("p", "o1", "o"), ("p", "z", "0"),
        ("p", "c1", "c2"), ("p", "c2", "c1"), ("p", "c3", "c2"), ("p", "self", "self"), ("q", "1", ""), ("q", "2", "3"),
    )
    got = {(r.post_entity_id, r.source_entity_id): r for r in threads.comment_tree(df).collect()}
    assert len(got) == 12
    facts = {k: (r.root_id, r.depth, r.is_orphan, r.in_cycle) for k, r in got.items()}
    assert facts[("p", "3")] == ("1", 2, False, False)
    assert facts[("p", "o")] == ("o", 0, True, False) and facts[("p", "o1")] == ("o", 1, False, False)
    assert facts[("p", "z")] == ("z", 0, True, False)
    assert facts[("p", "c3")] == (None, None, False, True) and facts[("p", "self")] == (None, None, False, True)
    assert facts[("q", "1")] == ("1", 0, False, False) and facts[("q", "2")] == ("2", 0, True, False)
    strict = rows(threads.comment_tree(df, strict=True), "post_entity_id", "source_entity_id")
    assert strict == [("p", "1"), ("p", "2"), ("p", "3"), ("p", "o"), ("p", "z"), ("q", "1"), ("q", "2")]
    paths = threads.comment_tree(df.where("post_entity_id = 'p'"), paths=True).where("not in_cycle")
    walk = [r.source_entity_id for r in paths.orderBy("path").collect()]
    assert walk == ["1", "2", "3", "o", "o1", "z"]


def test_random_trees_match_a_plain_walk(spark):
    rng = random.Random(7)
    parents = {str(i): (str(rng.randrange(i)) if i and rng.random() < 0.9 else None) for i in range(300)}
    # One long chain, and a third of all comments under one parent.
    parents |= {f"c{i}": (f"c{i - 1}" if i else None) for i in range(150)}
    parents |= {f"h{i}": "c0" for i in range(220)}
    expected = {}
    for node in parents:
        depth, at = 0, node
        while parents[at] is not None:
            depth, at = depth + 1, parents[at]
        expected[node] = (at, depth)
    df = comments(spark, *[("p", k, v) for k, v in parents.items()])
    got = {r.source_entity_id: (r.root_id, r.depth) for r in threads.comment_tree(df).collect()}
    assert got == expected


def test_owner_comments(spark):
    df = spark.createDataFrame(
        [("bilibili", "known", "a", "o"), ("bilibili", "known", "b", "x"), ("bilibili", "known", "c", None), ("bilibili", "unknown", "d", "x"),
         ("bilibili", "missing", "e", None), ("xueqiu", "known", "f", "x")],
        "source string, post_entity_id string, source_entity_id string, author_entity_id string")
    posts = spark.createDataFrame([("bilibili", "known", "o"), ("bilibili", "unknown", None), ("xueqiu", "known", "o")],
                                  "source string, source_entity_id string, author_entity_id string")
    assert rows(threads.owner_comments(df, posts), "source_entity_id") == [("a",), ("d",), ("e",), ("f",)]


def test_posts_keep_without_comments(spark):
    posts = spark.createDataFrame([("x", "a", "A"), ("x", "b", None)], "source string, source_entity_id string, title string")
    df = comments(spark, ("a", "1", None), ("a", "2", None), ("zz", "3", None)).withColumns(
        {"author_entity_id": F.lit("u"), "content_text": F.lit("t")})
    assert rows(threads.with_comments(posts, df), "post_entity_id", "comment_id") == [("a", "1"), ("a", "2"), ("b", None)]


def test_repeated_page_ends_a_listing(spark):
    data = [("l", 1, "a"), ("l", 1, "b"), ("l", 2, "b"), ("l", 2, "c"), ("l", 3, "a"), ("l", 3, "c"), ("l", 4, "new"), ("m", 1, "a"), ("m", 2, None), ("m", 3, "b")]
    df = spark.createDataFrame(data, "l string, page int, item string")
    kept = listing.until_repeated_page(df, ["l"], "item")
    assert rows(kept, "l", "page", "item") == [
        ("l", 1, "a"), ("l", 1, "b"), ("l", 2, "b"), ("l", 2, "c"), ("m", 1, "a"), ("m", 2, None), ("m", 3, "b")]


def test_run_stats(spark):
    data = [
        ("r", "s1", "discover", True, False, 0, 0, 0, 0), ("r", "s1", "fetch_post", True, True, 1, 0, 0, 0), ("r", "s2", "fetch_post", True, False, 0, 1, 0, 1),
        ("r", "s2", "refresh_comments", True, False, 9, 9, 4, 9), ("r", "s2", "fetch_post", False, False, 7, 7, 7, 7),
    ]
    df = spark.createDataFrame(data, "run_id string, seed_name string, kind string, claimed boolean, blocked boolean, errors int, posts int, comments int, authors int")
    row = runs.run_stats(df).first().asDict()
    assert row == {"run_id": "r", "seeds_processed": 2, "tasks_enqueued": 5, "pages_fetched": 3, "posts_written": 1, "comments_written": 4,
                   "authors_written": 1, "blocked_responses": 1, "errors": 1, "skipped_tasks": 1}


@pytest.mark.parametrize("call", [
    lambda: readers.check_source("nope"), lambda: readers.check_entity_id("a b"), lambda: readers.check_entity_id("x" * 129),
    lambda: readers.check_page(0), lambda: readers.check_page(201), lambda: readers.check_page(1, 10_001), lambda: readers.check_page(1, -1),
])
def test_arguments_are_checked(call):
    with pytest.raises(ValueError):
        call()
    readers.check_source(None)
    readers.check_entity_id("BV1.a:b_c-9")


def test_null_published_sorts_by_fetch_time(spark):
    df = spark.createDataFrame(
        [("xueqiu", "1", "2026-01-01", "2026-01-09"), ("xueqiu", "2", None, "2026-01-05"), ("bilibili", "3", "2026-01-03", "2026-01-04")],
        "source string, source_entity_id string, p string, f string").select(
        "source", "source_entity_id", F.lit("u").alias("canonical_url"), F.lit("").alias("author_entity_id"), F.lit(None).cast("string").alias("title"),
        F.lit(" ").alias("content_text"), F.col("p").cast("timestamp").alias("published_at"), F.col("f").cast("timestamp").alias("fetched_at"),
        F.lit(None).cast("bigint").alias("like_count"), F.lit(2).cast("bigint").alias("comment_count"))
    assert [r.source_entity_id for r in readers.recent_posts(df).collect()] == ["2", "3", "1"]
    assert [r.source_entity_id for r in readers.recent_posts(df, limit=1, offset=1).collect()] == ["3"]
    card = readers.post_cards(readers.recent_posts(df, limit=1)).first()
    assert (card.title, card.likes, card.replies) == ("(untitled)", 0, 2)
