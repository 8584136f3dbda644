"""Ends of paged listings, newest captures, bad records, and what a failure leaves behind."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.functions import payloads as J
from tidewire.functions import urls as U
from tidewire.operators import seeds as S
from tidewire.operators import threads
from tidewire.operators.listing import listing_ends
from tidewire.plans.cycle import run_cycle
from tidewire.plans.refresh import refresh_seeds
from tidewire.schemas import RAW_PAGES, SEED_DEFINITION, SEED_KINDS, conform
from tidewire.sources import captures, datasets, forum, video
from tidewire.sources.tables import LogTable
from tidewire.streaming import jobs

NOW = datetime(2026, 4, 15, 12, tzinfo=timezone.utc)


def read_on(pages, dead, final, most):
    """A reader that asks for page after page: (last page kept, last page answered)."""
    kept = asked = 0
    page = 1
    while most is None or page <= most:
        if page not in pages:
            break
        asked = page
        if page in dead:
            break
        kept = page
        if page in final:
            break
        page += 1
    return kept, asked


@pytest.mark.parametrize("most", [None, 4])
def test_listing_ends_like_a_reader(spark, most):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for n in range(200):
        pages = {p for p in range(1, int(rng.integers(2, 12))) if rng.random() < 0.9}
        if n == 0:
            pages = set(range(1, 2500))
        dead, final = {p for p in pages if n and rng.random() < 0.1}, {p for p in pages if n and rng.random() < 0.1}
        rows += [(n, p, p in dead, p in final) for p in pages]
        if pages and (most is None or min(pages) <= most):
            want[n] = read_on(pages, dead, final, most)
    df = spark.createDataFrame(rows, "u int, page_no int, dead boolean, final boolean").repartition(4)
    got = {r.u: (r.last_page, r.read_to) for r in listing_ends(df, ["u"], dead=F.col("dead"), final=F.col("final"), max_pages=most).collect()}
    assert got == want


def called(spark, rows):
    return spark.createDataFrame(rows, "url string, page_no int, section string, root_id string, status_code int, text string, error_message string")


def test_space_lists_end(spark):
    def page(*ids, total=None):
        return json.dumps({"code": 0, "data": {"list": {"vlist": [{"bvid": i, "aid": 1} for i in ids]}, "page": {"count": total}}})

    spaces = {
        "1": [page("a"), page("b"), page("a", "b"), page("c")],           # nothing new
        "2": [page("a"), page(), page("c")],                              # empty
        "3": [page("a", "b", total=3), page("b", "c", total=3), page("d")],  # the total is reached
        "4": [page("a"), None, page("c")],                                # missing
        "5": [page("a", total="2.0"), page("x", 7, "")],                  # no number as total; odd ids
        "6": [page("a", total=0)],                                        # the total is reached at once
        "7": [page("a", "b", total=1.9), page("c")],
    }
    rows = [(f"https://space.bilibili.com/{m}", i + 1, "main", None, 200, t, None) for m, pages in spaces.items() for i, t in enumerate(pages) if t]
    rows += [("https://space.bilibili.com/2", 3, "main", None, 412, "", None), ("https://space.bilibili.com/8", 2, "main", None, 200, page("z"), None)]
    rows += [("https://space.bilibili.com/1", 4, "search", None, 200, json.dumps([{"bvid": "s", "mid": 1}, {"bvid": "t", "mid": 2}]), None)]
    captured = called(spark, rows).where("NOT (url LIKE '%/2' AND page_no = 3 AND status_code = 200)")
    tasks = spark.createDataFrame(
        [("bilibili", "discover", f"https://space.bilibili.com/{m}", "s", 1, {}, int(m)) for m in [*spaces, "8"]],
        "source string, kind string, url string, seed_name string, priority int, metadata map<string,string>, seq int",
    )
    outcomes, links = video.discover(tasks, captured)
    found = {}
    for r in links.collect():
        found.setdefault(r.parent.seq, set()).add(r.metadata["bvid"])
    assert found == {1: {"a", "b", "s"}, 2: {"a"}, 3: {"a", "b", "c"}, 4: {"a"}, 5: {"a", "x"}, 6: {"a"}, 7: {"a", "b"}}
    errors = {r.seq: r.error for r in outcomes.collect()}
    assert [n for n, e in errors.items() if e] == [8] and "no captured page" in errors[8]


def test_answers_are_read_for_read_roots_only(spark):
    def page(rows, **cursor):
        return json.dumps({"code": 0, "data": {"replies": [{"rpid": r, "rcount": n, "content": {"message": "m"}, "parent": p} for r, n, p in rows], "cursor": cursor}})

    rows = [
        ("u", 1, "main", None, 200, page([(1, 2, 0), (2, 0, 0)], is_end=False, next=1), None),
        ("u", 2, "main", None, 200, page([(3, 1.0, 0)], is_end=True, next=2), None),
        ("u", 3, "main", None, 200, page([(4, 1, 0)], is_end=False, next=3), None),   # past the end
        ("u", 1, "reply", "1", 200, page([(11, 0, 1)], is_end=False), None),
        ("u", 2, "reply", "1", 200, page([(12, 0, 1)]), None),                        # no cursor: the last
        ("u", 3, "reply", "1", 200, page([(13, 0, 1)], is_end=False), None),
        ("u", 1, "reply", "2", 200, page([(21, 0, 2)], is_end=True), None),           # its root has no answers
        ("u", 2, "reply", "3", 200, page([(32, 0, 3)], is_end=True), None),           # page 1 is missing
        ("u", 1, "reply", "4", 200, page([(41, 0, 4)], is_end=True), None),           # its root was not read
    ]
    tasks = spark.createDataFrame([("u", {"post_id": "9", "canonical_url": "v"})], "url string, metadata map<string,string>")
    captured = called(spark, rows).withColumn("fetched_at", F.current_timestamp())
    got = sorted((int(r.source_entity_id), r.parent_comment_entity_id) for r in video.comments(tasks, captured).collect())
    assert got == [(1, None), (2, None), (3, None), (11, "1"), (12, "1")]


def test_newest_capture_reads_texts_last(spark, tmp_path):
    at = [NOW + timedelta(days=d) for d in (-2, -1, 1)]
    rows = [("u", 1, "old", at[0]), ("u", 1, "new", at[1]), ("u", 1, "later", at[2]), ("u", 2, "b", at[1]), ("u", 2, "a", at[1]), ("u", 2, "a", at[1]),
            ("v", 1, "none", None), ("w", 1, "not asked", at[0])]
    df = spark.createDataFrame(rows, "url string, page_no int, text string, fetched_at timestamp").withColumn("section", F.lit("main"))
    conform(df, RAW_PAGES).repartition(3).write.parquet(str(tmp_path / "pages"))
    pages, urls = datasets.read_pages(spark, str(tmp_path / "pages")), spark.createDataFrame([("u",), ("v",), ("x",)], "url string")
    newest = captures.newest(pages, urls, F.lit(NOW).cast("timestamp"))
    assert sorted((r.url, r.page_no, r.text) for r in newest.collect()) == [("u", 1, "new"), ("u", 2, "a"), ("v", 1, "none")]
    plan = newest._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any("text#" in line for line in aggregates)


def test_listing_of_comments_needs_every_page(spark):
    rows = [("u", p, "main", None, 200, json.dumps({"comments": [{"id": p, "text": "t"}], "has_more": True}), None) for p in (1, 2, 4)]
    tasks = spark.createDataFrame([("u", {"post_id": "9"})], "url string, metadata map<string,string>")
    captured = called(spark, rows).withColumns({"fetched_at": F.current_timestamp(), "proxy_url": F.lit(None).cast("string")})
    assert sorted(r.page_no for r in forum.comments(tasks, captured).collect()) == [1, 2]


def test_whole_numbers_of_json(spark):
    texts = ["1", "1.9", "-1.9", "1e3", "true", "false", '" 7 "', '"1.9"', '""', "null", "[]", "{}", "12345678901234567890", "9007199254740993", '"x"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.n for r in df.select("i", J.whole(F.try_parse_json("t")).alias("n")).orderBy("i").collect()]
    assert got == [1, 1, -1, 1000, 1, 0, 7, None, None, None, None, None, None, 9007199254740993, None]


def test_urls_lose_default_ports_and_only_the_last_parameters(spark):
    cases = {"HTTPS://A.b:443": "https://a.b/", "http://a.b:80/x": "http://a.b/x", "https://a.b:80/": "https://a.b:80/", "http://a.b:8080": "http://a.b:8080/"}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.n for r in df.select("u", U.http_url(F.col("u")).alias("n")).collect()} == cases
    paths = {"https://h/a;b/c;d;e": "/a;b/c", "https://h/;" + ";" * 50_000 + "/x": "/;" + ";" * 50_000 + "/x", "https://h/a;": "/a", "https://h": ""}
    df = spark.createDataFrame([(u,) for u in paths], "u string")
    assert {r.u: r.n for r in df.select("u", U.url_path(F.col("u")).alias("n")).collect()} == paths


def test_bad_records_are_rows(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    lines = ['{"stock_id":"A","tags":["x"]}', "", "{broken", "7", '{"stock_id":"B","size":1}', '{"market":"SH"}', '{"stock_id":"C","tags":"x"}', '{"stock_id":"D","market":null}']
    (tmp_path / "lines" / "part").write_text("\n".join(lines))
    got = sorted(((r.stock_id, tuple(r.tags or ()), r.error) for r in datasets.stock_records(spark, str(tmp_path / "lines"), lines=True).collect()), key=str)
    assert got == sorted([
        ("A", ("x",), None), ("D", (), None), (None, (), "no JSON record"), (None, (), "no JSON object"), (None, (), "unknown fields: size"),
        (None, (), "missing fields: stock_id"), (None, (), "unfit values: tags"),
    ], key=str)
    (tmp_path / "broken.json").write_text("[{")
    assert [r.error for r in datasets.ranking_records(spark, str(tmp_path / "broken.json")).collect()] == ["no JSON record"]
    pages = spark.createDataFrame([("a", "<html>"), ("b", 'var pagedata={"sbgg_all":null};\n</script>'), ("c", 'var pagedata={"a" 1};\n</script>')], "page string, text string")
    got = sorted((r.page, r.error) for r in datasets.ranking_pages(pages, keep=("page",)).collect())
    assert got == [("a", "ranking page without payload or terminator"), ("c", "ranking page with a malformed payload")]


def test_counters_of_a_failed_run(spark, tmp_path):
    class Failing:
        def __getattr__(self, name):
            return getattr(forum, name)

        def parse(self, fetched):
            raise RuntimeError("boom")

    row = {"name": "core", "discover_homepage": False, **{c: [] for c in SEED_KINDS.values()}, "post_urls": ["https://xueqiu.com/1/100001", "https://xueqiu.com/1/100001/"],
           "bilibili_space_urls": ["5"]}
    seeds = spark.createDataFrame([tuple(row[n] for n in SEED_DEFINITION.names)], SEED_DEFINITION)
    own = {"code": 0, "data": {"list": {"vlist": [{"bvid": "BV0000000001", "aid": 11}]}}}
    captured = called(spark, [("https://space.bilibili.com/5", 1, "main", None, 200, json.dumps(own), None)]).withColumn("fetched_at", F.lit(NOW).cast("timestamp"))
    with pytest.raises(RuntimeError, match="boom"):
        run_cycle(spark, str(tmp_path), seeds, captured, run_id="r", batch_id=1, now=NOW, adapters={"xueqiu": Failing(), "bilibili": video})
    run = LogTable.named(spark, str(tmp_path), "crawl_runs").read().first()
    # Three seed tasks, one of them twice; the space was read and found one video, which was claimed.
    assert (run.status, run.seeds_processed, run.tasks_enqueued, run.skipped_tasks, run.pages_fetched, run.errors, run.posts_written) == ("failed", 1, 4, 1, 1, 1, 0)


def test_sets_are_stored_one_by_one(spark, tmp_path):
    def catalog(works):
        bad = {"name": "bad", "type": "stock_universe", **({"stocks": [{"stock_id": "S"}]} if works else {})}
        return {"logical_sets": [{"name": n, "generators": g} for n, g in (("a", ["ok", "ok"]), ("b", ["ok", "bad"]), ("c", ["ok"]))],
                "generators": [{"name": "ok", "type": "manual", "user_ids": ["1", "2"]}, bad]}

    root = str(tmp_path)
    with pytest.raises(ValueError, match="needs a dataset_path"):
        refresh_seeds(spark, root, catalog(False), now=NOW, batch_id=1)

    def stored(name):
        return LogTable.named(spark, root, name).read().collect()

    assert {r.seed_set_name for r in stored("compiled_seed_sets")} == {"a"}
    assert sorted((r.logical_set_name, r.generator_name, r.status, r.item_count) for r in stored("generated_seed_runs")) == [
        ("a", "ok", "succeeded", 2), ("a", "ok", "succeeded", 2), ("b", "bad", "failed", 0), ("b", "ok", "succeeded", 2)]
    totals = refresh_seeds(spark, root, catalog(True), now=NOW, batch_id=2, resume=True).first()
    assert (totals.generator_runs, totals.generated_items) == (3, 5)
    assert {r.seed_set_name for r in stored("compiled_seed_sets")} == {"a", "b", "c"}


def test_a_smaller_snapshot_leaves_no_chunk_behind(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "CHUNK_ITEMS", 2)
    names = spark.createDataFrame([("s",)], "name string")

    def documents(n, at):
        items = spark.createDataFrame([("s", "stock_id", f"v{i}") for i in range(n)], "seed_set_name string, kind string, value string")
        return S.seed_documents(names, items, F.lit(at).cast("timestamp"), 2)

    table = LogTable.named(spark, str(tmp_path), "compiled_seed_sets")
    table.append(documents(20, NOW), 1)
    small = documents(2, NOW + timedelta(hours=1))
    table.append(small.unionByName(S.emptied_chunks(table.read(), small)), 2)
    rows = table.read().collect()
    assert len({r.refreshed_at for r in rows}) == 1
    assert sorted(v for r in rows for v in json.loads(r.seed_json)["stock_ids"]) == ["v0", "v1"]


def test_tree_rounds_look_up_pending_anchors_only(spark, monkeypatch):
    """Two long threads among many short ones: after the first rounds only the long ones are looked at."""
    rows = [("x", f"p{i}", str(j), str(j - 1) if j else None) for i in range(200) for j in range(2)]
    rows += [("x", "long", str(j), str(j - 1) if j else None) for j in range(100)]
    df = spark.createDataFrame(rows, "source string, post_entity_id string, source_entity_id string, parent_comment_entity_id string")
    df = df.withColumns({"published_at": F.lit(None).cast("timestamp"), "fetched_at": F.current_timestamp()})
    sizes, plain = [], threads.pointed_at

    def counted(rows, pending):
        out = plain(rows, pending)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(threads, "pointed_at", counted)
    depths = {(r.post_entity_id, int(r.source_entity_id)): r.depth for r in threads.comment_tree(df).collect()}
    assert all(d == j for (_, j), d in depths.items()) and len(depths) == len(rows)
    assert sizes[0] <= 200 + 99 and sizes[1] <= 98 and sizes == sorted(sizes, reverse=True)


def test_repeats_of_a_hot_key_are_dropped_before_the_shuffle(spark, tmp_path):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), F.timestamp_seconds("id").alias("ts"))
    rows.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    job = jobs.without_repeats(stream, "ts", ["k"], "1 day").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    job = job.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    job.awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted({"hot", *(f"k{i}" for i in range(500))})
    dropped = sum(json.loads(p.json)["stateOperators"][0]["customMetrics"].get("numDroppedDuplicateRows", 0) for p in job.recentProgress)
    assert dropped < 10_000


def test_event_time_upsert_over_restarts(spark, tmp_path):
    schema = "source string, source_entity_id string, display_name string, fetched_at timestamp, seq int"
    table, home = LogTable.named(spark, str(tmp_path / "t"), "authors"), str(tmp_path)
    arrivals = [[("x", "1", "new", NOW, 1), ("x", "2", "first", NOW, 1), ("x", "3", "undated", None, 1)],
                [("x", "1", "old", NOW - timedelta(days=1), 2), ("x", "2", "same time", NOW, 2), ("x", "3", "dated", NOW - timedelta(days=9), 2)],
                [("x", "1", "undated", None, 3), ("x", "4", "own", NOW - timedelta(days=5), 3)]]
    for rows in arrivals:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{home}/src")
        stream = spark.readStream.schema(schema).parquet(f"{home}/src")
        jobs.upsert_by_event_time(stream, table, "fetched_at", ["seq"], f"{home}/cp").awaitTermination()
    assert {r.source_entity_id: r.display_name for r in table.read().collect()} == {"1": "new", "2": "same time", "3": "dated", "4": "own"}
