"""Streaming jobs over several micro-batches and restarts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.operators.frontier import FreshnessPolicy
from tidewire.sources.tables import LogTable
from tidewire.streaming import jobs
from tidewire.workload import streams
from tidewire.workload.registry import Tables

AUTHOR = "source string, source_entity_id string, display_name string, seq int"
TASK = "url string, kind string, source string, seed_name string, priority int, metadata map<string,string>, seq long"


def feed(spark, path, rows, schema):
    """Each call adds one file, which is one micro-batch."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_upsert_over_batches_and_restart(spark, tmp_path):
    src, home = str(tmp_path / "src"), str(tmp_path / "home")
    table = LogTable.named(spark, home, "authors")
    stream = feed(spark, src, [("x", "1", "first", 9), ("x", "2", "b", 1)], AUTHOR)
    jobs.upsert_stream(stream, table, ["seq"], f"{home}/cp").awaitTermination()
    # A later batch wins although its order number is lower.
    stream = feed(spark, src, [("x", "1", "late", 1)], AUTHOR)
    jobs.upsert_stream(stream, table, ["seq"], f"{home}/cp").awaitTermination()
    got = sorted((r.source_entity_id, r.display_name) for r in table.read().collect())
    assert got == [("1", "late"), ("2", "b")]


def test_claims_across_batches(spark, tmp_path):
    src, home = str(tmp_path / "src"), str(tmp_path / "home")
    state = LogTable.named(spark, home, "url_state")
    clock = {"now": "2026-04-15 12:00:00"}

    def step(now, *urls):
        clock["now"] = now
        stream = feed(spark, src, [(u, "fetch_post", "x", "s", 1, {}, i) for i, u in enumerate(urls)], TASK)
        jobs.claim_stream(
            stream, state, f"{home}/claims", f"{home}/cp", now=lambda: F.lit(clock["now"]).cast("timestamp"),
            policy=FreshnessPolicy(post_recrawl=60),
        ).awaitTermination()
        return spark.read.parquet(f"{home}/claims").count()

    assert step("2026-04-15 12:00:00", "a", "a", "b") == 2
    assert step("2026-04-15 12:30:00", "a", "c") == 3      # a is fresh
    assert step("2026-04-15 13:00:01", "a", "b", "c") == 5  # c is fresh


def test_seed_items_keep_first_seen(spark, tmp_path):
    src, home = str(tmp_path / "src"), str(tmp_path / "home")
    state = LogTable.named(spark, home, "generated_seed_items")
    schema = "logical_set_name string, generator_name string, item_kind string, item_value string, at timestamp_ntz"
    for day in (1, 2):
        rows = spark.sql(f"SELECT 's' a, 'g' b, 'user_id' c, 'v' d, TIMESTAMP_NTZ '2026-04-0{day}' e").collect()
        stream = feed(spark, src, rows, schema)
        jobs.seed_item_stream(stream, state, f"{home}/cp", "at").awaitTermination()
    row = state.read().select(F.col("first_seen_at").cast("string"), F.col("last_seen_at").cast("string")).first()
    assert tuple(row) == ("2026-04-01 00:00:00", "2026-04-02 00:00:00")


def test_late_sightings_widen_the_span(spark, tmp_path):
    src, home = str(tmp_path / "src"), str(tmp_path / "home")
    state = LogTable.named(spark, home, "generated_seed_items")
    schema = "logical_set_name string, generator_name string, item_kind string, item_value string, at timestamp_ntz"
    for day in (10, 12, 2):
        rows = spark.sql(f"SELECT 's' a, 'g' b, 'user_id' c, 'v' d, TIMESTAMP_NTZ '2026-04-{day:02d}' e").collect()
        jobs.seed_item_stream(feed(spark, src, rows, schema), state, f"{home}/cp", "at").awaitTermination()
    row = state.read().select(F.col("first_seen_at").cast("string"), F.col("last_seen_at").cast("string")).first()
    assert tuple(row) == ("2026-04-02 00:00:00", "2026-04-12 00:00:00")


def test_streams_with_own_checkpoints_share_a_table(spark, tmp_path):
    home = str(tmp_path / "home")
    table = LogTable.named(spark, home, "authors")
    for n, name in enumerate(("one", "two", "three")):
        stream = feed(spark, str(tmp_path / f"src{n}"), [("x", name, name, 1), ("x", "shared", name, 1)], AUTHOR)
        jobs.upsert_stream(stream, table, ["seq"], f"{home}/cp{n}").awaitTermination()
    got = sorted((r.source_entity_id, r.display_name) for r in table.read().collect())
    assert got == [("one", "one"), ("shared", "three"), ("three", "three"), ("two", "two")]


def test_stream_sees_claims_of_batch_jobs(spark, tmp_path):
    src, home = str(tmp_path / "src"), str(tmp_path / "home")
    state = LogTable.named(spark, home, "url_state")
    now = F.lit("2026-04-15 12:00:00").cast("timestamp")
    taken = spark.createDataFrame([("a", "x", "fetch_post", "s")], "url string, source string, kind string, seed_name string")
    state.append(taken.withColumns({"first_seen_at": now, "last_fetched_at": now, "last_status": F.lit(200)}), 11, writer="cycle")
    stream = feed(spark, src, [(u, "fetch_post", "x", "s", 1, {}, i) for i, u in enumerate("ab")], TASK)
    jobs.claim_stream(
        stream, state, f"{home}/claims", f"{home}/cp", now=lambda: F.lit("2026-04-15 12:01:00").cast("timestamp"),
        policy=FreshnessPolicy(post_recrawl=60),
    ).awaitTermination()
    assert [r.url for r in spark.read.parquet(f"{home}/claims").collect()] == ["b"]


def test_activity_rows_are_dealt_before_they_are_counted_per_window(spark, tmp_path, monkeypatch):
    """Each row is in twelve windows; a task holds its part of the rows only, however few files there are."""
    path = str(tmp_path / "src")
    spark.range(1000).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), (F.col("id") % 7).alias("url")).coalesce(1).write.parquet(path)
    counted = jobs.rolling_activity(spark.readStream.schema("ts timestamp, url long").parquet(path), "ts", "url")
    plan = counted._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.index("Expand") < plan.index("RepartitionByExpression [ts")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(streams, "STATE_ROWS", 30)
    with streams._state_partitions(Tables(spark, ""), spark.range(1000)):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "34"
        job = counted.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        job = job.trigger(availableNow=True).start()
        job.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    assert {s.numShufflePartitions for p in job.recentProgress for s in p.stateOperators} == {34}
    got = {r.window_end.timestamp(): r.recent_urls for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {e: len({i % 7 for i in range(1000) if e - 3600 <= 60 * i < e}) for e in range(300, 59941 - 600, 300)}
    assert got == want
