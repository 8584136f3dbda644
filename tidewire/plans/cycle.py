"""One crawl cycle over captured pages.

A crawler would work off a priority queue that grows meanwhile. Its depth is bounded: discover
yields fetch_post, fetch_post yields refresh_comments. So a cycle is three batch passes, each
claim, join with the captured pages, parse, store. Every pass writes its claims and outcomes
before anything is derived from them.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import runs as R
from tidewire.operators.frontier import FreshnessPolicy, claim_winners, claimed_state, comments_due, pubdate
from tidewire.operators.upsert import changed_rows
from tidewire.schemas import RAW_PAGES, RUN_COUNTERS, conform
from tidewire.session import drop_dir, run_dir
from tidewire.sources.captures import newest
from tidewire.sources.registry import ADAPTERS
from tidewire.sources.tables import LogTable
from tidewire.streaming.jobs import store_outcomes

# Name of the cycle among the writers of the stored tables, and those it appends to in numbered steps.
_WRITER = "cycle"
_TABLES = ("url_state", "item_state", "posts", "authors", "comments", "crawl_errors")
_TASK = ["source", "kind", "url", "seed_name", "priority", "metadata", "seq"]
_FACTS = [*_TASK, "status_code", "blocked", "error"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _page_counts() -> dict[str, Column]:
    """Counters of a stage of fetched pages; a block counts as blocked and as error."""
    return {"pages_fetched": _rows(), "blocked_responses": F.count_if(F.col("blocked")), "errors": F.count("error")}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _later() -> list[Column]:
    """Queue order as ascending columns: what is worked off later is larger."""
    return [-F.col("priority"), -pubdate(), F.col("seq")]


def _seq(stage: int, adapter: Column, *, parent: str | None = None, pos: Column | None = None) -> Column:
    """Arrival order as a struct: seed tasks by seed, adapter and position; discovered tasks by
    when their parent leaves the queue, then position."""
    zero = F.lit(0).cast("bigint")
    if parent is None:
        parts = (zero, zero, F.col("seed_name"), adapter, pos.cast("bigint"), zero)
    else:
        parent_pub = F.coalesce(F.col(f"{parent}.metadata")["pubdate_ts"].try_cast("bigint"), zero)
        parts = (
            -F.col(f"{parent}.priority").cast("bigint"), -parent_pub, F.col(f"{parent}.seed_name"), adapter,
            F.col(f"{parent}.seq.pos"), pos.cast("bigint"),
        )
    names = ("priority", "pubdate", "seed", "adapter", "pos", "child")
    return F.struct(F.lit(stage).alias("stage"), *[p.alias(n) for p, n in zip(parts, names)])


def run_cycle(
    spark: SparkSession,
    root: str,
    seeds: DataFrame,
    captured: DataFrame,
    *,
    run_id: str,
    batch_id: int,
    now: datetime,
    policy: FreshnessPolicy = FreshnessPolicy(),
    adapters: Mapping[str, Any] = ADAPTERS,
) -> DataFrame:
    """Run one cycle and return its stored run row. A failure is stored too, then raised.

    `seeds` are seed definitions, `captured` the captured pages (see RAW_PAGES). Batch ids must
    grow from cycle to cycle; repeating a failed cycle under its id is safe.
    """
    runs = LogTable.named(spark, root, "crawl_runs")
    cycle = _Cycle(spark, root, captured, batch_id, now, policy, adapters)
    try:
        cycle.run(seeds)
    except Exception:
        # What the stages written so far counted, and the failure itself.
        cycle.counters["errors"] += 1
        _store_run(runs, cycle.counters, run_id, now, "failed", batch_id)
        drop_dir(spark, cycle.home)
        raise
    _store_run(runs, cycle.counters, run_id, now, "succeeded", batch_id)
    drop_dir(spark, cycle.home)  # all of it is in the stored tables now
    return R.run_rows(runs.read().where(F.col("run_id") == run_id))


def _store_run(runs: LogTable, counters: Mapping[str, int], run_id: str, now: datetime, status: str, batch_id: int) -> None:
    counted = [F.lit(counters[c]).cast("bigint").alias(c) for c in RUN_COUNTERS]
    row = runs.spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(now).cast("timestamp").alias("started_at"),
        F.current_timestamp().alias("finished_at"), F.lit(status).alias("status"), *counted,
        F.lit(0).alias("_order"),
    )
    known = runs.read(batch_id, writer=_WRITER)
    runs.append(
        changed_rows(known, row, ["run_id"], ["_order"], preserve=["started_at"]), batch_id, writer=_WRITER
    )


class _Cycle:
    def __init__(self, spark, root, captured, batch_id, now, policy, adapters):
        self.spark, self.root, self.policy, self.adapters = spark, root, policy, adapters
        for name, default in (("page_no", F.lit(1)), ("section", F.lit("main"))):
            if name not in captured.columns:
                captured = captured.withColumn(name, default)
        self.captured = conform(captured, RAW_PAGES)
        self.now = F.lit(now).cast("timestamp")
        self.home = run_dir(spark, "cycle")
        self.counters = dict.fromkeys((*RUN_COUNTERS, "claimed"), 0)
        # Room for the appends a cycle makes to one table.
        self.first = batch_id * 10
        self.urls = LogTable.named(spark, root, "url_state")
        for name in _TABLES:  # what a failed attempt of this cycle left
            LogTable.named(spark, root, name).retract(_WRITER, self.first)

    def stored(self, df: DataFrame, name: str, **counted: Column) -> DataFrame:
        """Write a stage to the shared folder and continue from the files. `counted` are aggregates
        observed while it is written, which add to the counters of those names."""
        path = f"{self.home}/{name}"
        seen = Observation(name)
        (df.observe(seen, *[c.alias(n) for n, c in counted.items()]) if counted else df).write.parquet(path)
        if counted:
            found = seen.get
            for n in counted:
                self.counters[n] += found.get(n) or 0
            # Every task enqueued so far is either claimed or, once its pass has claimed, skipped.
            if "claimed" in counted:
                self.counters["skipped_tasks"] = self.counters["tasks_enqueued"] - self.counters["claimed"]
        return self.spark.read.parquet(path)

    def adapter_no(self) -> Column:
        numbers = F.create_map(*[x for n, s in enumerate(self.adapters) for x in (F.lit(s), F.lit(n))])
        return numbers[F.col("source")]

    def claim(self, tasks: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
        """Claimed tasks and the newest captures of their pages. The captured table is scanned once
        per pass for the page keys and once for the chosen pages, here; what is parsed later is the
        stored part of it that was claimed."""
        before = self.urls.read(self.first + step, tasks, _WRITER)
        winners = claim_winners(tasks, before, now=self.now, policy=self.policy)
        won = self.stored(winners, f"claims{step}", claimed=_rows())
        self.urls.append(claimed_state(won, now=self.now), self.first + step, writer=_WRITER)
        pages = newest(self.captured, won, self.now)
        return won.select(*_TASK), self.stored(pages.select(*RAW_PAGES.names), f"pages{step}")

    def with_tasks(self, tasks: DataFrame) -> dict[str, Any]:
        """The adapters that have work; at most one row per adapter reaches the driver."""
        present = {r["source"] for r in tasks.select("source").distinct().collect()}
        return {s: a for s, a in self.adapters.items() if s in present}

    def of(self, df: DataFrame, source: str) -> DataFrame:
        return df.where(F.col("source") == source)

    def run(self, seeds: DataFrame) -> None:
        self.counters["seeds_processed"] = seeds.agg(F.count_distinct("name")).first()[0]
        expanded = [a.expand(seeds) for a in self.adapters.values()]
        seeded = self.stored(
            _union(expanded).withColumn("seq", _seq(0, self.adapter_no(), pos=F.col("pos"))).select(*_TASK), "seeded",
            tasks_enqueued=_rows(),
        )
        first, pages = self.claim(seeded, 1)

        discovering = first.where("kind = 'discover'")
        outcomes, links = [], []
        for source, adapter in self.with_tasks(discovering).items():
            seen, found = adapter.discover(self.of(discovering, source), pages)
            outcomes.append(seen.select(*_FACTS))
            links.append(found.withColumn("seq", _seq(1, self.adapter_no(), parent="parent", pos=F.col("pos"))).select(*_TASK))
        nothing = first.limit(0)
        unseen = nothing.select(
            *_TASK, F.lit(0).alias("status_code"), F.lit(False).alias("blocked"), F.lit(None).cast("string").alias("error")
        )
        visited = self.stored(_union([unseen, *outcomes]), "visited", **_page_counts()) if outcomes else unseen
        second, more = nothing, pages.limit(0)
        if links:
            discovered = self.stored(_union(links), "discovered", tasks_enqueued=_rows())
            second, more = self.claim(discovered, 2)

        fetching, pages = first.where("kind = 'fetch_post'").unionByName(second), pages.unionByName(more)
        parsed = [
            a.parse(a.with_page(self.of(fetching, s), pages)).select(*_FACTS, "post", "author", "fetched_at")
            for s, a in self.with_tasks(fetching).items()
        ]
        if not parsed:
            a = next(iter(self.adapters.values()))
            parsed = [a.parse(a.with_page(nothing, pages)).select(*_FACTS, "post", "author", "fetched_at")]
        fetched = self.stored(
            _union(parsed), "fetched", posts_written=F.count("post"), authors_written=F.count("author"), **_page_counts()
        )
        self.store_entities(visited, fetched)
        self.mark_fetched(visited.select("url", "status_code").unionByName(fetched.select("url", "status_code")), 4)

        posts = self.posts_of(fetched)
        items = LogTable.named(self.spark, self.root, "item_state")
        self.store_items(items, posts)
        due = comments_due(posts.drop("_order"), items.read(self.first + 2, posts, _WRITER), now=self.now, min_age=self.policy.comment_refresh)
        refresh = [
            a.comment_tasks(self.of(due, s)).withColumn(
                "_parent", F.col("metadata")["post_id"]
            )
            for s, a in self.adapters.items()
        ]
        numbered = _union(refresh).withColumn(
            "seq",
            F.struct(
                F.lit(2).alias("stage"), F.col("source").alias("source"), F.col("_parent").alias("post"),
                F.col("seed_name").alias("seed"),
            ),
        )
        refreshing = self.stored(numbered.select(*_TASK), "refreshing", tasks_enqueued=_rows())
        third, pages = self.claim(refreshing, 5)

        threads = [
            a.comments(self.of(third, s), pages).select(
                "source", "source_entity_id", "post_entity_id", "canonical_url", "author_entity_id",
                "parent_comment_entity_id", "content_text", "published_at", "fetched_at", "like_count",
                F.struct("page_no", "pos").alias("_order"),
            )
            for s, a in (self.with_tasks(third) or self.adapters).items()
        ]
        comments = self.stored(_union(threads), "comments", comments_written=_rows())
        LogTable.named(self.spark, self.root, "comments").append(comments, self.first, ["_order"], _WRITER)
        self.mark_refreshed(items, comments)
        self.mark_fetched(third.select("url", F.lit(200).alias("status_code")), 6)

    def posts_of(self, fetched: DataFrame) -> DataFrame:
        return fetched.where("post is not null").select("post.*", "seed_name", F.struct(*_later()).alias("_order"))

    def store_entities(self, visited: DataFrame, fetched: DataFrame) -> None:
        nothing = [F.lit(None).cast(fetched.schema[c].dataType).alias(c) for c in ("post", "author")]
        failed = visited.where("error is not null").select(*_FACTS, *nothing, self.now.alias("fetched_at"))
        stamped = fetched.withColumn("fetched_at", F.coalesce("fetched_at", self.now))
        order = dict(zip(("_o1", "_o2", "_o3"), _later()))
        store_outcomes(self.spark, self.root, stamped.unionByName(failed).withColumns(order), self.first, list(order), _WRITER)

    def store_items(self, items: LogTable, posts: DataFrame) -> None:
        rows = posts.select(
            "source", "source_entity_id", "canonical_url", self.now.alias("last_fetched_at"),
            F.lit(None).cast("timestamp").alias("last_comment_refresh_at"),
            F.to_json(F.struct("canonical_url")).alias("metadata_json"), "_order",
        )
        known = items.read(self.first + 1, rows, _WRITER)
        images = changed_rows(known, rows, list(items.keys), ["_order"], preserve=["last_comment_refresh_at"])
        items.append(images, self.first + 1, writer=_WRITER)

    def mark_refreshed(self, items: LogTable, comments: DataFrame) -> None:
        """Posts that got comments were refreshed now; unknown posts are not inserted."""
        done = comments.select("source", F.col("post_entity_id").alias("source_entity_id")).distinct()
        marked = items.read(self.first + 2, done, _WRITER).withColumn("last_comment_refresh_at", self.now)
        items.append(marked, self.first + 2, writer=_WRITER)

    def mark_fetched(self, statuses: DataFrame, step: int) -> None:
        known = self.urls.read(self.first + step, statuses, _WRITER)
        rows = known.join(statuses.withColumnRenamed("status_code", "_status"), "url")
        marked = rows.withColumns({"last_fetched_at": self.now, "last_status": F.col("_status").cast("int")})
        self.urls.append(marked.drop("_status"), self.first + step, writer=_WRITER)
