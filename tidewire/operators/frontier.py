"""Frontier ordering, freshness policy and the per-URL claim."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.session import cut_lineage


@dataclass(frozen=True)
class FreshnessPolicy:
    """Minimum ages in minutes before a URL may be fetched again."""

    post_recrawl: int = 360
    comment_refresh: int = 60
    space_discovery: int = 60


def min_age_minutes(policy: FreshnessPolicy) -> Column:
    kind = F.col("kind")
    space = (F.col("source") == "bilibili") & (F.col("metadata")["seed_kind"] == "space")
    return (
        F.when((kind == "discover") & F.coalesce(space, F.lit(False)), policy.space_discovery)
        .when(kind.isin("discover", "refresh_comments"), policy.comment_refresh)
        .otherwise(policy.post_recrawl)
    )


def pubdate() -> Column:
    return F.coalesce(F.col("metadata")["pubdate_ts"].try_cast("bigint"), F.lit(0).cast("bigint"))


def queue_order() -> list[Column]:
    """Priority first, then newer content, then arrival; `seq` is unique, so the order is total."""
    return [F.col("priority").desc(), pubdate().desc(), F.col("seq").asc()]


def in_queue_order(frontier: DataFrame) -> DataFrame:
    return frontier.orderBy(*queue_order())


def with_positions(ordered: DataFrame, name: str = "queue_pos") -> DataFrame:
    """Add exact 1-based positions to a sorted frame without a single-task window.

    The sorted rows are checkpointed, so partition ids and row ids stay fixed; only one count
    per partition is ranked, and those counts are as many as partitions.
    """
    row_id = F.monotonically_increasing_id()
    fixed = cut_lineage(ordered.withColumn("_row", row_id))
    rows = fixed.withColumns(
        {"_part": F.shiftright("_row", 33), "_index": F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = rows.groupBy("_part").agg((F.max("_index") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    placed = rows.join(F.broadcast(offsets), "_part")
    return placed.select(
        *[c for c in ordered.columns], (F.col("_offset") + F.col("_index") + 1).cast("bigint").alias(name)
    )


def claim_winners(frontier: DataFrame, url_state: DataFrame, *, now: Column, policy: FreshnessPolicy) -> DataFrame:
    """The one task per URL that may run, with the URL's stored state as `_state`.

    In queue order the first task whose age gate passes wins; every other task of the URL then
    finds it fresh. The gate depends on the URL and the minimum age only, so tasks are first
    reduced to the best one per (URL, age), with partial aggregation: a URL that holds a third
    of the frontier reaches the join as a handful of rows.
    """
    order = F.struct(-F.col("priority"), -pubdate(), F.col("seq"))
    best = frontier.groupBy("url", min_age_minutes(policy).alias("_age")).agg(
        F.min_by(F.struct(*frontier.columns), order).alias("_task")
    )
    stored = url_state.select("url", F.struct(*url_state.columns).alias("_state"))
    fetched = F.col("_state.last_fetched_at")
    stale = fetched.isNull() | (fetched < now - F.make_dt_interval(mins=F.col("_age")))
    task_order = F.struct(
        -F.col("_task.priority"),
        -F.coalesce(F.col("_task.metadata")["pubdate_ts"].try_cast("bigint"), F.lit(0).cast("bigint")),
        F.col("_task.seq"),
    )
    winners = (
        best.join(stored, "url", "left")
        .where(stale)
        .groupBy("url")
        .agg(F.min_by(F.struct("_task", "_state"), task_order).alias("_win"))
    )
    return winners.select("_win._task.*", F.col("_win._state").alias("_state"))


def claimed_state(winners: DataFrame, *, now: Column) -> DataFrame:
    """New url_state rows of the claimed URLs; losers change nothing."""
    return winners.select(
        "url", "source", "kind", "seed_name",
        F.coalesce(F.col("_state.first_seen_at"), now).alias("first_seen_at"),
        now.alias("last_seen_at"),
        now.alias("last_fetched_at"),
        F.col("_state.last_status").alias("last_status"),
    )


def claim(frontier: DataFrame, url_state: DataFrame, *, now: Column, policy: FreshnessPolicy) -> DataFrame:
    """Every task with `claimed` true or false. Joined back on the unique `seq`, not on the URL."""
    won = claim_winners(frontier, url_state, now=now, policy=policy).select("seq", F.lit(True).alias("_won"))
    joined = frontier.join(won, "seq", "left")
    return joined.select(*frontier.columns, F.coalesce("_won", F.lit(False)).alias("claimed"))


def comments_due(posts: DataFrame, item_state: DataFrame, *, now: Column, min_age: int) -> DataFrame:
    """Posts whose comments were never refreshed, or at least `min_age` minutes ago."""
    keys = ["source", "source_entity_id"]
    known = item_state.select(*keys, F.col("last_comment_refresh_at").alias("_refreshed"))
    refreshed = F.col("_refreshed")
    due = refreshed.isNull() | (refreshed <= now - F.expr(f"interval {int(min_age)} minutes"))
    return posts.join(known, keys, "left").where(due).drop("_refreshed")
