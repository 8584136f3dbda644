"""Run statistics and run-row projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.times import duration_label, duration_ms
from tidewire.schemas import RUN_COUNTERS


def run_stats(tasks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counters per run over its tasks.

    `tasks` has run_id, seed_name, kind, claimed, blocked, errors, posts, comments, authors (the
    last four as counts before dedupe). Pages exclude comment refreshes; their failures count
    nowhere; a block counts as blocked and as error.
    """
    keys = keys or ["run_id"]
    ran = F.col("claimed")
    page = ran & (F.col("kind") != "refresh_comments")

    def total(condition, value):
        return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0)).cast("bigint")

    # One row per (run, seed) first: a distinct count then needs no expanded rows.
    by_seed = tasks.groupBy(*keys, "seed_name").agg(
        F.count("*").alias("tasks_enqueued"),
        F.count_if(page).alias("pages_fetched"),
        total(page, "posts").alias("posts_written"),
        total(ran & ~page, "comments").alias("comments_written"),
        total(page, "authors").alias("authors_written"),
        F.count_if(page & F.col("blocked")).alias("blocked_responses"),
        total(page, "errors").alias("errors"),
        F.count_if(~ran).alias("skipped_tasks"),
    )
    sums = [F.sum(c).cast("bigint").alias(c) for c in RUN_COUNTERS if c != "seeds_processed"]
    return by_seed.groupBy(*keys).agg(F.count("seed_name").cast("bigint").alias("seeds_processed"), *sums)


def run_rows(runs: DataFrame) -> DataFrame:
    """Stored runs with defaults: null counters are zero, a null status is empty."""
    return runs.select(
        "run_id",
        "started_at",
        "finished_at",
        F.coalesce("status", F.lit("")).alias("status"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in RUN_COUNTERS],
    )


def with_duration(runs: DataFrame) -> DataFrame:
    ms = duration_ms(F.col("started_at"), F.col("finished_at"))
    return runs.withColumn("duration_ms", ms).withColumn("duration", duration_label(F.col("duration_ms")))
