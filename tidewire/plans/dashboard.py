"""The status report: five independent plans, and one flat relation of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.readers import latest_run, recent_errors, recent_runs, recent_url_activity
from tidewire.operators.seeds import read_documents, seed_inventory


def status(
    runs: DataFrame,
    errors: DataFrame,
    url_state: DataFrame,
    snapshots: DataFrame,
    *,
    now: Column,
    runs_limit: int = 10,
    errors_limit: int = 20,
) -> dict[str, DataFrame]:
    return {
        "latest_run": latest_run(runs),
        "recent_runs": recent_runs(runs, runs_limit),
        "recent_errors": recent_errors(errors, errors_limit),
        "in_flight_urls": recent_url_activity(url_state, now),
        "seed_sets": seed_inventory(read_documents(snapshots)),
    }


def overview(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows (section, name, at, n): enough to render the status page from one result."""
    columns = {
        "latest_run": (F.col("run_id"), F.col("started_at"), F.col("tasks_enqueued")),
        "recent_runs": (F.col("run_id"), F.col("started_at"), F.col("tasks_enqueued")),
        "recent_errors": (F.col("url"), F.col("created_at"), F.length("error_message")),
        "in_flight_urls": (F.lit(""), F.lit(None).cast("timestamp"), F.col("recent_urls")),
        "seed_sets": (
            F.col("name"),
            F.col("refreshed_at"),
            F.col("stock_count") + F.col("topic_count") + F.col("user_count") + F.col("bilibili_video_count")
            + F.col("bilibili_space_count") + F.col("post_url_count"),
        ),
    }
    result = None
    for section, part in parts.items():
        name, at, n = columns[section]
        rows = part.select(
            F.lit(section).alias("section"), name.alias("name"), at.alias("at"), n.cast("bigint").alias("n")
        )
        result = rows if result is None else result.unionByName(rows)
    return result
