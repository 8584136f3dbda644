"""Paged listings: end of a listing, first-seen dedupe, per-owner caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.upsert import first_by_key


# Pages that are looked at together when a missing one is searched.
_RUN = 1024


def listing_ends(
    pages: DataFrame, listing: Sequence[str], *, dead: Column, final: Column, page: str = "page_no", max_pages: int | None = None
) -> DataFrame:
    """How far a reader gets that asks for page 1, 2, ... of each listing, up to `max_pages` of them.

    It stops before the first page that is missing or `dead`, and after the first one that is
    `final`. `last_page` is the last page it keeps, `read_to` the last one it asked for and got
    an answer to. Two aggregates with partial combine, the first over runs of pages, so that a
    group holds at most a thousand page numbers, and then one number per run.
    """
    number = F.col(page)
    asked = number >= 1 if max_pages is None else number.between(1, max_pages)
    run = F.floor((number - 1) / _RUN).cast("int")
    runs = pages.where(asked).groupBy(*listing, run.alias("_run")).agg(
        F.min(F.when(dead, number)).alias("_dead"), F.min(F.when(final & ~dead, number)).alias("_final"),
        F.collect_set(number.cast("int")).alias("_seen"),
    )
    start = F.col("_run") * _RUN
    gap = F.array_min(F.array_except(F.sequence(start + 1, start + _RUN), F.col("_seen")))
    facts = runs.withColumn("_gap", gap).groupBy(*listing).agg(
        F.min("_dead").alias("_dead"), F.min("_final").alias("_final"), F.min("_gap").alias("_gap"), F.collect_set("_run").alias("_runs"),
    )
    absent = F.array_min(F.array_except(F.sequence(F.lit(0), F.size("_runs")), F.col("_runs"))) * _RUN + 1
    # `least` leaves out nulls.
    known = facts.withColumn("_whole", F.least("_gap", absent) - 1)
    return known.select(
        *listing, F.least("_whole", F.col("_dead") - 1, "_final").alias("last_page"), F.least("_whole", "_dead", "_final").alias("read_to")
    )


def page_novelty(rows: DataFrame, listing: Sequence[str], item: str, page: str = "page") -> DataFrame:
    """Per page of a listing: distinct ids, and how many of them no earlier page had.

    Only aggregates with partial combine: an item counts as new on its lowest page, so no page
    is compared with another.
    """
    listing = list(listing)
    ids = rows.groupBy(*listing, page).agg(F.count_distinct(item).alias("ids"))
    first = rows.where(F.col(item).isNotNull()).groupBy(*listing, item).agg(F.min(page).alias(page))
    fresh = first.groupBy(*listing, page).agg(F.count("*").alias("_new"))
    return ids.join(fresh, [*listing, page], "left").select(
        *listing, page, F.col("ids").cast("bigint").alias("ids"),
        F.coalesce("_new", F.lit(0)).cast("bigint").alias("new_ids"),
    )


def until_repeated_page(rows: DataFrame, listing: Sequence[str], item: str, page: str = "page") -> DataFrame:
    """Rows of the pages before the first one that has ids but nothing new."""
    listing = list(listing)
    stops = (
        page_novelty(rows, listing, item, page)
        .where("ids > 0 and new_ids = 0")
        .groupBy(*listing)
        .agg(F.min(page).alias("_stop"))
    )
    joined = rows.join(stops, listing, "left")
    return joined.where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop")


def first_seen(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return first_by_key(rows, keys, order)


def cap_per_owner(rows: DataFrame, owner: Sequence[str], order: Sequence[str | Column], limit: int) -> DataFrame:
    """At most `limit` rows per owner in listing order; limited on the map side as well."""
    return first_by_key(rows, owner, order, limit)
