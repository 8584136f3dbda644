"""Seed generators, catalog checks, TTL, compilation and inventory.

A compiled set is kept long, one row per (set, kind, value), because a single set may hold a
third of all items. Snapshots store it as JSON documents of bounded size, as many as the values
need, dealt by value hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.times import window_start
from tidewire.schemas import HOMEPAGE_KIND, SEED_DEFINITION, SEED_KINDS

# Rank given to entries without one, so they sort last (fixed value).
NO_RANK = 999999
CHUNK_ITEMS = 10_000


def _minutes(n: int) -> Column:
    return F.expr(f"interval {int(n)} minutes")


def _tagged(kind: str, values: Column) -> Column:
    """Array of values to array of (kind, value)."""
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def definition_items(definitions: DataFrame) -> DataFrame:
    """List entries of seed definitions as (seed_set_name, kind, value), without the homepage flag."""
    lists = F.concat(*[_tagged(kind, F.col(column)) for kind, column in SEED_KINDS.items()])
    return definitions.select(F.col("name").alias("seed_set_name"), F.inline(lists))


def manual_items(definitions: DataFrame) -> DataFrame:
    """Literal lists of seed definitions as (name, kind, value) rows; one pass, no unions."""
    homepage = F.when(F.col("discover_homepage"), F.array(F.lit("true"))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    lists = [(HOMEPAGE_KIND, homepage)] + [
        (kind, F.coalesce(F.col(column), none)) for kind, column in SEED_KINDS.items()
    ]
    return definitions.select("name", F.inline(F.concat(*[_tagged(kind, values) for kind, values in lists])))


def stock_universe_items(
    universe: DataFrame,
    *,
    markets: Sequence[str] = (),
    boards: Sequence[str] = (),
    prefixes: Sequence[str] = (),
    include_tags: Sequence[str] = (),
    exclude_tags: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Stocks that pass every filter, by id. An empty filter list does not filter."""
    rows = universe
    if markets:
        rows = rows.where(F.col("market").isin(*markets))
    if boards:
        rows = rows.where(F.col("board").isin(*boards))
    if prefixes:
        rows = rows.where(reduce(lambda a, b: a | b, [F.startswith("stock_id", F.lit(p)) for p in prefixes]))

    def tagged(wanted: Sequence[str]) -> Column:
        # Null when undecided because of null elements, which counts as no overlap.
        return F.coalesce(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in wanted])), F.lit(False))

    if include_tags:
        rows = rows.where(tagged(include_tags))
    if exclude_tags:
        rows = rows.where(~tagged(exclude_tags))
    items = rows.select(F.lit("stock_id").alias("kind"), F.col("stock_id").alias("value")).orderBy("value")
    return items if limit is None else items.limit(limit)


def ranking_items(
    entries: DataFrame,
    *,
    as_of: datetime | date,
    since_date: date | None = None,
    days_window: int | None = None,
    markets: Sequence[str] = (),
    ranking_modes: Sequence[str] = (),
    top_n: int | None = None,
) -> DataFrame:
    """Distinct stocks by newest trade date, then rank, then id.

    The first entry of a stock is the minimum of its sort key, so a plain aggregate with
    partial combine replaces a window, and top-n is a bounded sort.
    """
    rows = entries
    if since_date is not None:
        rows = rows.where(F.col("trade_date") >= F.lit(since_date))
    if days_window is not None:
        rows = rows.where(F.col("trade_date") >= window_start(F.lit(as_of), days_window))
    if markets:
        rows = rows.where(F.col("market").isin(*markets))
    if ranking_modes:
        rows = rows.where(F.col("ranking_mode").isin(*ranking_modes))
    # One bigint per entry keeps the aggregate on the hash path: day descending, rank ascending.
    rank = F.coalesce(F.col("rank"), F.lit(NO_RANK)).cast("bigint")
    key = -F.unix_date(F.col("trade_date").cast("date")).cast("bigint") * F.lit(1 << 33) + rank
    best = rows.groupBy("stock_id").agg(F.min(key).alias("_key")).orderBy("_key", "stock_id")
    if top_n is not None:
        best = best.limit(top_n)
    return best.select(F.lit("stock_id").alias("kind"), F.col("stock_id").alias("value"))


def catalog_problems(logical_sets: DataFrame, generators: DataFrame) -> DataFrame:
    """Rows (problem, name, reference) for duplicate names and unknown generator references.

    `logical_sets` has `name` and the array `generators`; `generators` has `name`.
    """

    def duplicates(df: DataFrame, problem: str) -> DataFrame:
        many = df.groupBy("name").count().where("count > 1")
        return many.select(F.lit(problem).alias("problem"), "name", F.lit(None).cast("string").alias("reference"))

    references = logical_sets.select("name", F.explode("generators").alias("reference")).distinct()
    known = generators.select(F.col("name").alias("reference")).distinct()
    unknown = references.join(known, "reference", "left_anti").select(
        F.lit("unknown generator").alias("problem"), "name", "reference"
    )
    return (
        duplicates(logical_sets, "duplicate set")
        .unionByName(duplicates(generators, "duplicate generator"))
        .unionByName(unknown)
    )


def active_items(items: DataFrame, *, as_of: Column, ttl_minutes: int) -> DataFrame:
    """Items seen within the TTL, boundary included."""
    return items.where(F.col("last_seen_at") >= as_of - _minutes(ttl_minutes))


def compile_items(items: DataFrame) -> DataFrame:
    """Distinct (seed_set_name, kind, value); the homepage kind counts only when it says true."""
    kind, value = F.col("item_kind"), F.col("item_value")
    is_home = kind == HOMEPAGE_KIND
    return (
        items.where((is_home & (F.lower(value) == "true")) | kind.isin(*SEED_KINDS))
        .select(
            F.col("logical_set_name").alias("seed_set_name"),
            kind.alias("kind"),
            F.when(is_home, F.lit("true")).otherwise(value).alias("value"),
        )
        .distinct()
    )


def seed_documents(
    sets: DataFrame, compiled: DataFrame, refreshed_at: Column, chunk_items: int = CHUNK_ITEMS
) -> DataFrame:
    """Snapshot rows (seed_set_name, chunk, seed_json, refreshed_at) for every set in `sets`.

    Each document has the shape of a seed definition with sorted lists. The number of chunks
    follows the set's size, so no group collected here grows with the data.
    """
    sizes = compiled.groupBy("seed_set_name").agg(F.ceil(F.count("*") / chunk_items).cast("bigint").alias("_chunks"))
    chunk = F.pmod(F.xxhash64("kind", "value"), F.col("_chunks"))
    lists = [
        F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("value")))).alias(column)
        for kind, column in SEED_KINDS.items()
    ]
    chunks = (
        compiled.join(sizes, "seed_set_name")
        .groupBy("seed_set_name", chunk.alias("chunk"))
        .agg(F.bool_or(F.col("kind") == HOMEPAGE_KIND).alias("discover_homepage"), *lists)
    )
    none = F.array().cast("array<string>")
    names = sets.select(F.col("name").alias("seed_set_name")).distinct()
    document = F.struct(
        F.col("seed_set_name").alias("name"),
        F.coalesce("discover_homepage", F.lit(False)).alias("discover_homepage"),
        *[F.coalesce(c, none).alias(c) for c in SEED_KINDS.values()],
    )
    return names.join(chunks, "seed_set_name", "left").select(
        "seed_set_name",
        F.coalesce("chunk", F.lit(0)).cast("bigint").alias("chunk"),
        F.to_json(document).alias("seed_json"),
        refreshed_at.alias("refreshed_at"),
    )


def emptied_chunks(snapshots: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows that empty the stored chunks which the new documents of their sets no longer have, so
    that nothing of a larger snapshot stays behind."""
    none = F.array().cast("array<string>")
    empty = F.struct(
        F.col("seed_set_name").alias("name"), F.lit(False).alias("discover_homepage"), *[none.alias(c) for c in SEED_KINDS.values()]
    )
    times = documents.groupBy("seed_set_name").agg(F.max("refreshed_at").alias("_at"))
    left = snapshots.join(documents, ["seed_set_name", "chunk"], "left_anti").join(times, "seed_set_name")
    return left.select("seed_set_name", "chunk", F.to_json(empty).alias("seed_json"), F.col("_at").alias("refreshed_at"))


def current_snapshots(snapshots: DataFrame) -> DataFrame:
    """Documents of each set's newest refresh; chunks of older, larger snapshots drop out."""
    newest = snapshots.groupBy("seed_set_name").agg(F.max("refreshed_at").alias("refreshed_at"))
    return snapshots.join(newest, ["seed_set_name", "refreshed_at"], "left_semi")


def read_documents(snapshots: DataFrame, seed_set_name: str | None = None) -> DataFrame:
    """Documents of the newest refresh as seed definition columns, optionally of one set."""
    rows = snapshots if seed_set_name is None else snapshots.where(F.col("seed_set_name") == seed_set_name)
    parsed = current_snapshots(rows).withColumn("_seed", F.from_json("seed_json", SEED_DEFINITION))
    return parsed.select("_seed.*", "chunk", "refreshed_at")


def seed_inventory(definitions: DataFrame) -> DataFrame:
    """List sizes per set, by name; chunks of one set add up."""
    # Fixed names of the summary columns.
    names = {
        "stock_count": "stock_ids",
        "topic_count": "topic_ids",
        "user_count": "user_ids",
        "bilibili_video_count": "bilibili_video_targets",
        "bilibili_space_count": "bilibili_space_urls",
        "post_url_count": "post_urls",
    }
    sizes = [F.sum(F.size(column)).cast("bigint").alias(name) for name, column in names.items()]
    return definitions.groupBy("name").agg(F.max("refreshed_at").alias("refreshed_at"), *sizes).orderBy("name")


def needs_refresh(targets: DataFrame, snapshots: DataFrame, *, as_of: Column, refresh_minutes: int) -> DataFrame:
    """One row, one boolean: some target set has no snapshot or one of at least the refresh age."""
    ages = snapshots.groupBy(F.col("seed_set_name").alias("name")).agg(F.min("refreshed_at").alias("refreshed_at"))
    refreshed = F.col("refreshed_at")
    due = refreshed.isNull() | (refreshed <= as_of - _minutes(refresh_minutes))
    joined = targets.select("name").distinct().join(ages, "name", "left")
    return joined.agg(F.coalesce(F.bool_or(due), F.lit(False)).alias("needs_refresh"))


def refresh_totals(seed_runs: DataFrame) -> DataFrame:
    """Number of generator runs and of items before dedupe."""
    return seed_runs.where("status = 'succeeded'").agg(
        F.count("*").cast("bigint").alias("generator_runs"),
        F.coalesce(F.sum("item_count"), F.lit(0)).cast("bigint").alias("generated_items"),
    )
