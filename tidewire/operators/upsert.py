"""Keyed upserts: last wins, preserved columns, update-only, and merge on read.

"Last" is arrival order, given by explicit order columns that must be unique per key, never the
fetch time unless the caller passes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in order.

    Spark limits the window group on the map side (WindowGroupLimit), so each task ships at
    most one row per key and a hot key costs nothing at the reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], limit: int = 1) -> DataFrame:
    """The first `limit` rows per key in order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def changed_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preserve: Sequence[str] = (),
) -> DataFrame:
    """New images of the rows a batch inserts or overwrites.

    `preserve` columns keep the target's value where the key exists, even a null one. Only the
    batch keys' rows come back, so a log table can append them without rewriting itself.
    """
    newest = last_by_key(batch, keys, order)
    if not preserve:
        return newest.select(*target.columns)
    before = target.select(*keys, F.struct(*preserve).alias("_kept"))
    image = newest.join(before, list(keys), "left")
    return image.select(
        *[
            F.when(F.col("_kept").isNotNull(), F.col("_kept")[c]).otherwise(F.col(c)).alias(c)
            if c in preserve
            else F.col(c)
            for c in target.columns
        ]
    )


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preserve: Sequence[str] = (),
) -> DataFrame:
    """The whole target after the batch. The target must be unique per key.

    Untouched rows pass an anti join on keys only, which Spark broadcasts while the batch is
    small, so the target itself is not shuffled then.
    """
    images = changed_rows(target, batch, keys, order, preserve)
    untouched = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return untouched.unionByName(images)


def update_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Overwrite the update's non-key columns where the key exists; never insert.

    A null in the update overwrites too, hence the struct as match marker instead of coalesce.
    """
    changed = [c for c in updates.columns if c not in keys and c not in order]
    newest = last_by_key(updates, keys, order).select(*keys, F.struct(*changed).alias("_new"))
    joined = target.join(newest, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in target.columns
        ]
    )


def touch_seed_items(state: DataFrame, items: DataFrame, seen_at: Column) -> DataFrame:
    """Insert seed items as first and last seen now; a known item only moves last_seen_at."""
    keys = ["logical_set_name", "generator_name", "item_kind", "item_value"]
    batch = items.select(*keys).distinct().withColumns({"first_seen_at": seen_at, "last_seen_at": seen_at})
    return upsert(state, batch, keys, ["last_seen_at"], preserve=["first_seen_at"])
