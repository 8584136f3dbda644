"""Captured pages: which capture of a page counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.upsert import first_by_key

PAGE_KEY = ("url", "section", "root_id", "page_no")


def _same(left: DataFrame, right: DataFrame, names: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[f"_{n}"]) for n in names])


def newest(captured: DataFrame, urls: DataFrame, now: Column) -> DataFrame:
    """Of each page of the given `urls`, the newest capture not later than `now`.

    The choice is made on the page keys and times alone, so the scan for it reads no texts; only
    chosen captures are fetched with theirs. Captures without a time are the oldest. Captures of
    one page at one time are told apart by content, which moves the texts of just those.
    """
    times = captured.where(F.col("fetched_at").isNull() | (F.col("fetched_at") <= now)).select(*PAGE_KEY, "fetched_at")
    times = times.join(urls.select("url"), "url", "left_semi")
    counted = times.groupBy(*PAGE_KEY, "fetched_at").agg(F.count(F.lit(1)).alias("n"))
    last = counted.groupBy(*PAGE_KEY).agg(F.max(F.struct("fetched_at", "n")).alias("last"))
    chosen = last.select(
        *[F.col(n).alias(f"_{n}") for n in PAGE_KEY], F.col("last.fetched_at").alias("_fetched_at"), (F.col("last.n") > 1).alias("_tied")
    )
    rows = captured.join(chosen, _same(captured, chosen, (*PAGE_KEY, "fetched_at"))).select(*captured.columns, "_tied")
    content = [F.col(c).asc_nulls_last() for c in captured.columns if c not in PAGE_KEY]
    tied = first_by_key(rows.where("_tied"), PAGE_KEY, content)
    return rows.where("NOT _tied").unionByName(tied).drop("_tied")
