"""Building blocks for frontier rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.urls import http_url

# Larger than the number of values in one seed document.
_CHUNK_STRIDE = 1_000_000_000


def metadata(**entries: Column) -> Column:
    """map<string,string> of the entries that are not null."""
    pairs = [F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in entries.items()]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull()))


def explode_values(seeds: DataFrame, lists: Mapping[str, Column]) -> DataFrame:
    """The named arrays of each seed as rows (seed_name, seed_kind, value, pos).

    `pos` is unique per seed name, also where a seed spans several chunk documents. URLs and
    metadata are built after this, as plain columns instead of nested in array lambdas.
    """
    none = F.array().cast("array<string>")

    def tagged(kind: str, values: Column) -> Column:
        return F.transform(
            F.coalesce(values, none), lambda v: F.struct(F.lit(kind).alias("seed_kind"), v.alias("value"))
        )

    arrays = F.concat(*[tagged(kind, values) for kind, values in lists.items()])
    chunk = F.col("chunk") if "chunk" in seeds.columns else F.lit(0)
    rows = seeds.select(F.col("name").alias("seed_name"), chunk.alias("_chunk"), F.posexplode(arrays).alias("_pos", "_v"))
    pos = F.col("_pos").cast("bigint") + F.col("_chunk").cast("bigint") * _CHUNK_STRIDE
    return rows.select("seed_name", "_v.seed_kind", "_v.value", pos.alias("pos"))


def task_rows(tasks: DataFrame) -> DataFrame:
    """Canonical task URLs; a step of its own, so that each URL is built once."""
    return tasks.withColumn("url", http_url(F.col("url")))
