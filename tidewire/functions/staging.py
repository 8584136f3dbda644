"""Keep expensive columns from being evaluated more than once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns whose values later filters reuse.

    A filter on a projected column is pushed below the projection, where it evaluates the
    expression a second time: a second parse, regex scan or Python call per row. Filters do not
    move through a generator, so the values are passed through one that yields a single row.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
