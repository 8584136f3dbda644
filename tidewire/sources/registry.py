"""Pluggable sources and seed generators, as functions from frames to frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession

from tidewire.operators import seeds as S
from tidewire.schemas import RANKING, SEED_DEFINITION, SEED_KINDS, STOCK_UNIVERSE, conform
from tidewire.sources import datasets, forum, video


class SourceAdapter(Protocol):
    """What a site has to provide: a module or object with these functions."""

    SOURCE: str

    def expand(self, seeds: DataFrame) -> DataFrame:
        """Seed definitions to tasks: source, kind, url, seed_name, priority, metadata, pos."""

    def parse(self, fetched: DataFrame) -> DataFrame:
        """Tasks with their captured page to blocked, error, post, author, links."""

    def discover(self, tasks: DataFrame, captured: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Discover tasks with their pages to (outcomes, discovered tasks with `parent` and `pos`)."""

    def comments(self, tasks: DataFrame, captured: DataFrame) -> DataFrame:
        """Comment tasks with their payload pages to comment rows with `url` and `pos`."""

    def comment_tasks(self, posts: DataFrame) -> DataFrame:
        """Posts to comment tasks."""


ADAPTERS: dict[str, Any] = {forum.SOURCE: forum, video.SOURCE: video}

Generator = Callable[[SparkSession, Mapping[str, Any], Any], DataFrame]


def _records(spark: SparkSession, rows, schema) -> DataFrame:
    """Inline catalog records; unknown fields are refused."""
    unknown = {k for r in rows for k in r} - set(schema.names)
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def _manual(spark: SparkSession, definition: Mapping[str, Any], as_of) -> DataFrame:
    row = {"name": definition["name"], "discover_homepage": bool(definition.get("discover_homepage"))}
    row |= {c: list(definition.get(c, [])) for c in SEED_KINDS.values()}
    return S.manual_items(_records(spark, [row], SEED_DEFINITION)).drop("name")


def _stock_universe(spark: SparkSession, definition: Mapping[str, Any], as_of) -> DataFrame:
    if definition.get("dataset_path"):
        universe = datasets.read_stock_dataset(spark, definition["dataset_path"], bool(definition.get("lines")))
    elif definition.get("stocks"):
        rows = [{"tags": [], **r} for r in definition["stocks"]]
        universe = _records(spark, rows, STOCK_UNIVERSE)
    else:
        raise ValueError("a stock universe needs a dataset_path, or stocks of its own")
    filters = ("markets", "boards", "prefixes", "include_tags", "exclude_tags")
    return S.stock_universe_items(
        universe, **{k: definition.get(k, ()) for k in filters}, limit=definition.get("limit")
    )


def _ranking(spark: SparkSession, definition: Mapping[str, Any], as_of) -> DataFrame:
    """A captured ranking page outranks a dataset, which outranks inline entries."""
    if definition.get("page_path"):
        entries = datasets.ranking_rows(spark.read.text(definition["page_path"], wholetext=True), html="value")
    elif definition.get("dataset_path"):
        entries = datasets.read_ranking_dataset(spark, definition["dataset_path"], bool(definition.get("lines")))
    elif definition.get("entries"):
        entries = _records(spark, definition["entries"], RANKING)
    else:
        raise ValueError("a ranking needs a page_path, a dataset_path, or entries of its own")
    return S.ranking_items(
        conform(entries, RANKING),
        as_of=as_of,
        since_date=definition.get("since_date"),
        days_window=definition.get("days_window"),
        markets=definition.get("markets", ()),
        ranking_modes=definition.get("ranking_modes", ()),
        top_n=definition.get("top_n"),
    )


GENERATORS: dict[str, Generator] = {"manual": _manual, "stock_universe": _stock_universe, "longhubang": _ranking}
