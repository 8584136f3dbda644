"""Seed refresh: run the generators of a catalog, upsert their items, compile and snapshot.

The catalog is configuration: a dict of `logical_sets` (name, generators) and `generators`
(name, type, parameters). The data stays in frames.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import seeds as S
from tidewire.operators.upsert import changed_rows
from tidewire.schemas import SEED_ITEMS, SEED_RUNS
from tidewire.session import run_dir
from tidewire.sources.registry import GENERATORS, Generator
from tidewire.sources.tables import LogTable

# Name of the refresh among the writers of the stored tables.
_WRITER = "seeds"
# Sets of one refresh; each stores batches of its own.
_SETS = 10_000


def check_catalog(
    spark: SparkSession, catalog: Mapping[str, Sequence[Mapping[str, Any]]], known: Mapping[str, Generator] = GENERATORS
) -> None:
    """Refuse duplicate names, unknown generator references and unknown generator types."""
    sets = [(s["name"], list(s.get("generators", []))) for s in catalog.get("logical_sets", [])]
    generators = [(g["name"],) for g in catalog.get("generators", [])]
    problems = S.catalog_problems(
        spark.createDataFrame(sets, "name string, generators array<string>"),
        spark.createDataFrame(generators, "name string"),
    )
    first = problems.orderBy("problem", "name").first()
    if first is not None:
        raise ValueError(f"{first.problem}: {first.name} {first.reference or ''}".rstrip())
    unknown = [g["name"] for g in catalog.get("generators", []) if g["type"] not in known]
    if unknown:
        raise ValueError(f"unknown generator types: {unknown}")


def refresh_seeds(
    spark: SparkSession,
    root: str,
    catalog: Mapping[str, Sequence[Mapping[str, Any]]],
    *,
    now: datetime,
    batch_id: int,
    seed_set: str | None = None,
    ttl_minutes: int = 1440,
    resume: bool = False,
    generators: Mapping[str, Generator] = GENERATORS,
) -> DataFrame:
    """Refresh the chosen sets, one after the other; returns one row of totals.

    A set's items, run log and snapshot are stored as soon as its generators have run. A generator
    that fails is logged and raises; what earlier ones of its set produced stays stored, sets
    before it have their snapshots, its own keeps the old one. With `resume`, sets that have
    a snapshot of `now` already are left out, so a failed refresh goes on where it ended.
    `generators` maps generator types to functions; callers may add their own.
    """
    check_catalog(spark, catalog, generators)
    chosen = [s for s in catalog["logical_sets"] if seed_set in (None, s["name"])]
    if len(chosen) >= _SETS:
        raise ValueError(f"more than {_SETS} sets in one refresh")
    staging = run_dir(spark, "seed-refresh")
    at = F.lit(now).cast("timestamp")
    snapshots = LogTable.named(spark, root, "compiled_seed_sets")
    done = set()
    if resume:
        done = {r["seed_set_name"] for r in snapshots.read().where(F.col("refreshed_at") == at).select("seed_set_name").distinct().collect()}
    definitions = {g["name"]: g for g in catalog["generators"]}
    logs = []
    for n, logical in enumerate(chosen):
        if logical["name"] in done:
            continue
        step = batch_id * _SETS + n
        log, failure = _generated(spark, f"{staging}/set={n}", logical, definitions, generators, now)
        logs.append(_store_items(spark, root, f"{staging}/set={n}", log, at, step))
        if failure is not None:
            raise failure
        names = spark.createDataFrame([(logical["name"],)], "name string")
        wanted = names.withColumnRenamed("name", "logical_set_name")
        state = LogTable.named(spark, root, "generated_seed_items").read(only=wanted)
        active = S.active_items(state, as_of=at, ttl_minutes=ttl_minutes)
        documents = S.seed_documents(names, S.compile_items(active), at)
        stored = snapshots.read(step, names.withColumnRenamed("name", "seed_set_name"), _WRITER)
        snapshots.append(documents.unionByName(S.emptied_chunks(stored, documents)), step, writer=_WRITER)
    runs = reduce(lambda a, b: a.unionByName(b), logs) if logs else spark.createDataFrame([], SEED_RUNS)
    return S.refresh_totals(runs)


def _generated(spark: SparkSession, folder: str, logical, definitions, generators, now: datetime) -> tuple[list[tuple], Exception | None]:
    """Run the generators of a set up to the first that fails; items are staged under their run ids."""
    log: list[tuple] = []
    for name in logical.get("generators", []):
        definition, run_id = definitions[name], str(uuid.uuid4())
        began, failure = datetime.now(now.tzinfo), None
        try:
            items = generators[definition["type"]](spark, definition, now).select(
                F.lit(logical["name"]).alias("logical_set_name"), F.lit(name).alias("generator_name"),
                F.col("kind").alias("item_kind"), F.col("value").alias("item_value"),
            )
            items.write.parquet(f"{folder}/run_id={run_id}")
        except Exception as exc:  # stored in the run log, then raised again
            failure = exc
        status = "succeeded" if failure is None else "failed"
        log.append((run_id, logical["name"], name, began, datetime.now(now.tzinfo), status, str(failure) if failure else None))
        if failure is not None:
            return log, failure
    return log, None


def _store_items(spark: SparkSession, root: str, folder: str, log: list[tuple], at: Column, step: int) -> DataFrame:
    """Store the run log and the items of one set; returns the log. Items are counted per run, so a
    generator that a set names twice has two runs with their own counts."""
    items = _staged(spark, folder, [row[0] for row in log if row[5] == "succeeded"])
    columns = "run_id string, logical_set_name string, generator_name string, started_at timestamp, " \
              "finished_at timestamp, status string, error_message string"
    counts = items.groupBy("run_id").agg(F.count("*").alias("item_count"))
    runs = spark.createDataFrame(log, columns).join(counts, "run_id", "left")
    runs = runs.withColumn("item_count", F.coalesce("item_count", F.lit(0))).select(*SEED_RUNS.names)
    LogTable.named(spark, root, "generated_seed_runs").append(runs, step, writer=_WRITER)

    state = LogTable.named(spark, root, "generated_seed_items")
    keys = list(state.keys)
    batch = items.select(*keys).distinct().withColumns({"first_seen_at": at, "last_seen_at": at})
    known = state.read(step, batch, _WRITER)
    state.append(changed_rows(known, batch, keys, ["last_seen_at"], preserve=["first_seen_at"]), step, writer=_WRITER)
    return runs


def ensure_seeds(
    spark: SparkSession,
    root: str,
    catalog: Mapping[str, Sequence[Mapping[str, Any]]],
    *,
    now: datetime,
    batch_id: int,
    seed_set: str | None = None,
    refresh_minutes: int = 60,
    ttl_minutes: int = 1440,
    generators: Mapping[str, Generator] = GENERATORS,
) -> DataFrame:
    """Seed definitions of the chosen sets, refreshed first when missing or old."""
    chosen = [s["name"] for s in catalog["logical_sets"] if seed_set in (None, s["name"])]
    targets = spark.createDataFrame([(n,) for n in chosen], "name string")
    table = LogTable.named(spark, root, "compiled_seed_sets")
    at = F.lit(now).cast("timestamp")
    due = S.needs_refresh(targets, S.current_snapshots(table.read()), as_of=at, refresh_minutes=refresh_minutes)
    if chosen and due.first()["needs_refresh"]:
        refresh_seeds(spark, root, catalog, now=now, batch_id=batch_id, seed_set=seed_set, ttl_minutes=ttl_minutes, generators=generators)
    return S.read_documents(table.read(), seed_set)


def _staged(spark: SparkSession, folder: str, run_ids: list[str]) -> DataFrame:
    ddl = ", ".join(f"{f.name} string" for f in SEED_ITEMS if f.name.startswith(("logical", "generator", "item"))) + ", run_id string"
    if not run_ids:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("basePath", folder).parquet(*[f"{folder}/run_id={r}" for r in run_ids])
