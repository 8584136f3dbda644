"""Streaming counterparts of the poll loop, the claim, the upserts and the activity count.

Keyed state lives in the same log tables as in batch, written by foreachBatch under the id of the
streaming query, which its checkpoint keeps, and its batch id. A replayed micro-batch overwrites
its own folder and reads the table without itself, so every job here is idempotent, and several
streams may write one table. Micro-batches are reduced per key before anything is
shuffled by key, which a keyed stateful operator could not do for a hot key.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidewire.operators.frontier import FreshnessPolicy, claim_winners, claimed_state
from tidewire.operators.upsert import last_by_key
from tidewire.sources import forum
from tidewire.sources.tables import LogTable

POLL_SECONDS = 300
# Rows that a task holds to drop repeats of a key among them before a shuffle.
REDUCED_ROWS = 10_000

# Shipped by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def writer_of(rows: DataFrame) -> str:
    """The id of the streaming query a micro-batch belongs to."""
    return rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"


def each_batch(
    stream: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    poll_seconds: int | None = None,
) -> StreamingQuery:
    """Start a foreachBatch job: every `poll_seconds`, or once through what is available."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def upsert_stream(
    stream: DataFrame, table: LogTable, order: Sequence[str], checkpoint: str, poll_seconds: int | None = None
) -> StreamingQuery:
    """Latest-wins upsert. Arrival order decides: the batch, then `order` within it. Late data
    therefore wins; see upsert_by_event_time for the other rule."""
    return each_batch(stream, lambda rows, batch: table.append(rows, batch, order, writer_of(rows)), checkpoint, poll_seconds)


def upsert_by_event_time(
    stream: DataFrame, table: LogTable, time: str, order: Sequence[str], checkpoint: str, *,
    delay: str | None = None, poll_seconds: int | None = None,
) -> StreamingQuery:
    """Newest-event-wins upsert: a row replaces the stored one only if its `time` is not older.

    `time` is a column of the table, so the stored row tells across batches and restarts when it
    happened; equal times go to the later arrival, rows without a time are the oldest. Each
    batch is reduced to its newest row per key before it meets the table, of which only those keys
    are read. With a `delay`, rows that far behind the newest event are dropped: the watermark of a
    stream that also drops repeats of one key and time.
    """
    keys = list(table.keys)
    if delay is not None:
        stream = without_repeats(stream, time, [*keys, time], delay)

    def work(rows: DataFrame, batch: int) -> None:
        writer = writer_of(rows)
        # Used twice, and the batch may come out of a stateful operator.
        newest = last_by_key(rows, keys, [time, *order]).persist()
        known = table.read(batch, newest, writer).select(*keys, F.struct(F.col(time).alias("at")).alias("_stored"))
        current = newest.join(known, keys, "left")
        older = F.coalesce(F.col(time) < F.col("_stored.at"), F.col(time).isNull() & F.col("_stored.at").isNotNull())
        spare = [c for c in order if c not in table.schema.names]
        table.append(current.where(F.col("_stored").isNull() | ~older).drop("_stored", *spare), batch, writer=writer)
        newest.unpersist()

    return each_batch(stream, work, checkpoint, poll_seconds)


def ingest_articles(
    pages: DataFrame, root: str, checkpoint: str, poll_seconds: int | None = None
) -> StreamingQuery:
    """Captured article pages to posts, authors and errors.

    The pages carry task columns (source, kind, url, seed_name, metadata). Outcomes are written
    once per batch and read back for the three tables, so pages are parsed once.
    """

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        writer = writer_of(rows)
        folder = f"{root.rstrip('/')}/outcomes/{writer}/batch={batch:012d}"
        forum.parse(rows).write.mode("overwrite").parquet(folder)
        outcomes = spark.read.parquet(folder)
        store_outcomes(spark, root, outcomes, batch, ["fetched_at", "url"], writer)

    return each_batch(pages, work, checkpoint, poll_seconds)


def store_outcomes(
    spark: SparkSession, root: str, outcomes: DataFrame, batch: int, order: Sequence[str], writer: str
) -> None:
    """Append posts, authors and errors of parsed pages; the last in `order` wins per entity."""
    for name, column in (("posts", "post"), ("authors", "author")):
        found = outcomes.where(F.col(column).isNotNull())
        entities = found.select(f"{column}.*", F.struct(*order).alias("_order"))
        LogTable.named(spark, root, name).append(entities, batch, ["_order"], writer)
    failed = outcomes.where("error is not null").select(
        F.col("fetched_at").alias("created_at"), "source", "url", F.col("error").alias("error_message")
    )
    LogTable.named(spark, root, "crawl_errors").append(failed, batch, writer=writer)


def claim_stream(
    frontier: DataFrame,
    state: LogTable,
    claims_path: str,
    checkpoint: str,
    *,
    now: Callable[[], Column] = F.current_timestamp,
    policy: FreshnessPolicy = FreshnessPolicy(),
    poll_seconds: int | None = None,
) -> StreamingQuery:
    """Per-URL freshness claims: winners of each micro-batch go to a folder of the stream's own under
    `claims_path`."""

    def work(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        at, writer = now(), writer_of(rows)
        folder = f"{claims_path}/writer={writer}/batch={batch:012d}"
        claim_winners(rows, state.read(batch, rows, writer), now=at, policy=policy).withColumn(
            "claimed_at", at
        ).write.mode("overwrite").parquet(folder)
        winners = spark.read.parquet(folder)
        state.append(claimed_state(winners, now=F.col("claimed_at")), batch, writer=writer)

    return each_batch(frontier, work, checkpoint, poll_seconds)


def seed_item_stream(
    items: DataFrame, state: LogTable, checkpoint: str, seen_at: str, poll_seconds: int | None = None
) -> StreamingQuery:
    """Seed items seen on a stream; expiry is the TTL filter at read time. A late batch may widen
    the span an item was seen in, never shorten it."""
    keys = list(state.keys)

    def work(rows: DataFrame, batch: int) -> None:
        span = F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at")
        seen_time = F.col(seen_at).cast("timestamp")
        seen = rows.select(*keys, seen_time.alias("first_seen_at"), seen_time.alias("last_seen_at"))
        seen = seen.groupBy(*keys).agg(*span)
        writer = writer_of(rows)
        known = state.read(batch, seen, writer).select(*seen.columns)
        state.append(known.unionByName(seen).groupBy(*keys).agg(*span), batch, writer=writer)

    return each_batch(items, work, checkpoint, poll_seconds)


def _ends_by_key(keys: Sequence[str], time: str):
    """Of each REDUCED_ROWS rows or more, whatever the size of Arrow batches, the earliest and the latest row per key."""

    def ends(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by(time)
        numbered = rows.select(list(dict.fromkeys(keys))).append_column("_row", pa.array(range(rows.num_rows), pa.int64()))
        ends = numbered.group_by(list(dict.fromkeys(keys)), use_threads=False).aggregate([("_row", "min"), ("_row", "max")])
        kept = sorted({*ends["_row_min"].to_pylist(), *ends["_row_max"].to_pylist()})
        return rows.take(pa.array(kept, pa.int64())).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= REDUCED_ROWS:
                yield from ends(held)
                held = []
        if held:
            yield from ends(held)

    return run


def without_repeats(stream: DataFrame, time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """One row per key within the delay; repeats are dropped, and rows behind the watermark.

    All rows of a key meet in one state task, so repeats are dropped before the shuffle as well,
    some rows at a time in each task: of a key that fills a third of the stream, two rows of some ten
    thousand get there, the latest because the earliest may be behind the watermark.
    """
    reduced = stream.mapInArrow(_ends_by_key(keys, time), stream.schema)
    return reduced.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def rolling_activity(
    stream: DataFrame, time: str, url: str, delay: str = "10 minutes", size: str = "1 hour", slide: str = "5 minutes"
) -> DataFrame:
    """Distinct URLs fetched per sliding window, append mode.

    A URL's last fetch lies within the hour before the window's end exactly when some fetch of
    it lies in the window, so this equals the batch activity count at each window end.

    A fetch is in many windows, and a task counts all of its rows in memory before they are shuffled;
    so rows are first dealt evenly to as many tasks as there are state partitions.
    """
    per_url = stream.repartition(F.col(time), F.col(url)).withWatermark(time, delay).groupBy(F.window(time, size, slide), url).agg(F.count("*").alias("_n"))
    counted = per_url.groupBy("window").agg(F.count("*").cast("bigint").alias("recent_urls"))
    return counted.select(F.col("window.end").alias("window_end"), "recent_urls")
