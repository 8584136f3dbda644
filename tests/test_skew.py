"""One post or URL holding a third of all rows: plans split or pre-reduce it, results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewire.operators import threads
from tidewire.operators.upsert import first_by_key, last_by_key
from tidewire.sources import datasets
from tidewire.sources.tables import LogTable

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def comments(spark, n=30_000):
    ids = spark.range(0, n, 1, 16)
    post = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 2000))
    return ids.select(
        F.lit("bilibili").alias("source"), post.alias("post_entity_id"), F.col("id").cast("string").alias("source_entity_id"),
        F.when(F.col("id") % 2 == 0, "owner").otherwise("other").alias("author_entity_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("content_text"),
        F.lit(None).cast("timestamp").alias("published_at"), F.timestamp_seconds("id").alias("fetched_at"),
    )


def posts(spark):
    keys = spark.range(0, 2000, 1, 4).select(F.concat(F.lit("p"), "id").alias("k")).unionByName(
        spark.createDataFrame([("hot",), ("lonely",)], "k string")
    )
    return keys.select(
        F.lit("bilibili").alias("source"), F.col("k").alias("source_entity_id"), F.lit("t").alias("title"),
        F.lit("owner").alias("author_entity_id"),
    )


def executed(df):
    """Run once and return (rows, final plan)."""
    handle = df.groupBy().count()
    n = handle.collect()[0][0]
    return n, handle._jdf.queryExecution().executedPlan().toString()


def test_post_joins_split_the_hot_post(skewed):
    n, plan = executed(threads.with_comments(posts(skewed), comments(skewed)))
    matched = comments(skewed).join(posts(skewed).withColumnRenamed("source_entity_id", "post_entity_id").select("post_entity_id"), "post_entity_id").count()
    empty = posts(skewed).count() - comments(skewed).select("post_entity_id").distinct().count()
    assert n == matched + empty
    assert "skew=true" in plan
    n, plan = executed(threads.owner_comments(comments(skewed), posts(skewed)))
    assert n == comments(skewed).where("author_entity_id = 'owner'").count()
    assert "skew=true" in plan


def test_hot_keys_are_reduced_before_the_shuffle(skewed):
    for df in (
        last_by_key(comments(skewed), ["source", "post_entity_id"], ["fetched_at"]),
        first_by_key(comments(skewed), ["source", "post_entity_id"], ["fetched_at"], 3),
    ):
        n, plan = executed(df)
        assert "WindowGroupLimit" in plan
        assert n in (2000 - 0 + 1 - (2000 - comments(skewed).where("post_entity_id <> 'hot'").select("post_entity_id").distinct().count()),
                     3 * (comments(skewed).select("post_entity_id").distinct().count()))


def test_captured_pages_are_read_in_batch_and_stream(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = spark.createDataFrame([("u", 1, "main", 200, "x")], "url string, page_no int, section string, status_code int, text string")
    rows.write.parquet(path)
    assert datasets.read_pages(spark, path).first().error_message is None
    out = LogTable.named(spark, str(tmp_path), "crawl_errors")
    stream = datasets.stream_pages(spark, path).select(F.current_timestamp().alias("created_at"), F.lit("xueqiu").alias("source"), "url", F.col("text").alias("error_message"))
    stream.writeStream.foreachBatch(lambda df, batch: out.append(df, batch)).option("checkpointLocation", str(tmp_path / "cp")).trigger(
        availableNow=True).start().awaitTermination()
    assert [(r.url, r.error_message) for r in out.read().collect()] == [("u", "x")]
