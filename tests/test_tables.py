"""Stored tables, datasets and the SQL surface."""

from __future__ import annotations

import json

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewire.plans import sqlsurface
from tidewire.schemas import AUTHORS, STOCK_UNIVERSE, conform
from tidewire.session import run_dir, shared_dir
from tidewire.sources import datasets
from tidewire.sources.tables import LogTable, create_tables, scan


def authors(spark, *items):
    return spark.createDataFrame([("x", i, n, o) for i, n, o in items], "source string, source_entity_id string, display_name string, seq int")


def names(df):
    return sorted((r.source_entity_id, r.display_name) for r in df.collect())


def test_log_table(spark, tmp_path):
    table = LogTable.named(spark, str(tmp_path), "authors")
    assert table.read().count() == 0 and table.compact() is None
    table.append(authors(spark, ("1", "old", 2), ("1", "older", 1), ("2", "b", 1)), 1, ["seq"])
    assert names(table.read()) == [("1", "old"), ("2", "b")]
    table.append(authors(spark, ("1", "new", 1)), 2, ["seq"])
    table.append(authors(spark, ("1", "new", 1)), 2, ["seq"])  # a replay
    assert names(table.read()) == [("1", "new"), ("2", "b")]
    assert names(table.read(before=2)) == [("1", "old"), ("2", "b")]
    assert table.compact() == 2
    table.append(authors(spark, ("3", "c", 1)), 3, ["seq"])
    assert names(table.read()) == [("1", "new"), ("2", "b"), ("3", "c")]
    assert names(table.read(before=2)) == [("1", "old"), ("2", "b")]
    # Batch 3 again with other content replaces it; the snapshot stays below it.
    table.append(authors(spark, ("2", "b3", 1)), 3, ["seq"])
    assert names(table.read()) == [("1", "new"), ("2", "b3")]
    assert table.read().schema.names == AUTHORS.names


def test_partial_reads(spark, tmp_path):
    table = LogTable.named(spark, str(tmp_path), "authors")
    table.append(authors(spark, ("1", "a", 1), ("2", "b", 1)), 1, ["seq"])
    table.compact()
    table.append(authors(spark, ("2", "c", 1), ("3", "d", 1)), 2, ["seq"])
    wanted = spark.createDataFrame([("2",), ("2",), ("9",)], "source_entity_id string")
    assert names(table.read(only=wanted)) == [("2", "c")]
    # A point lookup reaches every scan: snapshot, log, and the log's keys that the snapshot is joined with.
    found = table.read().where("source = 'x' and source_entity_id = '2'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(source_entity_id,2)") == plan.count("FileScan parquet") == 3
    assert names(found) == [("2", "c")]


def test_writers_never_replace_each_other(spark, tmp_path):
    table = LogTable.named(spark, str(tmp_path), "authors")
    table.append(authors(spark, ("1", "a", 1), ("2", "a", 1)), 5, ["seq"], "first")
    table.append(authors(spark, ("2", "b", 1), ("3", "b", 1)), 5, ["seq"], "second")
    assert names(table.read()) == [("1", "a"), ("2", "b"), ("3", "b")]
    # Each writer sees the table without its own batch only.
    assert names(table.read(before=5, writer="first")) == [("2", "b"), ("3", "b")]
    table.compact()
    # An id below the snapshot's is a new batch, not an old one.
    table.append(authors(spark, ("1", "low", 1)), 0, ["seq"], "second")
    assert names(table.read()) == [("1", "low"), ("2", "b"), ("3", "b")]
    # A replay of a folded batch takes its old place: what came after it still wins.
    table.append(authors(spark, ("1", "again", 1), ("2", "again", 1), ("4", "again", 1)), 5, ["seq"], "first")
    assert names(table.read()) == [("1", "low"), ("2", "b"), ("3", "b"), ("4", "again")]
    table.retract("second", 0)
    assert names(table.read()) == [("1", "again"), ("2", "again"), ("4", "again")]


def test_append_only_rows_survive_compactions(spark, tmp_path):
    table = LogTable.named(spark, str(tmp_path), "crawl_errors")

    def errors(*messages):
        return spark.createDataFrame([("x", m) for m in messages], "source string, error_message string")

    def stored():
        return sorted(r.error_message for r in table.read().collect())

    for n, writer in enumerate(("a", "b", "a", "c")):
        table.append(errors(f"{writer}{n}"), n, writer=writer)
        table.compact()
    assert stored() == ["a0", "a2", "b1", "c3"]
    # Two compactions passed batch 1: its folder is pruned, and its replay is known as applied.
    assert not any("~b~" in p.name for p in (tmp_path / "crawl_errors" / "log").iterdir())
    table.append(errors("b1"), 1, writer="b")
    table.append(errors("c3"), 3, writer="c")
    assert stored() == ["a0", "a2", "b1", "c3"]


def test_late_batch_does_not_undo_the_snapshot(spark, tmp_path):
    table = LogTable.named(spark, str(tmp_path), "authors")
    table.append(authors(spark, ("1", "slow", 1), ("2", "slow", 1)), 1, ["seq"], "slow")
    success = next((tmp_path / "authors" / "log").glob("*~slow~*")) / "_SUCCESS"
    success.rename(tmp_path / "aside")
    table.append(authors(spark, ("1", "fast", 1)), 1, ["seq"], "fast")
    table.compact()
    assert names(table.read()) == [("1", "fast")]
    (tmp_path / "aside").rename(success)  # the write that began first ends last
    assert names(table.read()) == [("1", "fast"), ("2", "slow")]


def test_reading_ranks_only_the_tail(spark, tmp_path):
    table = LogTable.named(spark, str(tmp_path), "authors")
    table.append(authors(spark, ("1", "a", 1), ("2", "b", 1)), 1, ["seq"])
    table.compact()
    table.append(authors(spark, ("2", "c", 1)), 2, ["seq"])
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    base = plan[:plan.index("Window")]
    assert "BroadcastHashJoin" in base and "LeftAnti" in base and "hashpartitioning" not in base
    assert names(table.read()) == [("1", "a"), ("2", "c")]


def test_unfinished_writes_are_ignored(spark, tmp_path):
    table = LogTable.named(spark, str(tmp_path), "authors")
    table.append(authors(spark, ("1", "a", 1)), 1, ["seq"])
    half = tmp_path / "authors" / "snapshot" / "upto=000000000009"
    half.mkdir(parents=True)
    (tmp_path / "authors" / "log" / "_batch=000000000008").mkdir()
    assert names(table.read()) == [("1", "a")]


def test_schema_is_closed(spark):
    good = spark.createDataFrame([("x", "1", 5)], "source string, source_entity_id string, followers int")
    assert conform(good, AUTHORS).schema.names == AUTHORS.names
    with pytest.raises(ValueError, match="unknown"):
        conform(good.withColumn("extra", F.lit(1)), AUTHORS)
    with pytest.raises(ValueError, match="missing"):
        conform(good.drop("source"), AUTHORS)


def test_datasets(spark, tmp_path):
    stocks = [{"stock_id": "A", "market": "SH", "tags": ["t"]}, {"stock_id": "B"}]
    for name, payload in {"bare": stocks, "wrapped": {"stocks": stocks}, "empty": {"other": 1}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(payload, indent=1))
    for name in ("bare", "wrapped"):
        df = datasets.read_stock_dataset(spark, str(tmp_path / f"{name}.json"))
        assert df.schema.names == STOCK_UNIVERSE.names
        assert sorted((r.stock_id, r.market, tuple(r.tags)) for r in df.collect()) == [("A", "SH", ("t",)), ("B", None, ())]
    assert datasets.read_stock_dataset(spark, str(tmp_path / "empty.json")).count() == 0
    (tmp_path / "bad.json").write_text('[{"stock_id":"A","colour":1}]')
    with pytest.raises((PySparkException, Py4JError), match="unknown fields: colour"):
        datasets.read_stock_dataset(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "ranks.json").write_text('{"entries":[{"stock_id":"A","trade_date":"2026-04-14","rank":2}]}')
    row = datasets.read_ranking_dataset(spark, str(tmp_path / "ranks.json")).first()
    assert (row.stock_id, str(row.trade_date), row.rank, row.market) == ("A", "2026-04-14", 2, None)


def test_tables_and_sql(spark, tmp_path):
    authors(spark, ("1", "a", 1)).createOrReplaceTempView("zz_session_view")
    created = create_tables(spark, "feed")
    assert create_tables(spark, "feed") == created and len(created) == 10
    listed = [r.tableName for r in sqlsurface.list_tables(spark, "feed").collect()]
    assert listed == created
    assert "source_entity_id" in sqlsurface.table_schema(spark, "feed.posts").first()[0]
    sqlsurface.register_views(spark, {"people": authors(spark, ("1", "a", 1))})
    assert sqlsurface.run_sql(spark, " (SELECT count(*) AS n FROM people);").first().n == 1
    with pytest.raises(ValueError):
        sqlsurface.run_sql(spark, "DROP VIEW people")
    assert sqlsurface.is_read(spark, "with a as (select 1) select * from a") and not sqlsurface.is_read(spark, "insert into t values (1)")
    path = str(tmp_path / "authors")
    conform(authors(spark, ("1", "a", 1)).drop("seq"), AUTHORS).write.parquet(path)
    assert scan(spark, "authors", path).first().display_name == "a"


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")
