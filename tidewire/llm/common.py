"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.session import configure, cut_lineage, run_dir

__all__ = ["FOLDS", "cut_lineage", "fold", "named", "one_of_each", "prepare", "quoted", "stored", "self_contained", "table", "word_count", "ROWS_PER_BATCH", "sampled"]

# ASCII white space as the text contracts name it: space and U+0009 to U+000D.
WHITE = r"\x20\x09-\x0D"
# Rows and bytes of one Arrow batch sent to Python; texts can be long, so batches are small.
ROWS_PER_BATCH, BYTES_PER_BATCH = 500, 8 << 20
# Rows of ids and marks that may be broadcast.
BROADCAST_ROWS = 200_000
# Rows whose fold is 0 are held out of every fit.
FOLDS = 5


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def named(rows: DataFrame, *names: str) -> DataFrame:
    """Columns by their exact names, whatever the others are called; of equal names the first."""
    at = {name: i for i, name in reversed(list(enumerate(rows.columns)))}
    plain = rows.toDF(*[f"_{i}" for i in range(len(rows.columns))])
    return plain.select(*[F.col(f"_{at[n]}").alias(n) for n in names])


def quoted(name: str) -> str:
    """A column's name as an expression that means just it."""
    return f"`{name.replace('`', '``')}`"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again; unlike after a checkpoint, plans know their size.

    Loops of joins need that: estimates of checkpointed tables multiply from round to round.
    """
    path = run_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def one_of_each(docs: DataFrame, kept: DataFrame, mark: Column) -> DataFrame:
    """The rows of `docs` whose (doc_id, mark of the text) is in `kept`(doc_id, mark); of repeated rows one.

    Rows are told apart by id and mark alone; a row's own columns move only if it is repeated, or
    if the rows to leave out are too many to broadcast.
    """
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), mark.alias("_mark"))
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("mark").alias("_kept_mark"), F.lit(True).alias("_kept")).distinct()
    own = rows.groupBy("_id", "_mark").agg(F.count(F.lit(1)).alias("_n"))
    own = own.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_mark") == F.col("_kept_mark")), "left")
    odd = own.where("_kept IS NULL OR _n > 1").select(F.col("_id").alias("_odd_id"), F.col("_mark").alias("_odd_mark"), F.col("_kept").isNotNull().alias("_again"))
    odd = cut_lineage(odd)

    def side(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if odd.count() <= BROADCAST_ROWS else table

    same = F.col("_id").eqNullSafe(F.col("_odd_id")) & (F.col("_mark") == F.col("_odd_mark"))
    plain = rows.join(side(odd.select("_odd_id", "_odd_mark")), same, "left_anti")
    again = odd.where("_again").select("_odd_id", "_odd_mark")
    if not again.isEmpty():
        plain = plain.unionByName(rows.join(side(again), same, "left_semi").dropDuplicates(["_id", "_mark"]))
    return plain.select("_row.*")


def self_contained(module: str) -> None:
    """Ship the functions of a module by value, so workers need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def word_count(text: Column) -> Column:
    """Number of maximal runs of anything but ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("long")


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id counts as the empty text, fold 0."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def sampled(rows: DataFrame, chosen: DataFrame, limit: int) -> DataFrame:
    """At most `limit` rows of `rows`: those whose doc_id is among the first of `chosen` by hash.

    Ids are picked from the narrow table `chosen`, whose other columns come along, so texts of other
    rows are not moved. The list is broadcast: it has `limit` rows at most.
    """
    kept = chosen.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return rows.join(F.broadcast(kept), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(limit)
