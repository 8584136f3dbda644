"""Documents to training pieces: reject toxic texts, drop copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of documents. Mixing returns a document as often as it is copied. The last stage returns
the columns but the text, with the text's piece ids and their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import dedup, jaccard, mixing, pieces, simhash, toxicity
from tidewire.llm.common import prepare, table
from tidewire.session import drop_dir, run_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labels of the documents that come in."""
    prepare(spark)
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies are linked by op6's method, SimHash in a Gray-order hierarchical index, or share 0.8 or
    more of their five-word shingles, of which SimHash alone loses most; groups are components of both."""
    prepare(spark)
    alike = simhash.near_groups(docs).select("text_md5", "root")
    return simhash.deduplicated(docs, jaccard.near_groups(docs, alike))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pieces.encoded(docs).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    # op6's SimHash groups, joined with pairs of five-word Jaccard 0.8 or more (MinHash bands, then the exact similarity).
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("sentencepiece", encode),
]

# Trained models, connected components and piece lattices have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again. What a stage
    read is removed once it is written; only the folder that the result reads from stays."""
    docs = table(spark, sf_dir, "documents")
    root, before = run_dir(spark, "pipeline"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        if before is not None:
            drop_dir(spark, f"{root}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
