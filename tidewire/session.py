"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Repeated <meta> names and repeated JSON keys: the last one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings; cheap and idempotent, so every entry point calls it."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only in local mode, and where the session names none, a fresh temporary folder is used, and
    remembered so that later calls agree. On a cluster no folder is guessed.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"{_CHECKPOINT_KEY} must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tidewire-")
        spark.conf.set(_CHECKPOINT_KEY, named)
    return named.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared one, never reused between runs."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that `run_dir` named, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a plan with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
