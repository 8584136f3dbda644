"""Registry of named queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The test tables by attribute name."""

    spark: SparkSession
    sf_dir: str

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL check returns them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` under a name, with its SQL check if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain_times(build(Tables(configure(spark), sf_dir.rstrip("/"))))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
