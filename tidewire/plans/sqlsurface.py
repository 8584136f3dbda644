"""SQL over the stored tables: Spark parses, plans and runs it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Parsed statements whose plan is a command but only reports.
_REPORTS = ("Show", "Describe", "Explain")
# Parsed nodes that change something, wherever they stand in the tree.
_CHANGES = (
    "InsertInto", "OverwriteBy", "OverwritePartitions", "AppendData", "Create", "Replace", "Drop", "Alter", "Truncate", "Delete",
    "Update", "Merge", "Set", "Add", "Rename", "Refresh", "Cache", "Uncache", "Analyze", "Load", "Repair", "Recover", "Comment", "Reset", "Call",
)


def is_read(spark: SparkSession, sql: str) -> bool:
    """Whether Spark parses the statement as a query or a report, not as a command that changes something."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql.strip().rstrip(";"))
    tree = plan.treeString()
    names = [line.lstrip(" :+-'").split(" ")[0].split("(")[0] for line in tree.splitlines() if line.strip()]
    if names[0].startswith(_REPORTS):
        return True
    return not any(n.endswith("Command") or n.startswith(_CHANGES) for n in names)


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, read_only: bool = True) -> DataFrame:
    """One statement. Columns are the frame's; rows stay distributed until the caller acts."""
    if read_only and not is_read(spark, sql):
        raise ValueError("only reading statements are allowed here")
    return spark.sql(sql.strip().rstrip(";"))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables by name; of a database only its stored ones, without the session's views."""
    if database:
        return spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").select("tableName").orderBy("tableName")
    return spark.sql("SHOW TABLES").select("tableName").orderBy("tableName")


def table_schema(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW CREATE TABLE {table}")
