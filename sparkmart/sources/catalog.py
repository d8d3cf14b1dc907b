"""Tables in the session's catalog, replaced as a whole.

A refresh writes a table of its own and then lets the view of the plain name show
it. Replacing a view is one change in the catalog, so whoever reads the name, from
any session, gets all old or all new rows. Spark writes, registers and drops the
tables; a metastore that outlives the application makes names outlive it as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Separates a table's name from the number of its version.
_MARK = "__v"


def use_schema(spark: SparkSession, schema: str, location: str) -> None:
    """Create a schema whose tables lie in a folder."""
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}` LOCATION '{quoted}'")


def versions(spark: SparkSession, schema: str, name: str) -> list[str]:
    """The stored versions of a table, oldest first."""
    found = spark.sql(f"SHOW TABLES IN `{schema}` LIKE '{name}{_MARK}*'").collect()
    return sorted((r.tableName for r in found), key=lambda n: int(n.split(_MARK)[-1].split("_")[0]))


def publish(df: DataFrame, schema: str, name: str, keep: int = 2) -> DataFrame:
    """Replace ``schema.name`` by the rows and read it back.

    ``keep`` versions stay, so a query that began before the refresh can end. A
    refresh that fails leaves the name as it was, and a folder that nothing names.
    """
    spark = df.sparkSession
    before = versions(spark, schema, name)
    number = int(before[-1].split(_MARK)[-1].split("_")[0]) + 1 if before else 1
    # a name of its own: files of a lost refresh may lie under the plain number
    table = f"`{schema}`.`{name}{_MARK}{number}_{uuid.uuid4().hex[:8]}`"
    df.write.format("parquet").saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS SELECT * FROM {table}")
    for old in before[: len(before) + 1 - keep]:
        spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{old}`")
    return spark.table(table)
