"""Typed scans of raw tables and seeds."""

from __future__ import annotations

import csv
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import Settings
from .schemas import RAW_DDL, SEED_DDL, raw_schema

SEED_DIR = Path(__file__).parent / "seeds"


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast a frame to the declared columns; an absent column is null.

    Zoneless timestamps become instants. Unknown columns are dropped.
    """
    given = {f.name: f.dataType for f in df.schema}
    return df.selectExpr(
        *[
            f"`{f.name}`"
            if given.get(f.name) == f.dataType
            else f"cast({f'`{f.name}`' if f.name in given else 'null'} as"
            f" {f.dataType.simpleString()}) as `{f.name}`"
            for f in schema
        ]
    )


def scan(spark: SparkSession, settings: Settings, system: str, table: str) -> DataFrame:
    """Read one raw table from its parquet folder with the declared types.

    The schema is given, so no footer is read for inference, absent columns come
    back null and zoneless timestamps are read as instants.
    """
    return spark.read.schema(raw_schema(system, table)).parquet(
        settings.source_path(system, table)
    )


class RawTables:
    """Raw tables by system and table name.

    ``raw("shopify", "orders")`` scans the configured folder, unless a frame (or
    a function making it) was handed in.
    """

    def __init__(
        self,
        spark: SparkSession,
        settings: Settings | None = None,
        frames: dict[tuple[str, str], DataFrame | Callable[[], DataFrame]] | None = None,
    ):
        self.spark = spark
        self._settings = settings
        self._frames = frames or {}
        self._read: dict[tuple[str, str], DataFrame] = {}

    def __call__(self, system: str, table: str) -> DataFrame:
        key = (system, table)
        if key not in self._read:
            self._read[key] = self._make(system, table)
        return self._read[key]

    def _make(self, system: str, table: str) -> DataFrame:
        if table not in RAW_DDL[system]:
            raise KeyError(f"{system}.{table} is not declared")
        given = self._frames.get((system, table))
        if given is not None:
            df = given() if callable(given) else given
            return conform(df, raw_schema(system, table))
        if self._settings is None:
            raise KeyError(f"no frame and no settings for {system}.{table}")
        return scan(self.spark, self._settings, system, table)


def seed_rows(name: str) -> list[dict[str, str]]:
    """A seed's rows as text. Seeds are versioned files of a few dozen rows."""
    with open(SEED_DIR / f"{name}.csv", newline="", encoding="utf-8") as handle:
        lines = (line for line in handle if not line.startswith("#"))
        return list(csv.DictReader(lines))


def seed(spark: SparkSession, name: str) -> DataFrame:
    """A seed as a typed frame.

    The file ships with the package. Its rows travel inside the plan as literals,
    so no executor needs the file and the optimizer knows the exact size when it
    decides on a broadcast.
    """
    schema = StructType.fromDDL(SEED_DDL[name])
    rows = seed_rows(name)
    args = {
        f"r{i}c{j}": row[f.name] for i, row in enumerate(rows) for j, f in enumerate(schema)
    }
    values = ", ".join(
        "(" + ", ".join(f":r{i}c{j}" for j in range(len(schema))) + ")" for i in range(len(rows))
    )
    columns = ", ".join(f.name for f in schema)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS seed({columns})", args=args)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def seed_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A seed kept by the user as CSV on shared storage, read with the declared types."""
    return (
        spark.read.schema(StructType.fromDDL(SEED_DDL[name]))
        .option("header", "true")
        .option("comment", "#")
        .option("mode", "FAILFAST")
        .csv(path)
    )
