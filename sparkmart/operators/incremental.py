"""Incremental tables: parquet partitioned by day, reloaded over a lookback window.

Late data is handled by reprocessing the last days on every run. Two modes:

* replace days: every day in the batch replaces the stored day;
* delete and insert on a key: stored rows whose key is in the batch are replaced,
  other rows of the day stay, even if the source has dropped them.

New columns are appended to the table's schema; rows written before hold nulls.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..config import shared_dir
from ..sources.files import Files

Batch = Callable[[date | None], DataFrame]


def since(day, first_day: date | None):
    """Lookback predicate for a batch; a literal, so partitions are pruned early."""
    return F.lit(True) if first_day is None else day >= F.lit(first_day)


class DayTable:
    """A day-partitioned table on shared storage.

    Spark's dynamic partition overwrite puts a batch in place, a static one a full
    refresh. Neither touches the table before all of its rows are written, but one
    that is lost while it commits can leave some days old, new or missing. So the
    lookback counts from the last day of the last load that finished: the next
    load reaches back at least as far as the lost one and makes all its days anew.
    A load by key also needs the stored rows that the source has dropped; it keeps
    its merged rows, and after a lost load the next one merges with those.
    """

    def __init__(
        self, spark: SparkSession, path: str, day: str, keys: Sequence[str] | None = None
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.day = day
        self.keys = list(keys) if keys else None
        if self.keys and day not in self.keys:
            raise ValueError(f"keys must hold the day column {day}: a row that moves to another day would stay in both")
        self._files = Files(spark)
        self._state_file = f"{self.path}.state"

    def days(self) -> list[date]:
        """Stored days, from the folder names; no file is opened."""
        prefix = f"{self.day}="
        names = [n[len(prefix) :] for n in self._files.folders(self.path) if n.startswith(prefix)]
        return sorted(date.fromisoformat(n) for n in names if n[:1].isdigit())

    def _state(self) -> dict:
        """columns, the last day that a finished load left, the merged rows of a load that didn't finish."""
        text = self._files.read_text(self._state_file)
        return json.loads(text) if text else {"columns": None, "loaded_to": None, "merged": None}

    def _save(self, columns: StructType, loaded_to: str | None, merged: str | None = None) -> None:
        nullable = StructType([StructField(f.name, f.dataType, True) for f in columns])
        state = {"columns": nullable.json(), "loaded_to": loaded_to, "merged": merged}
        self._files.write_text(self._state_file, json.dumps(state))

    def schema(self) -> StructType | None:
        columns = self._state()["columns"]
        return StructType.fromJson(json.loads(columns)) if columns else None

    def read(self) -> DataFrame:
        """The whole table in its current schema; absent columns are null."""
        return self.spark.read.schema(self.schema()).parquet(self.path)

    def load(self, batch: Batch, lookback_days: int, full_refresh: bool = False) -> date | None:
        """Run one load and return the first day it reprocessed, None for all.

        ``batch`` gets that day and returns the source rows from it on. An empty
        table counts as a first run.
        """
        loaded_to = self._state()["loaded_to"]
        if full_refresh or loaded_to is None:
            self._rebuild(batch(None))
            return None
        first_day = date.fromisoformat(loaded_to) - timedelta(days=lookback_days)
        self._reload(batch(first_day), first_day)
        return first_day

    def _rebuild(self, rows: DataFrame) -> None:
        # A static overwrite drops the old rows first, so the new ones are made before it.
        if self._files.exists(self.path):
            rows = self._written(rows, f"{shared_dir(self.spark)}/batch")
        self._save(rows.schema, None)
        self._write(rows, "static")
        self._finish(rows.schema)

    def _reload(self, rows: DataFrame, first_day: date) -> None:
        state, schema = self._state(), self._merged(self.schema(), rows.schema)
        folder = None
        if self.keys:
            fresh = self._written(rows, f"{shared_dir(self.spark)}/batch")
            stored = self.spark.read.schema(self.schema()).parquet(state["merged"] or self.path)
            kept = stored.where(F.col(self.day) >= F.lit(first_day)).join(
                fresh.select(*self.keys).distinct(), self.keys, "left_anti"
            )
            both = fresh.unionByName(kept, allowMissingColumns=True).select(*schema.fieldNames())
            # two folders in turn: a lost load's rows are read while these are written
            folder = f"{self.path}.merged/{int((state['merged'] or '').endswith('0'))}"
            rows = self._written(both, folder)
        else:
            missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in rows.columns]
            rows = rows.select("*", *missing)
        self._save(schema, state["loaded_to"], folder)
        self._write(rows, "dynamic")
        self._finish(schema)

    def _finish(self, schema: StructType) -> None:
        stored = self.days()
        self._save(schema, stored[-1].isoformat() if stored else None)

    def _written(self, rows: DataFrame, folder: str) -> DataFrame:
        """The rows written and read back: the source is read once, and not while the table changes."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _write(self, rows: DataFrame, mode: str) -> None:
        # Rebalancing merges the slivers of a small day and splits a large one.
        (
            rows.hint("rebalance", F.col(self.day))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(self.day)
            .parquet(self.path)
        )

    @staticmethod
    def _merged(stored: StructType, incoming: StructType) -> StructType:
        known = {f.name: f for f in stored}
        for f in incoming:
            old = known.get(f.name)
            if old is not None and old.dataType.simpleString() != f.dataType.simpleString():
                raise ValueError(
                    f"column {f.name} changed from {old.dataType.simpleString()} "
                    f"to {f.dataType.simpleString()}; run a full refresh"
                )
        return StructType([*stored, *[f for f in incoming if f.name not in known]])
