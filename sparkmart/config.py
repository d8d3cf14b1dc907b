"""Run settings: where the raw tables live and how a run behaves."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .sources.files import Files

# One folder per raw system; a run may point any of them elsewhere.
SYSTEMS = (
    "shopify",
    "ga4",
    "facebook_marketing",
    "google_ads",
    "linkedin_ads",
    "tiktok_marketing",
    "manual",
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Settings:
    """Everything that varies between runs."""

    raw_root: str
    warehouse: str
    schema_overrides: Mapping[str, str] = field(default_factory=dict)
    ad_stats_lookback_days: int = 7
    ga4_lookback_days: int = 3
    spend_tolerance: float = 0.01
    full_refresh: bool = False
    run_checks: bool = True
    # put before the names of the catalog's schemas, for several warehouses in one catalog
    schema_prefix: str = ""
    run_time: datetime = field(default_factory=_now)

    def source_path(self, system: str, table: str) -> str:
        if system not in SYSTEMS:
            raise ValueError(f"unknown source system: {system}")
        return f"{self.raw_root}/{self.schema_overrides.get(system, system)}/{table}"

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.warehouse}/{layer}/{table}"


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder on storage every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Without that setting the
    folder lies in the warehouse, which the executors share as well. What it
    holds is deleted when the driver ends.
    """
    key = "spark.checkpoint.dir"
    root = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    path = f"{root.rstrip('/')}/sparkmart-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end, not whenever the driver
    happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        Files(spark).delete(path)
