"""Working tables in the folder that the cluster shares."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..config import shared_dir


class Work:
    """Tables of one job. A written table cuts the lineage: lost executors reread it. The folder is
    shared by the cluster and goes when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.dir, self.count = spark, shared_dir(spark), 0

    def stored(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.count += 1
        path = f"{self.dir}/{self.count}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> SparkSession:
    """Let the Python workers of this machine import this package from where the driver did. On a
    cluster install the package on the executors or pass it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    found = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, found]))
    return spark
