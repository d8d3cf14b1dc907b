"""Type-2 history of a table whose rows carry an update time.

A version is valid from its row's update time until the next one's. Only a moved
update time opens a version: an edit that leaves it alone is missed, by design.
A row that disappears from the source closes its version at the run time and adds
a record flagged as deleted; if it comes back, a new version follows that record.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import instant
from ..sources.files import Files

# Columns added to the source columns, and the flag's texts.
SCD_ID, UPDATED_AT = "dbt_scd_id", "dbt_updated_at"
VALID_FROM, VALID_TO, DELETED = "dbt_valid_from", "dbt_valid_to", "dbt_is_deleted"
YES, NO = "True", "False"
# Columns of the storage: the run that opened a version, and whether it is open.
OPENED, IS_OPEN = "_opened_run", "_is_open"
_ADDED = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO, DELETED)
_EMPTY = f"{SCD_ID} string, {UPDATED_AT} timestamp, {VALID_FROM} timestamp, {VALID_TO} timestamp, {DELETED} string"


def _version(
    row: str, columns: list[str], key: str, updated: Column, start: Column, end: Column, flag: str
) -> Column:
    identity = F.md5(F.concat_ws("|", F.col(f"{row}.{key}").cast("string"), updated.cast("string")))
    return F.struct(
        *[F.col(f"{row}.{c}").alias(c) for c in columns],
        identity.alias(SCD_ID),
        updated.alias(UPDATED_AT),
        start.alias(VALID_FROM),
        end.alias(VALID_TO),
        F.lit(flag).alias(DELETED),
    )


def _stored(columns: list[str], end: Column) -> Column:
    return F.struct(
        *[F.col(f"old.{c}").alias(c) for c in columns],
        F.col(f"old.{SCD_ID}").alias(SCD_ID),
        F.col(f"old.{UPDATED_AT}").alias(UPDATED_AT),
        F.col(f"old.{VALID_FROM}").alias(VALID_FROM),
        end.alias(VALID_TO),
        F.col(f"old.{DELETED}").alias(DELETED),
    )


def checked(source: DataFrame, key: str) -> DataFrame:
    """The source; a null or repeated key stops the run that reads it.

    Either would open one more version with every run. Counting per key uses the
    shuffle that the comparison with the open versions needs anyway.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy(key))
    bad = F.col(key).isNull() | (F.col("_rows") > 1)
    message = F.concat(F.lit(f"history needs one row per {key}, found several or none for: "),
                       F.coalesce(F.col(key).cast("string"), F.lit("null")))
    stop = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return source.withColumn("_rows", rows).where(stop).drop("_rows")


def changes(
    open_versions: DataFrame | None, source: DataFrame, key: str, updated_at: str, run_time: datetime, run: int
) -> DataFrame:
    """What a run changes: the versions that it closes, as they end, and those that it opens.

    One full outer join on the key; a pair gives no row, one or two. ``open_versions`` is None in the
    first run. Rows carry the run that opened the version, which with the key names a version.
    """
    none = F.lit(None).cast("timestamp")
    at = F.col(f"new.{updated_at}")
    if open_versions is None:
        row = checked(source, key).select(F.struct("*").alias("new"))
        versions = F.array(_version("new", source.columns, key, at, at, none, NO))
        old_run = F.lit(None)
    else:
        types = {f.name: f.dataType for f in open_versions.schema if f.name not in (*_ADDED, OPENED)}
        types |= {f.name: f.dataType for f in source.schema}
        columns = list(types)

        def padded(df: DataFrame) -> list[Column]:
            have = set(df.columns)
            return [
                (F.col(f"`{c}`") if c in have else F.lit(None)).cast(types[c]).alias(c) for c in columns
            ]

        old_rows = open_versions.select(
            F.col(key).alias("_old_key"), OPENED, F.struct(*padded(open_versions), *_ADDED).alias("old")
        )
        new_rows = checked(source, key).select(F.col(key).alias("_new_key"), F.struct(*padded(source)).alias("new"))
        row = old_rows.join(new_rows, F.col("_old_key") == F.col("_new_key"), "full")
        now = instant(run_time)
        started = F.col(f"old.{VALID_FROM}")
        was_deleted = F.col(f"old.{DELETED}") == YES
        # A row restored with its old update time starts at the run time.
        back_at = F.when(at > started, at).otherwise(now)

        new = _version("new", columns, key, at, at, none, NO)
        restored = _version("new", columns, key, back_at, back_at, none, NO)
        gone = _version("old", columns, key, now, now, none, YES)
        versions = (
            F.when(F.col("old").isNull(), F.array(new))
            .when(F.col("new").isNull() & ~was_deleted, F.array(_stored(columns, now), gone))
            .when(F.col("new").isNotNull() & was_deleted, F.array(_stored(columns, back_at), restored))
            .when(F.col("new").isNotNull() & (at > started), F.array(_stored(columns, at), new))
        )
        old_run = F.col(OPENED)
    is_open = F.col(f"v.{VALID_TO}").isNull()
    return row.select(old_run.alias("_old_run"), F.explode(versions).alias("v")).select(
        "v.*",
        F.when(is_open, F.lit(run)).otherwise(F.col("_old_run")).cast("long").alias(OPENED),
        is_open.alias(IS_OPEN),
    )


class History:
    """A type-2 history on shared storage, as the changes of every run.

    ``run=N`` holds the versions that run N closed and opened; a version is open while no later run
    has closed it. ``compact`` gathers runs, so that readers don't have to match ever more of them:
    ``closed=M-N`` has the versions closed after run M, up to which runs were gathered before, and
    ``open=N`` those open after run N. Nothing that is written is touched again. A folder counts once
    Spark's success marker exists, a compaction's with that of ``open=N``, its last one; so what a
    failed run wrote is invisible and its retry replaces it.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, updated_at: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.updated_at = updated_at
        self._files = Files(spark)

    def _done(self, kind: str) -> list[str]:
        names = [n for n in self._files.folders(self.path) if n.startswith(f"{kind}=")]
        done = [n for n in names if self._files.exists(f"{self.path}/{n}/_SUCCESS")]
        return [n.partition("=")[2] for n in done]

    def runs(self) -> list[int]:
        """Runs whose changes are still stored one by one, and compacted ones that aren't dropped."""
        return sorted(map(int, self._done("run")))

    def _bases(self) -> list[int]:
        return sorted(map(int, self._done("open")))

    def _since(self) -> tuple[int, list[int]]:
        """The last compacted run, 0 for none, and the runs after it."""
        base = max(self._bases(), default=0)
        return base, [r for r in self.runs() if r > base]

    def snapshot(self, source: DataFrame, run_time: datetime) -> None:
        """Record the source as of ``run_time``: only rows that changed are written."""
        base, tail = self._since()
        run = max([base, *tail]) + 1
        current = self._current() if run > 1 else None
        rows = changes(current, source, self.key, self.updated_at, run_time, run)
        self._write(rows, f"run={run}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(f"{self.path}/{folder}")
        )

    def _read(self, folders: list[str]) -> DataFrame:
        # The newest run has the widest schema; older ones fill up with nulls.
        base, tail = self._since()
        newest = f"run={tail[-1]}" if tail else f"open={base}"
        schema = self.spark.read.parquet(f"{self.path}/{newest}").schema
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _current(self) -> DataFrame:
        """The open versions: those opened and not closed since."""
        base, tail = self._since()
        folders = [f"open={base}"] * bool(base) + [f"run={r}" for r in tail]
        opened = self._read(folders).where(F.col(IS_OPEN)).drop(IS_OPEN)
        if not tail:
            return opened
        closed = self._read([f"run={r}" for r in tail]).where(~F.col(IS_OPEN)).select(self.key, OPENED)
        return opened.join(closed, [self.key, OPENED], "left_anti")

    def compact(self, after_runs: int = 16) -> bool:
        """Gather the runs since the last compaction once there are so many of them.

        Open versions are written anew then, and only then; closed ones once in all."""
        base, tail = self._since()
        if len(tail) < max(1, after_runs):
            return False
        closed = self._read([f"run={r}" for r in tail]).where(~F.col(IS_OPEN))
        self._write(closed, f"closed={base}-{tail[-1]}")
        self._write(self._current().withColumn(IS_OPEN, F.lit(True)), f"open={tail[-1]}")
        return True

    def drop_superseded(self) -> None:
        """Delete what a compaction has gathered: its runs, and the open versions of earlier ones."""
        bases = self._bases()
        for run in self.runs():
            if bases and run <= bases[-1]:
                self._files.delete(f"{self.path}/run={run}")
        for base in bases[:-1]:
            self._files.delete(f"{self.path}/open={base}")

    def _gathered(self, base: int) -> list[str]:
        """The folders of closed versions up to a compaction, each named after the one before it."""
        before = {int(name.partition("-")[2]): name for name in self._done("closed")}
        folders = []
        while base:
            folders.append(f"closed={before[base]}")
            base = int(before[base].partition("-")[0])
        return folders

    def versions(self) -> DataFrame:
        """Every version, open and closed; none before the first run."""
        base, tail = self._since()
        if not base and not tail:
            return self.spark.createDataFrame([], _EMPTY)
        closed = self._read([*self._gathered(base), *[f"run={r}" for r in tail]]).where(~F.col(IS_OPEN))
        return closed.drop(OPENED, IS_OPEN).unionByName(self._current().drop(OPENED))


def as_of(versions: DataFrame, moment: datetime) -> DataFrame:
    """Versions valid at a moment, without the records of deleted rows."""
    at = instant(moment)
    valid = (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at))
    return versions.where(valid & (F.coalesce(F.col(DELETED), F.lit(NO)) != YES))


def changed_only(versions: DataFrame, key: str) -> DataFrame:
    """All versions of the keys that have more than one."""
    several = versions.groupBy(key).count().where("count > 1").select(key)
    return versions.join(several, key, "left_semi")


def in_order(versions: DataFrame, key: str) -> DataFrame:
    """Versions by key and start, nulls last. Sorting is by range, not in one task."""
    return versions.orderBy(F.col(key).asc_nulls_last(), F.col(VALID_FROM).asc_nulls_last())


def recorded_and_source(versions: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """Open versions and source rows side by side, labelled, to spot missed edits."""
    recorded = versions.where(F.col(VALID_TO).isNull())
    return recorded.select(F.lit("history").alias("where_from"), *columns).unionByName(
        source.select(F.lit("source").alias("where_from"), *columns)
    )
