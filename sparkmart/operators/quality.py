"""Data-quality checks. Each check has failing rows; none means it passed.

The report reads every table once for all of its checks; row checks can also be
counted by the job that writes the table. Checks across rows aggregate on the key
before anything else, so a hot key is one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .conform import union_all
from .enrich import unmatched


@dataclass(frozen=True)
class Checks:
    """What must hold for one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_together: Sequence[Sequence[str]] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    minimum: Mapping[str, float] = field(default_factory=dict)
    # column -> (parent table, parent column)
    refers_to: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def __len__(self) -> int:
        return sum(
            len(part)
            for part in (
                self.not_null,
                self.unique,
                self.unique_together,
                self.accepted,
                self.minimum,
                self.refers_to,
            )
        )

    def columns(self) -> list[str]:
        """The table's columns that the checks read."""
        together = [c for columns in self.unique_together for c in columns]
        return list(dict.fromkeys([*self.not_null, *self.unique, *together, *self.accepted, *self.minimum, *self.refers_to]))


def _row_checks(checks: Checks) -> list[tuple[str, str, Column]]:
    """(check, column, predicate of a failing row) for the checks on single rows."""
    out = [("not_null", c, F.col(c).isNull()) for c in checks.not_null]
    out += [("accepted_values", c, ~F.col(c).isin(*v)) for c, v in checks.accepted.items()]
    out += [("accepted_range", c, F.col(c) < F.lit(low)) for c, low in checks.minimum.items()]
    return out


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """The same for one column, whose nulls do not count."""
    return duplicates(df.where(F.col(column).isNotNull()), [column])


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child values without a parent row, with their row count.

    The same id can be text in one system and a number in another; such keys are
    compared as text, since a cast to a number fails on any other text.
    """
    value, key = F.col(column), F.col(parent_column)
    if child.schema[column].dataType != parent.schema[parent_column].dataType:
        value, key = value.cast("string"), key.cast("string")
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count("*").alias("row_count"))
    )
    return unmatched(values, parent.select(key.alias("value")), ["value"])


def failing_rows(df: DataFrame, checks: Checks) -> DataFrame:
    """Rows that break a row-level check, with the names of the broken checks."""
    names = F.array(
        *[F.when(bad, F.lit(f"{name}:{column}")) for name, column, bad in _row_checks(checks)]
    )
    marked = df.withColumn("failed_checks", F.array_compact(names))
    return marked.where(F.size("failed_checks") > 0)


class Watch:
    """Row checks counted while a table is written: the same job, no scan of its own."""

    def __init__(self, df: DataFrame, checks: Checks):
        self._parts = _row_checks(checks)
        self._seen = Observation()
        counts = [F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(self._parts)]
        #: The rows to write.
        self.rows = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    def failures(self) -> dict[tuple[str, str], int]:
        """(check, column) and the number of failing rows. Waits for the write."""
        found = self._seen.get
        return {(name, column): found[f"c{i}"] for i, (name, column, _) in enumerate(self._parts)}


class _Plan:
    """What a report looks at. A slot is a key of a table or a row check. Keys that a reference
    links form a group, in which each has its place; a check reads one or two places of a group."""

    def __init__(self):
        self.entries: dict[str, list[tuple[int, Column]]] = {}
        self.slots: dict[tuple, int] = {}
        self.checks: list[tuple[str, str, str]] = []
        self.uses: list[tuple[int, int, int, int | None]] = []
        self._group: list[int] = []

    def check(self, table: str, name: str, column: str) -> int:
        self.checks.append((table, name, column))
        return len(self.checks) - 1

    def _slot(self, known: tuple, table: str, value: Column) -> int:
        if known not in self.slots:
            slot = self.slots[known] = len(self.slots)
            self._group.append(slot)
            self.entries.setdefault(table, []).append((slot, value))
        return self.slots[known]

    def failing(self, table: str, check: int, bad: Column) -> None:
        self.uses.append((check, self._slot((table, check), table, F.when(bad, F.lit(""))), 1, None))

    def key(self, table: str, columns: tuple[str, ...], together: bool = False) -> int:
        """Count the values of a key, once for all checks that use it. Nulls of one column don't
        count, those of several columns are values. Values are compared as text: the same id can be
        text in one system and a number in another."""
        # named by place, since every row of the shuffle carries the names
        several = F.to_json(F.struct(*[F.col(c).alias(str(i)) for i, c in enumerate(columns)]))
        return self._slot((table, columns, together), table, several if together else F.col(columns[0]).cast("string"))

    def unique(self, check: int, slot: int) -> None:
        self.uses.append((check, slot, 2, None))

    def refers(self, check: int, child: int, parent: int) -> None:
        old, new = self._group[child], self._group[parent]
        self._group = [new if g == old else g for g in self._group]
        self.uses.append((check, child, 1, parent))

    def places(self) -> list[tuple[int, int]]:
        """Group and place in it, by slot."""
        return [(g, self._group[:slot].count(g)) for slot, g in enumerate(self._group)]


def linked(suite: Mapping[str, Checks]) -> list[list[str]]:
    """The tables of a suite in parts that no reference links: each can be reported on its own."""
    parents = [parent for checks in suite.values() for parent, _ in checks.refers_to.values()]
    part = {table: [table] for table in [*suite, *parents]}
    for table, checks in suite.items():
        for parent, _ in checks.refers_to.values():
            if part[table] is not part[parent]:
                part[parent] += part[table]
                part.update(dict.fromkeys(part[table], part[parent]))
    return list({id(p): p for p in part.values()}.values())


def _plan(suite: Mapping[str, Checks], known: Mapping[str, Mapping[tuple[str, str], int]]) -> _Plan:
    plan = _Plan()
    for table, checks in suite.items():
        for name, column, bad in _row_checks(checks):
            check = plan.check(table, name, column)
            if table not in known:
                plan.failing(table, check, bad)
        for column in checks.unique:
            plan.unique(plan.check(table, "unique", column), plan.key(table, (column,)))
        for columns in checks.unique_together:
            check = plan.check(table, "unique_together", ", ".join(columns))
            plan.unique(check, plan.key(table, tuple(columns), together=True))
        for column, (parent, parent_column) in checks.refers_to.items():
            check = plan.check(table, "relationships", column)
            plan.refers(check, plan.key(table, (column,)), plan.key(parent, (parent_column,)))
    return plan


def report(
    tables: Mapping[str, DataFrame],
    suite: Mapping[str, Checks],
    known: Mapping[str, Mapping[tuple[str, str], int]] | None = None,
) -> DataFrame:
    """One row per check with its number of failures.

    Failures count rows, except for uniqueness where they count repeated keys. ``known`` holds the
    row checks of tables that were counted while they were written.

    Every table is read once, for all of its checks, and only the columns they need. A row gives one
    entry for each key and one for each check that it fails; they are counted before the shuffle, so
    a hot key is one row a task. A key that several checks use is counted once. Keys that references
    link meet in the same shuffle, which counts each value by its place in the group.
    """
    known = known or {}
    plan = _plan(suite, known)
    spark = next(iter(tables.values())).sparkSession
    names = [(i, *names, known.get(names[0], {}).get(names[1:], 0)) for i, names in enumerate(plan.checks)]
    listed = spark.createDataFrame(names, "check int, table_name string, check_name string, column_name string, before long")
    if not plan.entries:
        return listed.select("table_name", "check_name", "column_name", F.col("before").alias("failures"))
    places = plan.places()
    wide = range(max(place for _, place in places) + 1)

    def entry(slot: int, value: Column) -> Column:
        group, place = places[slot]
        return F.struct(F.lit(group).alias("group"), F.lit(place).alias("place"), value.alias("value"))

    parts = [tables[t].select(F.inline(F.array(*[entry(*e) for e in entries]))) for t, entries in plan.entries.items()]
    entries = union_all([part.where(F.col("value").isNotNull()) for part in parts])
    counts = entries.groupBy("group", "value").agg(*[F.count_if(F.col("place") == i).alias(f"n{i}") for i in wide])
    # a check fails by the rows at its place, or by the value if that must not repeat
    uses = spark.createDataFrame(
        [(check, *places[slot], least, places[parent][1] if parent is not None else None) for check, slot, least, parent in plan.uses],
        "check int, group int, place int, least int, parent int",
    )
    n = F.array(*[f"n{i}" for i in wide])
    rows = F.get(n, F.col("place"))
    lost = F.col("parent").isNull() | (F.get(n, F.col("parent")) == 0)
    # as many rows as the suite has checks, whatever the tables hold
    found = counts.join(F.broadcast(uses), "group").where((rows >= F.col("least")) & lost)
    failing = found.groupBy("check").agg(F.sum(F.when(F.col("least") == 2, F.lit(1).cast("long")).otherwise(rows)).alias("failing"))
    failures = (F.col("before") + F.coalesce("failing", F.lit(0))).cast("bigint").alias("failures")
    return listed.join(failing, "check", "left").select("table_name", "check_name", "column_name", failures)
