"""Plain column types for comparing results across engines."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import apply_defaults
from ..sources.scan import seed_rows

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A registered query and its reference SQL over the star-schema tables."""

    run: QueryFn
    sql: str | None = None


def present(df: DataFrame) -> DataFrame:
    """Integers as bigint, decimals as double, dates and instants as text."""

    def plain(field: T.StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            return f"cast({name} as bigint) as {name}"
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return f"cast({name} as double) as {name}"
        if isinstance(kind, T.DateType):
            return f"date_format({name}, 'yyyy-MM-dd') as {name}"
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as {name}"
        return name

    return df.selectExpr(*[plain(f) for f in df.schema])


def query(run: QueryFn, sql: str | None = None) -> Query:
    """Register ``run`` under the session defaults, presented in plain types."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(run(apply_defaults(spark), sf_dir))

    return Query(prepared, sql)


# Reference SQL fragments for the same plain types.
def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def seed_values(name: str) -> str:
    """A seed as a VALUES list of text columns."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rows = seed_rows(name)
    columns = list(rows[0])
    body = ", ".join("(" + ", ".join(quoted(r[c]) for c in columns) + ")" for r in rows)
    return f"(VALUES {body}) AS {name}({', '.join(columns)})"
