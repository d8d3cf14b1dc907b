"""Registered queries of the data-quality checks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import functions as F

from ..config import shared_dir, shuffles_dropped
from ..operators.quality import Checks, duplicates, failing_rows, linked, orphans, report
from ..plans import intermediate, pipeline
from ..plans.checks import RAW_SUITE, SUITE
from ..sources.catalog import use_schema
from ..sources.scan import conform, raw_schema
from ..sources.starschema import PROJECTIONS, raw_tables, star
from . import marketing, store
from .present import Query, query, seed_values

# The tables that a run writes.
WRITTEN = [name for names in pipeline.WRITTEN.values() for name in names]

# Columns that other tables need of a table that is made once, besides the checks; None: all.
KEPT: dict[str, tuple[str, ...] | None] = {
    "google_campaigns": None,
    "campaign_performance_daily": None,
    "dim_campaigns": None,
    "fct_campaign_performance_daily": (),
    "shopify_order_lines": intermediate.LINE_PRODUCTS,
    "orders_enriched": intermediate.CODE_USE,
}
# Steps of the table report, so that few of these tables and the shuffle of one part lie on disk at a
# time: what is made once, tables of the parts that are then reported (none: all that are left), and
# what is deleted after it.
STEPS: tuple[tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]], ...] = (
    (("google_campaigns", "campaign_performance_daily"), ("campaigns_unioned",), ()),
    (
        ("dim_campaigns", "fct_campaign_performance_daily"),
        ("dim_campaigns",),
        ("campaign_performance_daily", "dim_campaigns", "fct_campaign_performance_daily"),
    ),
    ((), ("google_campaigns",), ("google_campaigns",)),
    (
        ("shopify_order_lines", "orders_enriched"),
        ("orders_enriched", "discount_codes_enriched"),
        ("orders_enriched",),
    ),
    ((), ("shopify_orders",), ("shopify_order_lines",)),
    ((), (), ()),
)

# Checks of the star schema itself; several are meant to fail.
STAR_SUITE: dict[str, Checks] = {
    "orders": Checks(
        not_null=["o_orderkey", "o_custkey"],
        unique=["o_orderkey", "o_custkey"],
        accepted={"o_orderstatus": ("F", "O")},
        minimum={"o_totalprice": 10000},
        refers_to={"o_custkey": ("customer", "c_custkey")},
    ),
    "lineitem": Checks(
        not_null=["l_orderkey", "l_partkey"],
        unique_together=[["l_orderkey", "l_linenumber"], ["l_returnflag"]],
        minimum={"l_discount": 0},
        refers_to={
            "l_orderkey": ("orders", "o_orderkey"),
            "l_partkey": ("supplier", "s_suppkey"),
        },
    ),
    "customer": Checks(
        unique=["c_custkey", "c_name"],
        minimum={"c_acctbal": 0},
        refers_to={"c_nationkey": ("region", "r_regionkey")},
    ),
    "events": Checks(
        not_null=["ts", "props"],
        unique=["event_id"],
        accepted={"event_type": ("view", "click", "purchase")},
        refers_to={"event_id": ("orders", "o_orderkey")},
    ),
    "supplier": Checks(not_null=["s_name"]),
    "region": Checks(unique=["r_name"]),
}


def checks_sql(suite: Mapping[str, Checks], tables: Mapping[str, str]) -> str:
    """Count the failures of every check; ``tables`` gives each table's FROM item."""
    parts = []

    def add(table: str, check: str, column: str, failures: str) -> None:
        parts.append(
            f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name,"
            f" cast(({failures}) AS bigint) AS failures"
        )

    for table, checks in suite.items():
        rows = tables[table]
        for c in checks.not_null:
            add(table, "not_null", c, f'SELECT count(*) FROM {rows} WHERE "{c}" IS NULL')
        for c, values in checks.accepted.items():
            allowed = ", ".join(f"'{v}'" for v in values)
            add(
                table,
                "accepted_values",
                c,
                f'SELECT count(*) FROM {rows} WHERE "{c}" NOT IN ({allowed})',
            )
        for c, low in checks.minimum.items():
            add(table, "accepted_range", c, f'SELECT count(*) FROM {rows} WHERE "{c}" < {low}')
        for c in checks.unique:
            add(
                table,
                "unique",
                c,
                f'SELECT count(*) FROM (SELECT "{c}" FROM {rows} WHERE "{c}" IS NOT NULL'
                " GROUP BY 1 HAVING count(*) > 1)",
            )
        for columns in checks.unique_together:
            keys = ", ".join(f'"{c}"' for c in columns)
            add(
                table,
                "unique_together",
                ", ".join(columns),
                f"SELECT count(*) FROM (SELECT 1 FROM {rows} GROUP BY {keys} HAVING count(*) > 1)",
            )
        for c, (parent, key) in checks.refers_to.items():
            add(
                table,
                "relationships",
                c,
                f'SELECT count(*) FROM {rows} WHERE cast("{c}" AS varchar) NOT IN (SELECT'
                f' cast("{key}" AS varchar) FROM {tables[parent]} WHERE "{key}" IS NOT NULL)',
            )
    return " UNION ALL ".join(parts)


def _star_tables(spark, sf):
    return {name: star(spark, sf, name) for name in STAR_SUITE}


def star_report(spark, sf):
    return report(_star_tables(spark, sf), STAR_SUITE)


def star_failing_rows(spark, sf):
    bad = failing_rows(star(spark, sf, "orders"), STAR_SUITE["orders"])
    return bad.select(
        "o_orderkey", F.array_join(F.sort_array("failed_checks"), "; ").alias("failed_checks")
    )


def repeated_lines(spark, sf):
    return duplicates(star(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def orphan_parts(spark, sf):
    return orphans(
        star(spark, sf, "lineitem"), "l_partkey", star(spark, sf, "supplier"), "s_suppkey"
    )


def table_report(spark, sf):
    """All checks of the built tables. Tables that other tables read are made once; they have the
    columns that the checks and these tables need. Tables that references link are reported together,
    the others one part after another, and what a part leaves on disk goes before the next."""
    tables = pipeline.Tables(raw_tables(spark, sf, spread=True))
    parts, found = linked(SUITE), []
    with shuffles_dropped(spark):
        for made, chosen, dropped in STEPS:
            for name in made:
                also = KEPT[name]
                # 32 hex digits a row and day, twice what the rest of the row takes
                again = [intermediate.campaign_key()] if name == "campaign_performance_daily" else []
                tables.keep(name, None if also is None else list(dict.fromkeys([*SUITE[name].columns(), *also])), again)
            now = [p for p in parts if not chosen or set(p) & set(chosen)]
            parts = [p for p in parts if p not in now]
            found += report(tables, {name: checks for name, checks in SUITE.items() if any(name in p for p in now)}).collect()
            for name in dropped:
                tables.drop(name)
    return spark.createDataFrame(found, "table_name string, check_name string, column_name string, failures bigint")


def written_report(spark, sf):
    """The tables that a run writes, checked as it checks them: rows while writing, keys after it."""
    schema = f"checks_{uuid.uuid4().hex}"
    use_schema(spark, schema, shared_dir(spark))
    tables = pipeline.Tables(raw_tables(spark, sf, spread=True))
    for name in WRITTEN:
        tables.write(name, schema, SUITE[name])
    suite = {name: replace(SUITE[name], refers_to={}) for name in WRITTEN}
    return report(tables, suite, tables.row_failures)


# Raw tables with planted failures: the row-by-row projection of a star table without some values,
# or with rows twice. (star table, its key, condition of the damaged rows, damaged raw column)
DAMAGED = {
    "shopify.orders": ("orders", "o_orderkey", "o_orderstatus = 'P'", "id"),
    "facebook_marketing.campaigns": ("customer", "c_custkey", "c_nationkey = 3", "id"),
    "ga4.events": ("events", "event_id", "event_type = 'error'", "event_name"),
    "tiktok_marketing.campaigns_reports_daily": ("events", "event_id", "event_type = 'click'", "stat_time_day"),
}


def raw_report(spark, sf):
    """All raw checks over tables of which some lack values and some have rows twice."""
    whole = raw_tables(spark, sf)
    raw = {}
    for name in RAW_SUITE:
        system, table = name.split(".")
        raw[name] = whole(system, table)
        if name in DAMAGED:
            source, _, bad, column = DAMAGED[name]
            rows = star(spark, sf, source)
            project = PROJECTIONS[system, table][1]
            part = lambda where: conform(project(rows.where(where)), raw_schema(system, table))  # noqa: E731, B023
            raw[name] = part(f"NOT ({bad})").unionAll(part(bad).withColumn(column, F.lit(None)))
            if RAW_SUITE[name].unique:
                raw[name] = raw[name].unionAll(part(f"NOT ({bad})"))
    return report(raw, RAW_SUITE)


def _raw_report_sql() -> str:
    parts = []
    for table, checks in RAW_SUITE.items():
        source, key, bad, damaged = DAMAGED.get(table, ("region", "r_regionkey", "false", None))
        for check, columns in (("not_null", checks.not_null), ("unique", checks.unique)):
            for column in columns:
                wanted = f"NOT ({bad})" if check == "unique" else bad
                hit = damaged is not None and (check == "unique" or column == damaged)
                count = f"(SELECT count(DISTINCT {key}) FROM {source} WHERE {wanted if hit else 'false'})"
                parts.append(f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, {count}::bigint AS failures")
    return " UNION ALL ".join(parts)


def _built_tables_sql() -> str:
    rows = {**store.SQL, **marketing.SQL}
    seeds = ("channel_mapping", "campaign_attributes", "discount_code_types")
    ctes = [f"t_{name} AS MATERIALIZED ({rows[name]})" for name in SUITE if name not in seeds]
    ctes += [f"t_{name} AS (SELECT * FROM {seed_values(name)})" for name in seeds]
    return f"WITH {', '.join(ctes)} " + checks_sql(SUITE, {name: f"t_{name}" for name in SUITE})


def _written_sql() -> str:
    rows = {**store.SQL, **marketing.SQL}
    ctes = [f"t_{name} AS MATERIALIZED ({rows[name]})" for name in WRITTEN]
    suite = {name: replace(SUITE[name], refers_to={}) for name in WRITTEN}
    return f"WITH {', '.join(ctes)} " + checks_sql(suite, {name: f"t_{name}" for name in WRITTEN})


QUERIES: dict[str, Query] = {
    "dq_star_report": query(star_report, checks_sql(STAR_SUITE, {n: n for n in STAR_SUITE})),
    "dq_failing_rows": query(
        star_failing_rows,
        """
        SELECT * FROM (
          SELECT o_orderkey, concat_ws('; ',
                   CASE WHEN o_totalprice < 10000 THEN 'accepted_range:o_totalprice' END,
                   CASE WHEN o_orderstatus = 'P' THEN 'accepted_values:o_orderstatus' END)
                   AS failed_checks
          FROM orders) WHERE failed_checks <> ''""",
    ),
    "dq_duplicate_keys": query(
        repeated_lines,
        """
        SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, count(*) AS row_count
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    ),
    "dq_orphan_keys": query(
        orphan_parts,
        """
        SELECT l_partkey AS value, count(*) AS row_count FROM lineitem
        WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""",
    ),
    "dq_table_report": query(table_report, _built_tables_sql()),
    "dq_written_report": query(written_report, _written_sql()),
    "dq_raw_report": query(
        raw_report,
        _raw_report_sql(),
    ),
}
