"""Registered queries of the loads that keep state: incremental tables and history.

Each query runs its loads into a fresh folder on shared storage and reads the
end state back. The reference SQL states that end state directly.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..config import Settings, shared_dir
from ..operators.incremental import DayTable, since
from ..operators.scd2 import History, as_of, changed_only, in_order, recorded_and_source
from ..plans import pipeline
from ..sources.scan import RawTables
from ..sources.starschema import raw_tables, star
from . import marketing
from .present import Query, day, query, ts

FIRST_LOAD_TO = date(2024, 1, 20)
LOOKBACK = 3
RELOAD_FROM = FIRST_LOAD_TO - timedelta(days=LOOKBACK)


def _daily(spark: SparkSession, sf: str, keys: list[str] | None) -> DataFrame:
    """Two loads of the events. Before the second, the source restates every value,
    drops the events of type error and gains a column."""
    source = star(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("date").alias("event_date"),
        "user_id",
        "event_type",
        "value",
    )

    def first(first_day: date | None) -> DataFrame:
        return source.where(F.col("event_date") <= F.lit(FIRST_LOAD_TO))

    def second(first_day: date | None) -> DataFrame:
        return (
            source.where(since(F.col("event_date"), first_day) & (F.col("event_type") != "error"))
            .withColumn("value", F.col("value") + 1)
            .withColumn("is_restated", F.lit(True))
        )

    table = DayTable(spark, shared_dir(spark), "event_date", keys)
    table.load(first, LOOKBACK)
    table.load(second, LOOKBACK)
    return table.read()


def _daily_sql(kept_errors: str) -> str:
    return f"""
        SELECT event_id, {day("ts")} AS event_date, user_id, event_type,
               CASE WHEN fresh THEN value + 1 ELSE value END AS value,
               CASE WHEN fresh THEN true END AS is_restated
        FROM (SELECT *, cast(ts AS date) >= DATE '{RELOAD_FROM}' AND event_type <> 'error' AS fresh
              FROM events)
        WHERE fresh OR cast(ts AS date) < DATE '{RELOAD_FROM}' OR ({kept_errors})"""


SECOND, THIRD = datetime(2002, 1, 1), datetime(2002, 2, 1)
RUNS = (datetime(2001, 12, 1), SECOND + timedelta(hours=1), THIRD + timedelta(hours=1))


def source_states(orders: DataFrame) -> list[DataFrame]:
    """The source before each of three runs; the order priority picks the change.

    1: edited twice. 2: edited once. 3: deleted, then restored with a new time
    (status F), with its old time (P) or not at all (O). 4: new in the second
    state, edited in the third. 5: edited without a new update time.
    """
    c = F.col
    base = orders.select(
        c("o_orderkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("change"),
        c("o_orderstatus").alias("code"),
        F.lit("ACTIVE").alias("status"),
        c("o_totalprice").alias("budget"),
        c("o_orderdate").cast("timestamp").alias("updated_time"),
    )
    second, third = fn.instant(SECOND), fn.instant(THIRD)

    def edited(df: DataFrame, changes: list[int], at, **values) -> DataFrame:
        hit = c("change").isin(changes)
        new = {name: F.when(hit, value).otherwise(c(name)) for name, value in values.items()}
        if at is not None:
            new["updated_time"] = F.when(hit, at).otherwise(c("updated_time"))
        return df.withColumns(new)

    state2 = edited(base, [1], second, budget=c("budget") * 2)
    state2 = edited(state2, [2], second, status=F.lit("PAUSED"))
    state2 = edited(state2, [4], second)
    state2 = edited(state2, [5], None, budget=c("budget") + 1)
    state3 = edited(state2, [1], third, budget=c("budget") / 2)
    state3 = edited(state3, [4], third, budget=c("budget") + 100)
    back = (c("change") == 3) & (c("code") == "F")
    state3 = state3.withColumn("updated_time", F.when(back, third).otherwise(c("updated_time")))
    return [
        df.drop("code")
        for df in (
            base.where("change <> 4"),
            state2.where("change <> 3"),
            state3.where("change <> 3 OR code <> 'O'"),
        )
    ]


def recorded(spark: SparkSession, sf: str, compacted: bool = False) -> tuple[DataFrame, DataFrame]:
    """All versions after three runs, gathered after each of the first two or never, and the last source state."""
    states = source_states(star(spark, sf, "orders"))
    history = History(spark, shared_dir(spark), "id", "updated_time")
    for state, run_time in zip(states, RUNS):
        if compacted and history.compact(after_runs=1):
            history.drop_superseded()
        history.snapshot(state, run_time)
    return history.versions(), states[-1]


def _stamp(moment: datetime) -> str:
    return f"TIMESTAMP '{moment}'"


_T2, _T3, _R2, _R3 = (_stamp(m) for m in (SECOND, THIRD, RUNS[1], RUNS[2]))

# One line per version: change, other condition, status, budget, update time,
# valid from, valid to, deleted.
_VERSIONS = [
    ("1", "", "'ACTIVE'", "b", "d", "d", _T2, "False"),
    ("1", "", "'ACTIVE'", "b * 2", _T2, _T2, _T3, "False"),
    ("1", "", "'ACTIVE'", "b", _T3, _T3, "NULL", "False"),
    ("2", "", "'ACTIVE'", "b", "d", "d", _T2, "False"),
    ("2", "", "'PAUSED'", "b", _T2, _T2, "NULL", "False"),
    ("3", "", "'ACTIVE'", "b", "d", "d", _R2, "False"),
    ("3", "code = 'O'", "'ACTIVE'", "b", "d", _R2, "NULL", "True"),
    ("3", "code = 'F'", "'ACTIVE'", "b", "d", _R2, _T3, "True"),
    ("3", "code = 'F'", "'ACTIVE'", "b", _T3, _T3, "NULL", "False"),
    ("3", "code = 'P'", "'ACTIVE'", "b", "d", _R2, _R3, "True"),
    ("3", "code = 'P'", "'ACTIVE'", "b", "d", _R3, "NULL", "False"),
    ("4", "", "'ACTIVE'", "b", _T2, _T2, _T3, "False"),
    ("4", "", "'ACTIVE'", "b + 100", _T3, _T3, "NULL", "False"),
    ("5", "", "'ACTIVE'", "b", "d", "d", "NULL", "False"),
]

HISTORY_ROWS = " UNION ALL ".join(
    f"""SELECT id, change, {status} AS status, {budget} AS budget, {updated} AS updated_time,
               {start} AS dbt_valid_from, cast({end} AS timestamp) AS dbt_valid_to,
               '{deleted}' AS dbt_is_deleted
        FROM base WHERE change = {change} {f"AND {other}" if other else ""}"""
    for change, other, status, budget, updated, start, end, deleted in _VERSIONS
)
HISTORY_BASE = """WITH base AS (
    SELECT o_orderkey AS id, cast(substr(o_orderpriority, 1, 1) AS bigint) AS change,
           o_orderstatus AS code, o_totalprice AS b, o_orderdate AS d FROM orders)"""
HISTORY_SHOWN = f"""
    SELECT id, change, status, budget, {ts("updated_time")} AS updated_time,
           {ts("dbt_valid_from")} AS dbt_valid_from, {ts("dbt_valid_to")} AS dbt_valid_to,
           dbt_is_deleted
    FROM ({HISTORY_ROWS})
"""
# Ids and update stamps of versions are internal; the rest is compared.
_INTERNAL = ("dbt_scd_id", "dbt_updated_at")

MOMENT = datetime(2002, 1, 15)


def _history(spark, sf):
    return recorded(spark, sf)[0].drop(*_INTERNAL)


def _as_of(spark, sf):
    return as_of(recorded(spark, sf)[0], MOMENT).drop(*_INTERNAL)


def _changed(spark, sf):
    return changed_only(recorded(spark, sf)[0], "id").drop(*_INTERNAL)


def _inspected(spark, sf):
    versions, source = recorded(spark, sf)
    return recorded_and_source(versions, source, ["id", "change", "budget"])


def _refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """A load of all days, then a full refresh from a source that has lost most of them."""
    source = star(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("event_date"), "event_type")
    table = DayTable(spark, shared_dir(spark), "event_date")
    table.load(lambda first_day: source, LOOKBACK)
    late = source.where(F.col("event_date") > F.lit(FIRST_LOAD_TO)).withColumn("source", F.lit("refresh"))
    table.load(lambda first_day: late, LOOKBACK, full_refresh=True)
    return table.read()


def _staged(
    spark: SparkSession, sf: str, system: str, table: str, load: str, day: str, stale: dict, keys: list[str] | None
) -> DataFrame:
    """Two loads of a staging table as the job runs them. The first finds the source some days
    earlier, with values in its last days that the second finds corrected."""
    whole, last = raw_tables(spark, sf, spread=True), F.lit(FIRST_LOAD_TO)
    rows = whole(system, table)
    on = F.to_date(F.col(day).cast("string"), "yyyyMMdd") if load == "ga4_batch" else F.col(day)
    late = on > F.lit(RELOAD_FROM)
    early = rows.where(on <= last).withColumns({c: F.when(late, F.lit(v)).otherwise(F.col(c)) for c, v in stale.items()})
    batch = getattr(pipeline, load)
    loaded = DayTable(spark, f"{shared_dir(spark)}/{table}", "event_date" if load == "ga4_batch" else "date_day", keys)
    loaded.load(batch(RawTables(spark, frames={(system, table): early})), LOOKBACK)
    loaded.load(batch(whole), LOOKBACK)
    return loaded.read()


def _ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Versions in order, with the place in which the sort left them.

    The sorted rows are written; their place is that in their task plus the rows of earlier tasks,
    one count each. Nothing but the order of the rows decides it.
    """
    versions = in_order(recorded(spark, sf)[0], "id")
    path = f"{shared_dir(spark)}/ordered"
    versions.select("id", "dbt_valid_from", F.monotonically_increasing_id().alias("at")).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    counts = rows.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    place = F.col("before") + F.col("at") - F.col("first") + 1
    return rows.join(counts, "part").select("id", "dbt_valid_from", place.cast("bigint").alias("place"))


def _scanned(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files read by declared schema, one system from another folder, through a SQL view."""
    root = shared_dir(spark)
    settings = Settings(root, root, schema_overrides={"facebook_marketing": "sandbox"})
    whole = raw_tables(spark, sf)
    insights, campaigns = whole("facebook_marketing", "ads_insights"), whole("tiktok_marketing", "campaigns")
    insights.drop("reach").write.parquet(f"{root}/sandbox/ads_insights")
    campaigns.write.parquet(f"{root}/tiktok_marketing/campaigns")
    raw = RawTables(spark, settings)
    read = pipeline.Tables(raw, {"scanned_insights": raw("facebook_marketing", "ads_insights"),
                                 "scanned_campaigns": raw("tiktok_marketing", "campaigns")})
    pipeline.register_views({n: read[n] for n in ("scanned_insights", "scanned_campaigns")})
    return spark.sql("""
        SELECT 'insights' AS scanned, count(*) AS all_rows, count(reach) AS reaches, count(DISTINCT date_start) AS days
        FROM scanned_insights
        UNION ALL SELECT 'campaigns', count(*), 0, count(DISTINCT cast(create_time AS date)) FROM scanned_campaigns""")


QUERIES: dict[str, Query] = {
    "ga4_events_loaded": query(
        lambda spark, sf: _staged(spark, sf, "ga4", "events", "ga4_batch", "event_date", {"event_name": "stale"}, None),
        marketing.SQL["ga4_events"],
    ),
    "meta_ad_stats_daily_loaded": query(
        lambda spark, sf: _staged(
            spark, sf, "facebook_marketing", "ads_insights", "ad_stats_batch", "date_start", {"spend": -1.0}, ["ad_id", "date_day"]
        ),
        marketing.SQL["meta_ad_stats_daily"],
    ),
    "full_refresh": query(
        _refreshed,
        f"""SELECT event_id, {day("ts")} AS event_date, event_type, 'refresh' AS source
            FROM events WHERE cast(ts AS date) > DATE '{FIRST_LOAD_TO}'""",
    ),
    "scd2_ordered": query(
        _ordered,
        f"""{HISTORY_BASE} SELECT id, dbt_valid_from, row_number() OVER (ORDER BY id, dbt_valid_from) AS place
            FROM ({HISTORY_SHOWN})""",
    ),
    "declared_scan": query(
        _scanned,
        """SELECT 'insights' AS scanned, count(*) AS all_rows, 0::bigint AS reaches,
                  count(DISTINCT cast(ts AS date)) AS days FROM events
           UNION ALL SELECT 'campaigns', count(*), 0, least(count(*), 1) FROM customer""",
    ),
    "incremental_replace_days": query(
        lambda spark, sf: _daily(spark, sf, None),
        _daily_sql("false"),
    ),
    "incremental_delete_insert": query(
        lambda spark, sf: _daily(spark, sf, ["event_id", "event_date"]),
        _daily_sql(f"event_type = 'error' AND cast(ts AS date) <= DATE '{FIRST_LOAD_TO}'"),
    ),
    "scd2_compacted": query(
        lambda spark, sf: recorded(spark, sf, compacted=True)[0].drop(*_INTERNAL),
        f"{HISTORY_BASE} {HISTORY_SHOWN}",
    ),
    "scd2_history": query(_history, f"{HISTORY_BASE} {HISTORY_SHOWN}"),
    "scd2_as_of": query(
        _as_of,
        f"""{HISTORY_BASE} SELECT * FROM ({HISTORY_SHOWN})
            WHERE dbt_valid_from <= '{MOMENT}.000000' AND dbt_is_deleted = 'False'
              AND coalesce(dbt_valid_to, '9999') > '{MOMENT}.000000'""",
    ),
    "scd2_changed_keys": query(
        _changed, f"{HISTORY_BASE} {HISTORY_SHOWN} WHERE change <> 5"
    ),
    "scd2_recorded_and_source": query(
        _inspected,
        f"""{HISTORY_BASE}
            SELECT 'history' AS where_from, id, change, budget FROM ({HISTORY_ROWS})
            WHERE dbt_valid_to IS NULL
            UNION ALL
            SELECT 'source', id, change,
                   CASE change WHEN 4 THEN b + 100 WHEN 5 THEN b + 1 ELSE b END
            FROM base WHERE change <> 3 OR code <> 'O'""",
    ),
}
