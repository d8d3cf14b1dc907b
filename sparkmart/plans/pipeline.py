"""All tables by name, as lazy plans, and the job that writes them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings, shared_dir
from ..functions import day_to_text
from ..operators.incremental import DayTable, since
from ..operators.quality import Checks, Watch
from ..operators.scd2 import History
from ..sources.catalog import publish, use_schema
from ..sources.files import Files
from ..sources.scan import RawTables, seed
from ..sources.schemas import SEED_DDL
from . import ads, checks, ga4, intermediate, marts, shopify

# table -> (raw system, raw table, plan)
STAGING: dict[str, tuple[str, str, Callable[[DataFrame], DataFrame]]] = {
    "shopify_orders": ("shopify", "orders", shopify.orders),
    "shopify_order_lines": ("shopify", "orders", shopify.order_lines),
    "shopify_order_refunds": ("shopify", "order_refunds", shopify.order_refunds),
    "shopify_order_refund_lines": ("shopify", "order_refunds", shopify.order_refund_lines),
    "shopify_customers": ("shopify", "customers", shopify.customers),
    "shopify_customer_addresses": ("shopify", "customers", shopify.customer_addresses),
    "shopify_customer_default_addresses": (
        "shopify",
        "customers",
        shopify.customer_default_addresses,
    ),
    "shopify_customer_email_consents": ("shopify", "customers", shopify.customer_email_consents),
    "shopify_customer_journeys": (
        "shopify",
        "customer_journey_summary",
        shopify.customer_journeys,
    ),
    "shopify_discount_codes": ("shopify", "discount_codes", shopify.discount_codes),
    "shopify_price_rules": ("shopify", "price_rules", shopify.price_rules),
    "shopify_products": ("shopify", "products", shopify.products),
    "shopify_product_variants": ("shopify", "product_variants", shopify.product_variants),
    "ga4_events": ("ga4", "events", ga4.events),
    "ga4_event_items": ("ga4", "events", ga4.event_items),
    "meta_ad_stats_daily": ("facebook_marketing", "ads_insights", ads.meta_ad_stats_daily),
    "meta_campaigns": ("facebook_marketing", "campaigns", ads.meta_campaigns),
    "google_campaigns": ("google_ads", "campaign", ads.google_campaigns),
    "google_campaign_stats_daily": ("google_ads", "campaign", ads.google_campaign_stats_daily),
    "linkedin_campaigns": ("linkedin_ads", "campaigns", ads.linkedin_campaigns),
    "linkedin_campaign_groups": ("linkedin_ads", "campaign_groups", ads.linkedin_campaign_groups),
    "linkedin_campaign_stats_daily": (
        "linkedin_ads",
        "ad_campaign_analytics",
        ads.linkedin_campaign_stats_daily,
    ),
    "tiktok_campaigns": ("tiktok_marketing", "campaigns", ads.tiktok_campaigns),
    "tiktok_campaign_stats_daily": (
        "tiktok_marketing",
        "campaigns_reports_daily",
        ads.tiktok_campaign_stats_daily,
    ),
}


def staging_table(raw: RawTables, name: str) -> DataFrame:
    system, table, plan = STAGING[name]
    return plan(raw(system, table))


def _codes(t: Tables) -> DataFrame:
    return intermediate.discount_codes_enriched(
        t["shopify_discount_codes"],
        t["shopify_price_rules"],
        t["discount_code_types"],
        t["orders_enriched"],
    )


def _orders(t: Tables) -> DataFrame:
    orders, lines = t["shopify_orders"], None
    if t.is_stored("shopify_order_lines"):
        lines = t["shopify_order_lines"]
    elif not t.is_stored("shopify_orders"):
        # order ids are unique, or the checks stop the run: totals come with the row
        orders = shopify.orders(t.raw("shopify", "orders"), line_totals=True)

    def narrow(columns: Sequence[str]) -> DataFrame:
        if lines is not None:
            return lines.select(*columns)
        if set(columns) <= set(t.kept("shopify_order_lines")):
            return t["shopify_order_lines"].select(*columns)
        return shopify.order_lines(t.raw("shopify", "orders"), only=columns)

    return intermediate.orders_enriched(
        orders,
        narrow(intermediate.LINE_TOTALS),
        t["shopify_order_refunds"],
        t["shopify_order_refund_lines"],
        narrow(intermediate.LINE_PRODUCTS),
    )


def _campaigns(t: Tables) -> DataFrame:
    return intermediate.campaigns_unioned(
        {
            "Meta": t["meta_campaigns"],
            "Google Ads": t["google_campaigns"],
            "TikTok": t["tiktok_campaigns"],
            "LinkedIn": t["linkedin_campaigns"],
        }
    )


def _performance(t: Tables) -> DataFrame:
    return intermediate.campaign_performance_daily(
        meta=t["meta_ad_stats_daily"],
        google=t["google_campaign_stats_daily"],
        tiktok=t["tiktok_campaign_stats_daily"],
        linkedin=t["linkedin_campaign_stats_daily"],
    )


# table -> plan over the other tables
DERIVED: dict[str, Callable[[Tables], DataFrame]] = {
    "orders_enriched": _orders,
    "customers_enriched": lambda t: intermediate.customers_enriched_in_one_scan(
        t.raw("shopify", "customers")
    ),
    "discount_codes_enriched": _codes,
    "campaigns_unioned": _campaigns,
    "campaign_performance_daily": _performance,
    "dim_campaigns": lambda t: marts.dim_campaigns(
        t["campaigns_unioned"], t["campaign_attributes"]
    ),
    "fct_campaign_performance_daily": lambda t: marts.fct_campaign_performance_daily(
        t["campaign_performance_daily"], t["dim_campaigns"]
    ),
}


# Tables that a run writes, by schema of the catalog.
WRITTEN = {
    "staging": ("shopify_order_lines",),
    "marts_marketing": ("dim_campaigns", "fct_campaign_performance_daily"),
}


class Tables(Mapping[str, DataFrame]):
    """Every table by name. A plan is made when it is first asked for.

    ``stored`` holds frames to use instead of a plan: written tables, or seeds
    kept elsewhere.
    """

    def __init__(self, raw: RawTables, stored: Mapping[str, DataFrame] | None = None):
        self.raw = raw
        self._made: dict[str, DataFrame] = dict(stored or {})
        self._stored = set(self._made)
        self._kept: dict[str, tuple[str, ...]] = {}
        self._folders: dict[str, str] = {}
        #: Failures of the row checks of written tables.
        self.row_failures: dict[str, dict[tuple[str, str], int]] = {}

    def is_stored(self, name: str) -> bool:
        return name in self._stored

    def kept(self, name: str) -> tuple[str, ...]:
        """The columns that ``keep`` left of a table, none if it wasn't called."""
        return self._kept.get(name, ())

    def keep(self, name: str, columns: Sequence[str] | None = None, made_again: Sequence[Column] = ()) -> None:
        """Make a table once, for a job whose other tables read it: its rows are written to a working
        folder, with the columns that the job needs. Plans stay as they are for a table that isn't stored.

        ``made_again`` are columns that are made from the written ones when they are read."""
        if name == "shopify_order_lines" and columns and not self.is_stored(name):
            df = shopify.order_lines(self.raw("shopify", "orders"), only=columns)
        else:
            df = self[name] if columns is None else self[name].select(*columns)
        path = f"{shared_dir(self.raw.spark)}/{name}"
        written = df.drop(*df.select(*made_again).columns) if made_again else df
        written.write.option("compression", "zstd").parquet(path)
        stored = self.raw.spark.read.schema(written.schema).parquet(path)
        self._made[name] = stored.select("*", *made_again).select(*df.columns)
        self._kept[name] = tuple(df.columns)
        self._folders[name] = path

    def drop(self, name: str) -> None:
        """Delete what ``keep`` wrote, once no table that was made from it is read any more."""
        Files(self.raw.spark).delete(self._folders.pop(name))
        del self._made[name], self._kept[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in SEED_DDL:
                self._made[name] = seed(self.raw.spark, name)
            elif name in STAGING:
                self._made[name] = staging_table(self.raw, name)
            else:
                self._made[name] = DERIVED[name](self)
        return self._made[name]

    def write(self, name: str, schema: str, suite: Checks | None = None) -> DataFrame:
        """Replace one table of the catalog; tables made from it afterwards read the written one.

        The job that writes it counts the row checks of ``suite``."""
        watch = Watch(self[name], suite or Checks())
        self._made[name] = publish(watch.rows, schema, name)
        self._stored.add(name)
        if suite is not None:
            self.row_failures[name] = watch.failures()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(dict.fromkeys([*SEED_DDL, *STAGING, *DERIVED, *self._made]))

    def __len__(self) -> int:
        return len(list(iter(self)))


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose the plans to SQL as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def ga4_batch(raw: RawTables) -> Callable[[date | None], DataFrame]:
    """Event batches; the raw day is ``YYYYMMDD`` text, which sorts like the date."""

    def batch(first_day: date | None) -> DataFrame:
        rows = raw("ga4", "events")
        if first_day is not None:
            rows = rows.where(F.col("event_date") >= day_to_text(F.lit(first_day)))
        return ga4.events(rows)

    return batch


def ad_stats_batch(raw: RawTables) -> Callable[[date | None], DataFrame]:
    def batch(first_day: date | None) -> DataFrame:
        rows = raw("facebook_marketing", "ads_insights")
        return ads.meta_ad_stats_daily(rows.where(since(F.col("date_start"), first_day)))

    return batch


def run(spark: SparkSession, settings: Settings) -> Tables:
    """Check the raw tables, load the incremental ones, record the history, write
    the marts and check all tables. A failed check stops the run (``ChecksFailed``);
    what was loaded and written stays.

    The catalog's schemas ``staging`` and ``marts_marketing`` hold what is written. A view of
    a table's plain name is replaced once the new rows are complete. Row checks of these
    tables are counted by the jobs that write them.

    Order lines are written too: two branches of the enriched orders and several
    checks read them, and parsing the JSON once is cheaper than each time.
    """
    raw = RawTables(spark, settings)
    if settings.run_checks:
        checks.check_raw(raw)

    events = DayTable(spark, settings.table_path("staging", "ga4_events"), "event_date")
    events.load(ga4_batch(raw), settings.ga4_lookback_days, settings.full_refresh)

    ad_stats = DayTable(
        spark,
        settings.table_path("staging", "meta_ad_stats_daily"),
        "date_day",
        keys=["ad_id", "date_day"],
    )
    ad_stats.load(ad_stats_batch(raw), settings.ad_stats_lookback_days, settings.full_refresh)

    history = History(
        spark, settings.table_path("snapshots", "meta_campaigns"), "id", "updated_time"
    )
    history.snapshot(raw("facebook_marketing", "campaigns"), settings.run_time)
    if history.compact():
        history.drop_superseded()

    tables = Tables(
        raw,
        {
            "ga4_events": events.read(),
            "meta_ad_stats_daily": ad_stats.read(),
            "meta_campaigns_history": history.versions(),
        },
    )
    for schema, names in WRITTEN.items():
        use_schema(spark, settings.schema_prefix + schema, settings.table_path("tables", schema))
        for name in names:
            tables.write(name, settings.schema_prefix + schema, checks.SUITE.get(name) if settings.run_checks else None)
    if settings.run_checks:
        checks.check_tables(tables, raw, settings.spend_tolerance, known=tables.row_failures)
    return tables
