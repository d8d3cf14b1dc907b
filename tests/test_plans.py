"""Table plans on literal edge rows, and the whole job end to end."""

import json
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from sparkmart.config import Settings, shared_dir
from sparkmart.operators.quality import Checks
from sparkmart.operators.scd2 import as_of
from sparkmart.plans import checks, ga4, intermediate, pipeline, shopify
from sparkmart.registry import QUERIES
from sparkmart.registry.present import present
from sparkmart.sources.scan import RawTables, scan, seed, seed_csv, SEED_DIR
from sparkmart.sources.schemas import RAW_DDL, raw_schema
from sparkmart.sources.starschema import PROJECTIONS, raw_tables

T = datetime(2026, 1, 1, 22, 0)


def raw_frame(spark, system, table, rows):
    schema = raw_schema(system, table)
    return spark.createDataFrame([[r.get(f.name) for f in schema] for r in rows], schema)


def line(n, **extra):
    return {"id": n, "product_id": 100 + n, "quantity": 2, "price": "10.00"} | extra


ORDERS = [
    {"id": 1, "created_at": T, "line_items": "[]"},
    {"id": 2, "created_at": T, "line_items": json.dumps([line(21), line(22, gift_card=True,
     discount_allocations=[{"amount": "1.5"}, {"amount": None}])])},
    {"id": 3, "created_at": T, "line_items": json.dumps([line(31)])},
    {"id": 4, "created_at": T, "line_items": json.dumps([line(41)]), "tags": "test"},
    {"id": 5, "created_at": T, "line_items": None},
    {"id": 6, "created_at": T, "line_items": json.dumps([line(61)]), "cancelled_at": T},
]


def refund(rid, order, lines, note=None, hour=23):
    return {
        "id": rid,
        "order_id": order,
        "created_at": datetime(2026, 1, 2, 0, 30) if hour == 0 else datetime(2026, 1, 1, hour),
        "note": note,
        "refund_line_items": json.dumps(
            [{"id": rid * 10 + i, "line_item_id": l, "quantity": q, "subtotal": "5.00"}
             for i, (l, q) in enumerate(lines)]),
        "transactions": json.dumps([{"kind": "refund", "status": "success", "amount": "5.00"}]),
    }


REFUNDS = [
    refund(1, 2, [(21, 1)], "Return - Too big", hour=0),
    refund(2, 2, [(21, 1)], "Return - Torn"),
    refund(3, 2, [(22, 1)], "Return - Too big"),
    refund(4, 3, [(31, 2)]),
    refund(5, 4, [(41, 5), (None, 1)], "Damaged"),
    refund(6, 5, [(99, 1)]),
]


@pytest.fixture(scope="module")
def enriched(spark):
    orders = raw_frame(spark, "shopify", "orders",
                       [o | {"subtotal_price": "20.00", "total_price": "22.00"} for o in ORDERS])
    refunds = raw_frame(spark, "shopify", "order_refunds", REFUNDS)
    raw = RawTables(spark, frames={("shopify", "orders"): orders,
                                   ("shopify", "order_refunds"): refunds})
    rows = pipeline.Tables(raw)["orders_enriched"].collect()
    return {r.order_id: r for r in rows}


def test_order_without_lines_keeps_nulls(enriched):
    o = enriched[1]
    assert (o.line_count, o.units_ordered, o.gift_card_sales) == (None, None, None)
    assert (o.refund_count, o.has_refund, o.is_fully_refunded) == (0, False, False)
    assert o.net_sales == Decimal("20.00") and o.days_to_first_refund is None
    refunded = enriched[5]  # refunded, but nothing to compare the units with
    assert refunded.is_fully_refunded is None and refunded.is_partially_refunded is None
    assert refunded.refunded_line_count == 1 and refunded.refunded_product_count == 0


def test_partial_refunds_of_one_order(enriched):
    o = enriched[2]
    assert (o.line_count, o.units_ordered, o.units_refunded) == (2, 4, 3)
    assert o.gift_card_sales == Decimal("18.50")
    assert (o.refund_count, o.refunded_line_count, o.refunded_product_count) == (3, 2, 2)
    assert o.return_reasons == "Too big, Torn"
    assert (o.is_fully_refunded, o.is_partially_refunded) == (False, True)
    assert (o.net_sales, o.net_total_price) == (Decimal("5.00"), Decimal("7.00"))
    assert o.days_to_first_refund == 0
    assert o.first_refunded_at == datetime(2026, 1, 1, 23)


def test_full_and_over_refunds(enriched):
    assert enriched[3].is_fully_refunded and enriched[3].return_reasons is None
    assert enriched[4].is_fully_refunded and enriched[4].refunded_line_count == 1


def test_marketing_eligibility(enriched):
    assert {k: r.is_marketing_eligible for k, r in enriched.items()} == {
        1: True, 2: True, 3: True, 4: False, 5: True, 6: False,
    }


def test_hot_keys_do_not_change_results(spark):
    """A third of all refunds on one order, one code on a third of the orders."""
    orders = spark.range(300).select(
        F.col("id").alias("order_id"),
        F.lit(T).cast("timestamp").alias("created_at"),
        F.lit(10).cast("decimal(12,2)").alias("subtotal_price"),
        F.lit(10).cast("decimal(12,2)").alias("total_price"),
        F.lit(1).cast("decimal(12,2)").alias("total_discounts"),
        F.when(F.col("id") < 100, "HOT").otherwise(F.concat(F.lit("C"), "id")).alias("discount_code"),
        *[F.lit(False).alias(c) for c in ("is_test", "is_cancelled", "is_wholesale")],
    )
    lines = spark.range(900).select(
        F.when(F.col("id") < 300, 7).otherwise(F.col("id") % 300).alias("order_id"),
        F.col("id").alias("order_line_id"), (F.col("id") % 5).alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(2).cast("decimal(12,2)").alias("gross_amount"),
        F.lit(0).cast("decimal(38,2)").alias("discount_amount"), F.lit(True).alias("is_gift_card"),
    )
    refunds = lines.select(
        "order_id", F.lit(T).cast("timestamp").alias("refunded_at"),
        F.lit(1).alias("refunded_quantity"), F.lit("r").alias("return_reason"),
        *[F.lit(1).cast("decimal(38,2)").alias(f"refunded_{c}") for c in ("subtotal", "tax", "amount")],
    )
    got = intermediate.orders_enriched(orders, lines, refunds, lines.select("order_id", "order_line_id"))
    hot = got.where("order_id = 7").first()
    assert (hot.line_count, hot.refund_count, hot.refunded_line_count) == (302, 302, 302)
    assert hot.refunded_product_count == 5
    assert got.agg(F.sum("line_count")).first()[0] == 900
    again = intermediate.orders_enriched(
        orders.repartition(7), lines.repartition(3, "product_id"), refunds.orderBy(F.rand(1)),
        lines.select("order_id", "order_line_id"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_shuffle_partitions_do_not_change_results(spark, sf_dir):
    run = QUERIES["discount_codes_enriched"].run
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = sorted(map(tuple, run(spark, sf_dir).collect()), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = sorted(map(tuple, run(spark, sf_dir).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == many


def test_customers_in_one_scan_do_not_shuffle(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    df = pipeline.Tables(raw)["customers_enriched"]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_json_null_documents(spark):
    customers = raw_frame(spark, "shopify", "customers", [
        {"id": 1, "addresses": "null", "default_address": "null", "email_marketing_consent": "null"},
        {"id": 2},
    ])
    assert [r.address_id for r in shopify.customer_addresses(customers).collect()] == [None]
    assert [r.customer_id for r in shopify.customer_default_addresses(customers).collect()] == [1]
    consent = shopify.customer_email_consents(customers).first()
    assert (consent.customer_id, consent.is_subscribed) == (1, None)
    raw = RawTables(spark, frames={("shopify", "customers"): customers})
    one_scan = pipeline.Tables(raw)["customers_enriched"]
    joined = intermediate.customers_enriched(
        shopify.customers(customers),
        shopify.customer_default_addresses(customers),
        shopify.customer_email_consents(customers),
        shopify.customer_addresses(customers),
    )
    assert sorted(map(tuple, one_scan.collect()), key=str) == sorted(
        map(tuple, joined.collect()), key=str
    )


def test_price_rule_end_must_stay_empty(spark):
    rules = raw_frame(spark, "shopify", "price_rules", [{"id": 1, "value": "-30.0", "ends_at": 5}])
    with pytest.raises(Exception, match="price rule end is not empty"):
        shopify.price_rules(rules).collect()


def test_campaign_missing_from_the_seed(spark, sf_dir):
    dim = pipeline.Tables(raw_tables(spark, sf_dir))["dim_campaigns"]
    flags = {r.is_always_on for r in dim.select("is_always_on").distinct().collect()}
    assert flags == {True, None}


def test_spend_check_finds_a_planted_gap(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    fact = spark.createDataFrame([("Meta", 1.0)], "platform string, spend double")
    platforms = {r.platform for r in checks.unreconciled_spend(fact, raw).collect()}
    assert platforms == {"Meta", "Google Ads", "TikTok", "LinkedIn"}
    assert checks.unreconciled_spend(fact, raw, tolerance=1e15).count() == 0


def test_every_declared_raw_table_has_a_projection():
    assert set(PROJECTIONS) == {(s, t) for s, tables in RAW_DDL.items() for t in tables}


def test_seeds(spark):
    for name, rows in (("channel_mapping", 12), ("campaign_attributes", 34), ("discount_code_types", 14)):
        packaged = seed(spark, name)
        from_file = seed_csv(spark, f"file://{SEED_DIR}/{name}.csv", name)
        assert packaged.dtypes == from_file.dtypes
        assert sorted(map(tuple, packaged.collect())) == sorted(map(tuple, from_file.collect()))
        assert packaged.count() == rows
    joined = spark.range(5).select(F.concat(F.lit("f"), "id").alias("utm_source")).join(
        seed(spark, "channel_mapping"), "utm_source", "left")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_shared_dir_is_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark), shared_dir(spark)
    assert first.startswith(f"{root}/sparkmart-") and first != second


def test_working_folders_are_shared(spark, monkeypatch):
    top = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(f"{top}/sparkmart-")
    assert shared_dir(spark) != shared_dir(spark)

    class Unset:
        sparkContext = spark.sparkContext

        class conf:
            get = staticmethod(lambda key, default=None: "hdfs://x/warehouse/" if "warehouse" in key else default)

    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: Unset.conf)
    assert shared_dir(Unset).startswith("hdfs://x/warehouse/_work/sparkmart-")


@pytest.fixture(scope="module")
def raw_files(spark, sf_dir, tmp_path_factory):
    """The raw tables as parquet folders, one of them under another schema name."""
    root = tmp_path_factory.mktemp("raw")
    raw = raw_tables(spark, sf_dir)
    for system, table in PROJECTIONS:
        schema = "sandbox_tiktok" if system == "tiktok_marketing" else system
        df = raw(system, table)
        if table == "ads_insights":  # a connector without zones, and without one column
            df = df.withColumn("_airbyte_extracted_at", F.col("_airbyte_extracted_at").cast("timestamp_ntz"))
            df = df.drop("reach")
        df.write.parquet(f"file://{root}/{schema}/{table}")
    return root


def test_scan_reads_declared_columns_and_pushes_filters(spark, raw_files):
    settings = Settings(f"file://{raw_files}", "unused")
    df = scan(spark, settings, "facebook_marketing", "ads_insights")
    assert dict(df.dtypes)["_airbyte_extracted_at"] == "timestamp"
    assert df.where("reach is not null").count() == 0 and df.count() > 0
    narrow = df.where(F.col("date_start") >= F.lit("2024-01-20")).select("ad_id")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date_start), GreaterThanOrEqual(date_start" in plan
    assert "ReadSchema: struct<ad_id:string,date_start:date>" in plan
    batch = pipeline.ga4_batch(RawTables(spark, settings))(date(2024, 1, 20)).select("event_id")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_date,20240120)" in plan
    schema = plan.split("ReadSchema:")[1]
    assert "string_value" in schema and "double_value" not in schema and "items" not in schema
    with pytest.raises(ValueError, match="unknown source system"):
        settings.source_path("nowhere", "t")


def test_the_whole_job_twice(spark, sf_dir, raw_files, tmp_path):
    def settings(run_time, **kw):
        return Settings(
            f"file://{raw_files}", f"file://{tmp_path}", {"tiktok_marketing": "sandbox_tiktok"},
            run_time=run_time, run_checks=False, schema_prefix="twice_", **kw,
        )

    pipeline.run(spark, settings(datetime(2024, 6, 1)))
    tables = pipeline.run(spark, settings(datetime(2024, 6, 2)))
    con = connect(sf_dir)
    for name in ("ga4_events", "shopify_order_lines", "orders_enriched", "dim_campaigns",
                 "fct_campaign_performance_daily", "discount_codes_enriched"):
        assert differences(present(tables[name]), con, QUERIES[name].sql) is None, name
    history = tables["meta_campaigns_history"]
    assert history.count() == tables["meta_campaigns"].count()
    assert as_of(history, datetime(2024, 5, 1)).count() == 0
    pipeline.register_views({"fct": tables["fct_campaign_performance_daily"]})
    assert spark.sql("SELECT count(DISTINCT platform) FROM fct").first()[0] == 4
    published = spark.newSession().table("twice_marts_marketing.fct_campaign_performance_daily")
    assert differences(present(published), con, QUERIES["fct_campaign_performance_daily"].sql) is None
    refreshed = pipeline.run(spark, settings(datetime(2024, 6, 3), full_refresh=True))
    assert differences(present(refreshed["ga4_events"]), con, QUERIES["ga4_events"].sql) is None


def test_the_job_stops_on_failed_checks(spark, raw_files, tmp_path, monkeypatch):
    overrides = {"tiktok_marketing": "sandbox_tiktok"}
    settings = Settings(f"file://{raw_files}", f"file://{tmp_path}", overrides, schema_prefix="stops_")
    monkeypatch.setattr(checks, "RAW_SUITE", {"shopify.orders": Checks(unique=["id"], not_null=["closed_at"])})
    with pytest.raises(checks.ChecksFailed, match="shopify.orders: not_null of closed_at failed"):
        pipeline.run(spark, settings)
    assert not list(tmp_path.iterdir())  # nothing was loaded
    monkeypatch.setattr(checks, "RAW_SUITE", {"shopify.orders": Checks(unique=["id"])})
    monkeypatch.setattr(checks, "SUITE", {"dim_campaigns": Checks(minimum={"campaign_key": "z"}, unique=["campaign_key"])})
    with pytest.raises(checks.ChecksFailed) as stopped:
        pipeline.run(spark, settings)
    found = {(t, check) for t, check, _, _ in stopped.value.failures}
    assert ("dim_campaigns", "accepted_range") in found and ("channel_mapping", "all_utm_pairs_mapped") in found
    assert ("dim_campaigns", "unique") not in found


def test_line_totals_inside_the_row_equal_those_of_the_line_table(spark):
    raw = raw_frame(spark, "shopify", "orders", ORDERS)
    inside = shopify.orders(raw, line_totals=True).select("order_id", *intermediate.TOTALS)
    lines = intermediate._line_totals(shopify.order_lines(raw))
    joined = raw.select(F.col("id").alias("order_id")).join(lines, "order_id", "left")
    assert sorted(map(tuple, inside.collect()), key=str) == sorted(map(tuple, joined.collect()), key=str)
    assert inside.schema.simpleString() == joined.select("order_id", *intermediate.TOTALS).schema.simpleString()


def test_enriched_orders_join_refunds_and_products_only(spark):
    frames = {("shopify", "orders"): raw_frame(spark, "shopify", "orders", ORDERS),
              ("shopify", "order_refunds"): raw_frame(spark, "shopify", "order_refunds", REFUNDS)}
    t = pipeline.Tables(RawTables(spark, frames=frames))
    optimised = t["orders_enriched"]._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("Join LeftOuter") == 3  # refunds, refunded lines, their products


def test_enriched_orders_have_no_expand(spark, sf_dir):
    plan = QUERIES["orders_enriched_lineitem"].run(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Expand" not in plan and "RoundRobin" not in plan


def test_order_lines_parse_only_wanted_fields(spark):
    raw = raw_frame(spark, "shopify", "orders", ORDERS)
    full = shopify.order_lines(raw)
    for columns in (intermediate.LINE_TOTALS, intermediate.LINE_PRODUCTS, ["vendor", "tax_amount"]):
        narrow = shopify.order_lines(raw, only=columns)
        assert sorted(map(tuple, narrow.collect()), key=str) == sorted(
            map(tuple, full.select(*columns).collect()), key=str
        )
    plan = shopify.order_lines(raw, only=["order_line_id"])._jdf.queryExecution().toString()
    assert "tax_lines" not in plan.split("Optimized Logical Plan")[1]


def test_table_report_makes_shared_tables_once(spark, sf_dir):
    from sparkmart.registry import quality

    plan = quality.table_report(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # the latest rows of Google campaigns are ranked, and lines parsed, before the report
    assert "row_number" not in plan and "gift_card" not in plan


def test_table_report_leaves_nothing_on_disk(spark, sf_dir):
    from sparkmart.registry import quality

    left = lambda: {str(p) for p in Path(spark.conf.get("spark.checkpoint.dir")).glob("sparkmart-*/*")}
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    cleanup = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    folders, before = left(), shuffles.size()
    found = quality.table_report(spark, sf_dir).collect()
    assert len(found) == sum(map(len, checks.SUITE.values())) == len({r[:3] for r in found})
    assert left() <= folders and shuffles.size() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == cleanup


def test_a_dropped_table_is_a_plan_again(spark, sf_dir):
    tables = pipeline.Tables(raw_tables(spark, sf_dir))
    want = sorted(map(str, tables["meta_campaigns"].select("campaign_id").collect()))
    tables.keep("meta_campaigns", ["campaign_id"])
    (folder,) = {str(Path(f).parent) for f in tables["meta_campaigns"].inputFiles()}
    tables.drop("meta_campaigns")
    assert not Path(folder.removeprefix("file:")).exists() and tables.kept("meta_campaigns") == ()
    assert sorted(map(str, tables["meta_campaigns"].select("campaign_id").collect())) == want


def test_kept_rows_make_a_key_again(spark, sf_dir):
    tables = pipeline.Tables(raw_tables(spark, sf_dir))
    name = "campaign_performance_daily"
    plain = tables[name]
    want = sorted(map(str, plain.collect()))
    tables.keep(name, made_again=[intermediate.campaign_key()])
    assert "campaign_key" not in spark.read.parquet(str(Path(tables[name].inputFiles()[0]).parent)).columns
    assert tables[name].schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, tables[name].collect())) == want


def test_kept_lines_leave_the_totals_in_the_order(spark, sf_dir):
    tables = pipeline.Tables(raw_tables(spark, sf_dir))
    want = tables["orders_enriched"]
    kept = pipeline.Tables(raw_tables(spark, sf_dir, spread=True))
    assert kept.kept("shopify_order_lines") == ()
    kept.keep("shopify_order_lines", ["order_line_id", "order_id", "product_id"])
    kept.keep("orders_enriched")
    got = kept["orders_enriched"]
    assert not kept.is_stored("shopify_order_lines")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_are_dealt_before_the_work(spark, sf_dir):
    plain, dealt = (raw_tables(spark, sf_dir, **a)("ga4", "events").select("event_timestamp", "user_id") for a in ({}, {"spread": True}))
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project") < plan.index("RepartitionByExpression") and "Repartition" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_a_single_row_group_are_dealt_over_all_tasks(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "if(id % 10 = 0, null, id div 2) as c_custkey",  # null and repeated keys
        "concat('Customer#', id) as c_name",
        "cast(id % 25 as int) as c_nationkey",
        "id - 100.5D as c_acctbal",
        "if(id % 3 = 0, 'MACHINERY', null) as c_mktsegment",
    )
    tasks = spark.sparkContext.defaultParallelism

    def raw(folder, **how):
        return raw_tables(spark, str(tmp_path / folder), **how)("linkedin_ads", "campaigns")

    rows.coalesce(1).write.parquet(str(tmp_path / "one" / "customer.parquet"))
    dealt = raw("one", spread=True)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert dealt.rdd.getNumPartitions() == tasks and max(sizes) < 4000 / tasks * 2
    # nor do adaptive plans merge them again where the rows are part of a union
    assert dealt.select("id").unionAll(raw("one", spread=True).select("id")).rdd.getNumPartitions() == 2 * tasks
    assert sorted(map(str, dealt.collect())) == sorted(map(str, raw("one").collect()))
    # files that occupy all tasks already are read as they are
    rows.repartition(tasks).write.parquet(str(tmp_path / "many" / "customer.parquet"))
    assert "Exchange" not in raw("many", spread=True)._jdf.queryExecution().executedPlan().toString()
    # and a table without rows is no error
    rows.limit(0).write.parquet(str(tmp_path / "none" / "customer.parquet"))
    assert raw("none", spread=True).count() == 0



def test_click_ids_of_a_page_take_one_split(spark, sf_dir):
    df = pipeline.Tables(raw_tables(spark, sf_dir))["ga4_events"].select(*ga4.CLICK_IDS)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(" not in plan and "regexp_extract_all(" in plan
