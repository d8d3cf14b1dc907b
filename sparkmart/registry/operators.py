"""Registered queries of single operators, straight on the star-schema tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.incremental import since
from ..operators.latest import latest_per_key
from ..operators.enrich import left_enrich, unmatched
from ..plans import intermediate
from ..sources.starschema import star
from .present import Query, day, query, ts


def orders_enriched_lineitem(spark, sf):
    """The enriched orders over lineitem: each returned line is a refund."""
    c = F.col
    orders = star(spark, sf, "orders").select(
        c("o_orderkey").alias("order_id"),
        c("o_custkey").alias("customer_id"),
        c("o_orderdate").cast("timestamp").alias("created_at"),
        fn.money_from_double(c("o_totalprice")).alias("subtotal_price"),
        fn.money_from_double(c("o_totalprice")).alias("total_price"),
        (c("o_orderpriority") == "5-LOW").alias("is_test"),
        (c("o_orderstatus") == "P").alias("is_cancelled"),
        (c("o_orderpriority") == "4-NOT SPECIFIED").alias("is_wholesale"),
    )
    items = star(spark, sf, "lineitem")
    line_id = (c("l_orderkey") * 10 + c("l_linenumber")).alias("order_line_id")
    lines = items.select(
        c("l_orderkey").alias("order_id"),
        line_id,
        c("l_partkey").alias("product_id"),
        c("l_quantity").cast("int").alias("quantity"),
        fn.money_from_double(c("l_extendedprice")).alias("gross_amount"),
        fn.money_from_double(c("l_extendedprice") * c("l_discount")).alias("discount_amount"),
        (c("l_linestatus") == "O").alias("is_gift_card"),
    )
    returned = items.where(c("l_returnflag") == "R")
    refunds = returned.select(
        c("l_orderkey").alias("order_id"),
        c("l_shipdate").cast("timestamp").alias("refunded_at"),
        c("l_quantity").cast("int").alias("refunded_quantity"),
        fn.money_from_double(c("l_extendedprice") * (1 - c("l_discount"))).alias(
            "refunded_subtotal"
        ),
        fn.money_from_double(c("l_extendedprice") * c("l_tax")).alias("refunded_tax"),
        fn.money_from_double(c("l_extendedprice")).alias("refunded_amount"),
        F.when(c("l_tax") > 0, F.concat(F.lit("tax "), (c("l_tax") * 100).cast("int"))).alias(
            "return_reason"
        ),
    )
    refund_lines = returned.select(c("l_orderkey").alias("order_id"), line_id)
    return intermediate.orders_enriched(orders, lines, refunds, refund_lines)


ORDERS_ENRICHED_LINEITEM = f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, {ts("o_orderdate")} AS created_at,
           o_totalprice AS subtotal_price, o_totalprice AS total_price,
           o_orderpriority = '5-LOW' AS is_test, o_orderstatus = 'P' AS is_cancelled,
           o_orderpriority = '4-NOT SPECIFIED' AS is_wholesale, line_count,
           cast(units AS bigint) AS units_ordered, cast(gift AS double) AS gift_card_sales,
           coalesce(n, 0) AS refund_count, {ts("first_at")} AS first_refunded_at,
           {ts("last_at")} AS last_refunded_at,
           date_diff('day', o_orderdate, first_at) AS days_to_first_refund,
           cast(coalesce(back, 0) AS bigint) AS units_refunded,
           coalesce(line_ids, 0) AS refunded_line_count,
           coalesce(products, 0) AS refunded_product_count,
           cast(coalesce(net, 0) AS double) AS refunded_subtotal,
           cast(coalesce(tax, 0) AS double) AS refunded_tax,
           cast(coalesce(paid, 0) AS double) AS refunded_amount, return_reasons,
           cast(cast(o_totalprice AS decimal(12,2)) - coalesce(net, 0) AS double) AS net_sales,
           cast(cast(o_totalprice AS decimal(12,2)) - coalesce(paid, 0) AS double)
             AS net_total_price,
           n IS NOT NULL AS has_refund,
           coalesce(back, 0) > 0 AND back >= units AS is_fully_refunded,
           coalesce(back, 0) > 0 AND back < units AS is_partially_refunded,
           o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND o_orderstatus <> 'P'
             AS is_marketing_eligible
    FROM orders
    LEFT JOIN (SELECT l_orderkey AS k, count(*) AS line_count, sum(cast(l_quantity AS int)) AS units,
                      sum(CASE WHEN l_linestatus = 'O'
                            THEN cast(l_extendedprice AS decimal(12,2))
                                 - cast(l_extendedprice * l_discount AS decimal(12,2))
                            ELSE 0 END) AS gift
               FROM lineitem GROUP BY 1) a ON a.k = o_orderkey
    LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n, min(l_shipdate) AS first_at,
                      max(l_shipdate) AS last_at, sum(cast(l_quantity AS int)) AS back,
                      sum(cast(l_extendedprice * (1 - l_discount) AS decimal(12,2))) AS net,
                      sum(cast(l_extendedprice * l_tax AS decimal(12,2))) AS tax,
                      sum(cast(l_extendedprice AS decimal(12,2))) AS paid,
                      string_agg(DISTINCT CASE WHEN l_tax > 0
                        THEN 'tax ' || cast(trunc(l_tax * 100) AS int) END, ', '
                        ORDER BY CASE WHEN l_tax > 0
                        THEN 'tax ' || cast(trunc(l_tax * 100) AS int) END) AS return_reasons
               FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON b.k = o_orderkey
    LEFT JOIN (SELECT x.l_orderkey AS k, count(DISTINCT x.l_linenumber) AS line_ids,
                      count(DISTINCT y.l_partkey) AS products
               FROM lineitem x JOIN lineitem y
                 ON x.l_orderkey = y.l_orderkey AND x.l_linenumber = y.l_linenumber
               WHERE x.l_returnflag = 'R' GROUP BY 1) d ON d.k = o_orderkey
"""


def _ad_url() -> Column:
    """The page's URL as an ad would tag it: an id, and a value with good and broken escapes."""
    c = F.col
    tagged = F.concat(c("url"), F.when(F.contains(c("url"), F.lit("?")), "&").otherwise("?"))
    return F.concat(
        tagged, F.lit("utm_source=Face%20book+%C3%A9&ID="), c("page_id"), F.lit("&note=50%zz%20off")
    )


def url_parts(spark, sf):
    url = F.col("url")
    return star(spark, sf, "pages").withColumn("url", F.when(F.contains(url, F.lit("#")), url).otherwise(_ad_url())).select(
        "page_id",
        fn.url_param(url, "utm_source").alias("utm_source"),
        fn.url_param(url, "UTM_SOURCE").alias("utm_source_any_case"),
        fn.url_param(url, "id").alias("id_param"),
        fn.before_query(url).alias("path"),
        fn.without_query_and_fragment(url).alias("page_url"),
        fn.referrer_domain(url).alias("domain"),
        fn.percent_decode(url).alias("decoded"),
    )


def event_props(spark, sf):
    parsed = star(spark, sf, "events").withColumn(
        "p", fn.parse_object(F.col("props"), "k:string,missing:string")
    )
    return parsed.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.sum(F.col("p.k").cast("bigint")).alias("k_sum"),
        F.min(F.col("p.k").cast("decimal(12,2)")).alias("k_min"),
        F.countDistinct("p.k").alias("k_values"),
        F.countDistinct("user_id").alias("users"),
        F.count("p.missing").alias("missing_values"),
        F.sum(fn.money_from_double(F.col("value"))).alias("value_sum"),
    )


def latest_order_per_customer(spark, sf):
    latest = latest_per_key(
        star(spark, sf, "orders"),
        ["o_custkey"],
        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
    )
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")


def customers_without_orders(spark, sf, over: float = 0):
    orders = star(spark, sf, "orders").where(F.col("o_totalprice") > over)
    orders = orders.select(F.col("o_custkey").alias("c_custkey"))
    return unmatched(star(spark, sf, "customer"), orders, ["c_custkey"]).select(
        "c_custkey", "c_name"
    )


def shipping_delay(spark, sf):
    c = F.col
    orders = star(spark, sf, "orders").select(
        c("o_orderkey").alias("l_orderkey"), c("o_orderdate").cast("timestamp").alias("ordered_at")
    )
    items = star(spark, sf, "lineitem").withColumn(
        "shipped_at", c("l_shipdate").cast("timestamp") + F.expr("interval 23 hours")
    )
    joined = left_enrich(items, orders, ["l_orderkey"])
    return (
        joined.select(
            fn.midnights_between(c("ordered_at"), c("shipped_at")).alias("days"), "l_quantity"
        )
        .groupBy("days")
        .agg(F.count("*").alias("lines"), F.sum(c("l_quantity").cast("int")).alias("units"))
    )


def event_times(spark, sf):
    at = F.col("ts").cast("timestamp")
    micros = F.unix_micros(at)
    return star(spark, sf, "events").select(
        "event_id",
        fn.from_epoch_micros(micros).alias("from_micros"),
        fn.from_epoch_millis(F.floor(micros / 1000).cast("string")).alias("from_millis"),
        fn.day_to_text(at).alias("day_text"),
        fn.day_from_text(fn.day_to_text(at)).alias("day"),
        F.date_sub(fn.day_from_text(fn.day_to_text(at)), 7).alias("week_before"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").cast("date").alias("day_of_text"),
    )


def line_money(spark, sf):
    c = F.col
    eighth = c("l_extendedprice") / 8
    micros = F.round(c("l_extendedprice") * 100).cast("bigint") * 10000 + 5000
    return star(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        fn.money_from_double(eighth).alias("eighth"),
        fn.money_from_double(-eighth, 14).alias("minus_eighth"),
        fn.money_from_double(fn.from_micros(micros), 14).alias("micros"),
        fn.from_cents(c("l_quantity")).alias("cents"),
        fn.money(c("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("from_text"),
        (fn.money_from_double(c("l_extendedprice")) * c("l_quantity").cast("int")).alias("gross"),
    )


def text_parts(spark, sf):
    c = F.col
    name = c("p_name")
    tags = F.concat(F.lower(c("p_type")), F.lit(" , "), F.split_part(name, F.lit(" "), F.lit(1)))
    return star(spark, sf, "part").select(
        "p_partkey",
        fn.full_name(c("p_brand"), F.nullif(c("p_type"), F.lit("PROMO"))).alias("full_name"),
        fn.tidy(F.replace(name, F.lit("small"), F.lit(" "))).alias("tidied"),
        fn.list_part(tags, 2).alias("second_tag"),
        fn.list_part(tags, 3).alias("third_tag"),
        fn.has_tag(tags, "small").alias("is_small"),
        fn.has_tag(tags, "economy").alias("is_economy"),
        fn.urn_id(F.concat(F.lit("urn:li:part:"), c("p_partkey"))).alias("urn_id"),
        fn.id_part(F.concat_ws("_", F.lit("x"), F.lit("y"), c("p_partkey")), 3).alias("id_part"),
        fn.strip_prefix(F.concat(F.lit("Return - "), name), "Return").alias("reason"),
        fn.device_type(F.nullif(F.replace(name, F.lit("red"), F.lit("Mobile")), name)).alias(
            "device"
        ),
        fn.campaign_status(
            F.when(c("p_type") == "PROMO", "enable")
            .when(c("p_type") == "SMALL", "Deleted")
            .when(c("p_type") == "MEDIUM", "disable")
            .otherwise(c("p_type"))
        ).alias("status"),
        fn.surrogate_key(c("p_brand"), F.nullif(c("p_type"), F.lit("PROMO"))).alias("key"),
    )


def recent_events(spark, sf):
    """Rows within three days of the newest one; the bound is read once, as a literal."""
    events = star(spark, sf, "events")
    newest = events.agg(F.max("ts").cast("date")).first()[0]
    first_day = newest and newest - timedelta(days=3)
    return events.where(since(F.col("ts").cast("date"), first_day)).select(
        "event_id", "ts", "event_type", "value"
    )


QUERIES: dict[str, Query] = {
    "orders_enriched_lineitem": query(orders_enriched_lineitem, ORDERS_ENRICHED_LINEITEM),
    "url_parts": query(
        url_parts,
        """
        WITH tagged AS (
            SELECT page_id, url, contains(url, '#') AS plain, split_part(split_part(url, 'utm_source=', 2), '&', 1) AS own,
                   CASE WHEN contains(url, '?') THEN '&' ELSE '?' END AS mark
            FROM pages)
        SELECT page_id, CASE WHEN own <> '' THEN own WHEN NOT plain THEN 'Face book+é' END AS utm_source,
               CASE WHEN own <> '' THEN own WHEN NOT plain THEN 'Face book+é' END AS utm_source_any_case,
               CASE WHEN NOT plain THEN page_id::varchar END AS id_param,
               string_split(url, '?')[1] AS path,
               string_split(string_split(url, '?')[1], '#')[1] AS page_url,
               string_split(string_split(url, '://')[2], '/')[1] AS domain,
               CASE WHEN plain THEN url
                 ELSE url || mark || 'utm_source=Face book+é&ID=' || page_id || '&note=50%zz off' END AS decoded
        FROM tagged""",
    ),
    "event_props": query(
        event_props,
        """
        SELECT event_type, count(*) AS events, sum(k)::bigint AS k_sum, min(k)::double AS k_min,
               count(DISTINCT k) AS k_values, count(DISTINCT user_id) AS users,
               0::bigint AS missing_values, sum(cast(value AS decimal(12,2)))::double AS value_sum
        FROM (SELECT *, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events)
        GROUP BY 1""",
    ),
    "latest_order_per_customer": query(
        latest_order_per_customer,
        f"""
        SELECT o_custkey, max_row.o_orderkey AS o_orderkey, {ts("max_row.o_orderdate")} AS o_orderdate,
               max_row.o_orderstatus AS o_orderstatus, max_row.o_totalprice AS o_totalprice
        FROM (SELECT o_custkey, arg_max(orders, (o_orderdate, o_orderkey)) AS max_row
              FROM orders GROUP BY 1)""",
    ),
    "customers_without_orders": query(
        customers_without_orders,
        """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 0)""",
    ),
    "customers_without_large_orders": query(
        lambda spark, sf: customers_without_orders(spark, sf, over=250000),
        """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)""",
    ),
    "shipping_delay": query(
        shipping_delay,
        """
        SELECT date_diff('day', o_orderdate, l_shipdate + INTERVAL 23 HOUR) AS days,
               count(*) AS lines, sum(cast(l_quantity AS bigint))::bigint AS units
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    ),
    "event_times": query(
        event_times,
        f"""
        SELECT event_id, {ts("ts")} AS from_micros, {ts("date_trunc('millisecond', ts)")} AS from_millis,
               strftime(ts, '%Y%m%d') AS day_text, {day("ts")} AS day,
               {day("cast(ts AS date) - 7")} AS week_before, {day("ts")} AS day_of_text
        FROM events""",
    ),
    "line_money": query(
        line_money,
        """
        SELECT l_orderkey, l_partkey, cast(l_linenumber AS bigint) AS l_linenumber,
               cast(cast(l_extendedprice / 8 AS decimal(12,2)) AS double) AS eighth,
               cast(cast(-(l_extendedprice / 8) AS decimal(14,2)) AS double) AS minus_eighth,
               cast(cast((cast(round(l_extendedprice * 100) AS bigint) * 10000 + 5000) / 1000000.0
                 AS decimal(14,2)) AS double) AS micros,
               l_quantity / 100.0 AS cents,
               cast(cast(l_extendedprice AS decimal(12,2)) AS double) AS from_text,
               cast(cast(l_extendedprice AS decimal(12,2)) * cast(l_quantity AS int) AS double)
                 AS gross
        FROM lineitem""",
    ),
    "text_parts": query(
        text_parts,
        """
        SELECT p_partkey, p_brand || CASE WHEN p_type <> 'PROMO' THEN ' ' || p_type ELSE '' END
                 AS full_name,
               nullif(trim(replace(p_name, 'small', ' ')), '') AS tidied,
               split_part(p_name, ' ', 1) AS second_tag, cast(NULL AS varchar) AS third_tag,
               p_type = 'SMALL' OR starts_with(p_name, 'small ') AS is_small,
               p_type = 'ECONOMY' AS is_economy, p_partkey AS urn_id, p_partkey AS id_part,
               p_name AS reason,
               CASE WHEN contains(p_name, 'red') THEN 'mobile' END AS device,
               CASE p_type WHEN 'PROMO' THEN 'active' WHEN 'SMALL' THEN 'removed'
                 WHEN 'MEDIUM' THEN 'paused' ELSE 'other' END AS status,
               md5(p_brand || '-' || CASE WHEN p_type = 'PROMO'
                 THEN '_dbt_utils_surrogate_key_null_' ELSE p_type END) AS key
        FROM part""",
    ),
    "recent_events": query(
        recent_events,
        f"""
        SELECT event_id, {ts("ts")} AS ts, event_type, value FROM events
        WHERE cast(ts AS date) >= (SELECT cast(max(ts) AS date) - 3 FROM events)""",
    ),
}
