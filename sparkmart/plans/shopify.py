"""Staging plans for the store: typed columns, one JSON parse per column.

Every function maps one raw table to one staging table row by row (or by
exploding an array inside the row), so none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn

MONEY_SUM = "decimal(38,2)"

# URL parameters kept from the landing page, by output column.
LANDING_PARAMS = {
    "utm_source": "utm_source",
    "utm_medium": "utm_medium",
    "utm_campaign": "utm_campaign",
    "utm_id": "utm_id",
    "utm_content": "utm_content",
    "utm_term": "utm_term",
    "gclid": "gclid",
    "gbraid": "gbraid",
    "fbclid": "fbclid",
    "ttclid": "ttclid",
    "li_fat_id": "li_fat_id",
    "klaviyo_kx": "_kx",
    "srsltid": "srsltid",
}
LOWERED = ("utm_source", "utm_medium")

# Fields of one order line in the JSON.
_LINE = {
    "id": "string",
    "product_id": "string",
    "variant_id": "string",
    "sku": "string",
    "title": "string",
    "variant_title": "string",
    "vendor": "string",
    "quantity": "string",
    "price": "string",
    "gift_card": "string",
    "requires_shipping": "string",
    "fulfillment_status": "string",
    "discount_allocations": "array<struct<amount:string>>",
    "tax_lines": "array<struct<price:string>>",
}
# Output columns that read other fields than the one of their own name.
_LINE_READS = {
    "order_line_id": ("id",),
    "product_title": ("title",),
    "unit_price": ("price",),
    "gross_amount": ("price", "quantity"),
    "discount_amount": ("discount_allocations",),
    "tax_amount": ("tax_lines",),
    "is_gift_card": ("gift_card",),
}
_REFUND_LINE = (
    "id:string,line_item_id:string,quantity:string,subtotal:string,total_tax:string,"
    "restock_type:string,location_id:string"
)
_TRANSACTION = "kind:string,status:string,amount:string,gateway:string"
_ADDRESS = (
    "id:string,address1:string,city:string,province:string,province_code:string,"
    "country:string,country_code:string,zip:string,default:string"
)
_VISIT = (
    "struct<occurredAt:string,source:string,sourceType:string,landingPage:string,"
    "referrerUrl:string,utmParameters:struct<source:string,medium:string,campaign:string,"
    "content:string,term:string>>"
)
_ADDRESS_TEXT = (
    "address1",
    "city",
    "province",
    "province_code",
    "country",
    "country_code",
    "zip",
)


def _landing_params(url: Column) -> list[Column]:
    values = fn.url_params(url, LANDING_PARAMS)
    return [(F.lower(v) if name in LOWERED else v).alias(name) for name, v in values.items()]


def orders(raw: DataFrame, line_totals: bool = False) -> DataFrame:
    """One row per order. ``line_totals`` adds the totals of the order's own lines."""
    c = F.col
    parsed = raw.withColumns(
        {
            "_customer": fn.parse_object(c("customer"), "id:string"),
            "_shipping_set": fn.parse_object(
                c("total_shipping_price_set"), "shop_money:struct<amount:string>"
            ),
            "_code": fn.first(fn.parse_objects(c("discount_codes"), "code:string")),
            "_discount": fn.first(fn.parse_objects(c("discount_applications"), "type:string")),
            "_client": fn.parse_object(c("client_details"), "user_agent:string"),
            "_gateway": fn.first(fn.parse_array(c("payment_gateway_names"), "string")),
            "_shipping": fn.first(fn.parse_objects(c("shipping_lines"), "code:string")),
            "_address": fn.parse_object(
                c("shipping_address"),
                "city:string,province_code:string,country_code:string,zip:string",
            ),
        }
    )
    if line_totals:
        fields = ("quantity", "price", "gift_card", "discount_allocations")
        ddl = ",".join(f"{name}:{_LINE[name]}" for name in fields)
        parsed = parsed.withColumn("_lines", fn.parse_objects(c("line_items"), ddl))
    tagged_test = fn.has_tag(c("tags"), "test")
    return parsed.select(
        c("id").alias("order_id"),
        c("name").alias("order_name"),
        "order_number",
        c("_customer.id").cast("bigint").alias("customer_id"),
        "checkout_id",
        "created_at",
        "processed_at",
        "updated_at",
        "closed_at",
        "cancelled_at",
        "financial_status",
        "fulfillment_status",
        "cancel_reason",
        "tags",
        (F.coalesce(c("test"), F.lit(False)) | tagged_test).alias("is_test"),
        fn.has_tag(c("tags"), "wholesale-team-order").alias("is_wholesale"),
        c("cancelled_at").isNotNull().alias("is_cancelled"),
        fn.money(c("total_line_items_price")).alias("gross_sales"),
        fn.money(c("total_discounts")).alias("total_discounts"),
        fn.money(c("subtotal_price")).alias("subtotal_price"),
        fn.money(c("_shipping_set.shop_money.amount")).alias("shipping_price"),
        *[
            fn.money(c(name)).alias(name)
            for name in (
                "total_tax",
                "total_price",
                "current_subtotal_price",
                "current_total_discounts",
                "current_total_tax",
                "current_total_price",
                "total_outstanding",
            )
        ],
        "currency",
        c("_code.code").alias("discount_code"),
        c("_discount.type").alias("discount_type"),
        "landing_site",
        fn.before_query(c("landing_site")).alias("landing_path"),
        *_landing_params(c("landing_site")),
        "referring_site",
        fn.referrer_domain(c("referring_site")).alias("referrer_domain"),
        fn.device_type(c("_client.user_agent")).alias("device_type"),
        "buyer_accepts_marketing",
        "customer_locale",
        c("_gateway").alias("payment_gateway"),
        c("_shipping.code").alias("shipping_method"),
        *[
            c(f"_address.{part}").alias(f"shipping_{part}")
            for part in ("city", "province_code", "country_code", "zip")
        ],
        c("total_weight").alias("total_weight_grams"),
        "shop_url",
        "_airbyte_extracted_at",
        *(_line_totals(c("_lines")) if line_totals else ()),
    )


def _line_totals(lines: Column) -> list[Column]:
    """Over the lines inside the raw order: no second scan, no shuffle and no join."""

    def quantity(line: Column) -> Column:
        return fn.whole(line["quantity"], "int")

    def gift_card_amount(line: Column) -> Column:
        discount = fn.sum_items(
            line["discount_allocations"], lambda x: fn.money(x["amount"]), MONEY_SUM
        )
        paid = fn.money(line["price"]) * quantity(line) - discount
        return F.when(line["gift_card"].cast("boolean"), paid).otherwise(0).cast(MONEY_SUM)

    return [
        F.when(F.size(lines) > 0, F.size(lines).cast("bigint")).alias("line_count"),
        fn.sum_or_null(lines, quantity, "bigint").alias("units_ordered"),
        fn.sum_or_null(lines, gift_card_amount, MONEY_SUM).alias("gift_card_sales"),
    ]


def _line_columns() -> dict[str, Callable[[], Column]]:
    def text(field: str) -> Column:
        return F.col(f"line.{field}")

    def amounts(field: str, key: str) -> Column:
        return fn.sum_items(text(field), lambda x: fn.money(x[key]), "decimal(38,2)")

    return {
        "order_line_id": lambda: fn.whole(text("id"), "bigint"),
        "order_id": lambda: F.col("order_id"),
        "product_id": lambda: fn.whole(text("product_id"), "bigint"),
        "variant_id": lambda: fn.whole(text("variant_id"), "bigint"),
        "sku": lambda: text("sku"),
        "product_title": lambda: text("title"),
        "variant_title": lambda: text("variant_title"),
        "vendor": lambda: text("vendor"),
        "quantity": lambda: fn.whole(text("quantity"), "int"),
        "unit_price": lambda: fn.money(text("price")),
        "gross_amount": lambda: fn.money(text("price")) * fn.whole(text("quantity"), "int"),
        "discount_amount": lambda: amounts("discount_allocations", "amount"),
        "tax_amount": lambda: amounts("tax_lines", "price"),
        "is_gift_card": lambda: text("gift_card").cast("boolean"),
        "requires_shipping": lambda: text("requires_shipping").cast("boolean"),
        "fulfillment_status": lambda: text("fulfillment_status"),
        "order_created_at": lambda: F.col("order_created_at"),
    }


def order_lines(raw_orders: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """One row per order line, from the array inside the order.

    ``only`` names the wanted columns. Column pruning stops at the JSON text, so
    the parse is narrowed here: fields nobody reads are skipped by the parser.
    """
    columns = _line_columns()
    wanted = list(only or columns)
    fields = {f for name in wanted for f in _LINE_READS.get(name, (name,))}
    ddl = ",".join(f"{name}:{kind}" for name, kind in _LINE.items() if name in fields)
    ddl = ddl or "id:string"
    lines = raw_orders.select(
        F.col("id").alias("order_id"),
        F.col("created_at").alias("order_created_at"),
        F.explode(fn.parse_objects(F.col("line_items"), ddl)).alias("line"),
    )
    return lines.select(*[columns[name]().alias(name) for name in wanted])


def order_refunds(raw: DataFrame) -> DataFrame:
    """One row per refund; amounts are summed from its lines and transactions."""
    parsed = raw.withColumns(
        {
            "_lines": fn.parse_objects(
                F.col("refund_line_items"), "quantity:string,subtotal:string,total_tax:string"
            ),
            "_payments": fn.parse_objects(F.col("transactions"), _TRANSACTION),
        }
    )
    c = F.col
    return parsed.select(
        c("id").alias("refund_id"),
        "order_id",
        c("created_at").alias("refunded_at"),
        "processed_at",
        c("note").alias("refund_note"),
        fn.tidy(fn.strip_prefix(c("note"), "Return")).alias("return_reason"),
        c("restock").alias("is_restocked"),
        fn.sum_items(c("_lines"), lambda x: fn.whole(x["quantity"], "int"), "bigint").alias(
            "refunded_quantity"
        ),
        fn.sum_items(c("_lines"), lambda x: fn.money(x["subtotal"]), "decimal(38,2)").alias(
            "refunded_subtotal"
        ),
        fn.sum_items(c("_lines"), lambda x: fn.money(x["total_tax"]), "decimal(38,2)").alias(
            "refunded_tax"
        ),
        fn.sum_items(
            c("_payments"),
            lambda x: fn.money(x["amount"]),
            "decimal(38,2)",
            where=lambda x: (x["kind"] == "refund") & (x["status"] == "success"),
        ).alias("refunded_amount"),
        fn.first(c("_payments"))["gateway"].alias("refund_gateway"),
        "shop_url",
        "_airbyte_extracted_at",
    )


def order_refund_lines(raw_refunds: DataFrame) -> DataFrame:
    """One row per refunded order line."""
    c = F.col
    return raw_refunds.select(
        c("id").alias("refund_id"),
        "order_id",
        c("created_at").alias("refunded_at"),
        F.explode(fn.parse_objects(c("refund_line_items"), _REFUND_LINE)).alias("line"),
    ).select(
        fn.whole(c("line.id"), "bigint").alias("refund_line_id"),
        "refund_id",
        "order_id",
        fn.whole(c("line.line_item_id"), "bigint").alias("order_line_id"),
        fn.whole(c("line.quantity"), "int").alias("quantity"),
        fn.money(c("line.subtotal")).alias("subtotal_amount"),
        fn.money(c("line.total_tax")).alias("tax_amount"),
        c("line.restock_type").alias("restock_type"),
        fn.whole(c("line.location_id"), "bigint").alias("location_id"),
        "refunded_at",
    )


def customer_columns() -> list[Column]:
    """The customer's own attributes, over the raw row."""
    c = F.col
    return [
        c("id").alias("customer_id"),
        c("email"),
        c("first_name"),
        c("last_name"),
        fn.full_name(c("first_name"), c("last_name")).alias("full_name"),
        c("accepts_marketing"),
        c("accepts_marketing_updated_at"),
        c("marketing_opt_in_level"),
        c("verified_email"),
        c("tax_exempt"),
        c("state").alias("customer_state"),
        c("tags"),
        c("currency"),
        c("orders_count"),
        fn.money(c("total_spent")).alias("total_spent"),
        c("last_order_id"),
        c("last_order_name"),
        c("created_at"),
        c("updated_at"),
        c("shop_url"),
        c("_airbyte_extracted_at"),
    ]


def customers(raw: DataFrame) -> DataFrame:
    """One row per customer."""
    return raw.select(*customer_columns())


def _address(address: str) -> list[Column]:
    return [
        F.col(f"{address}.id").cast("bigint").alias("address_id"),
        *[F.col(f"{address}.{part}").alias(part) for part in _ADDRESS_TEXT],
    ]


def customer_addresses(raw_customers: DataFrame) -> DataFrame:
    """One row per address of a customer."""
    return raw_customers.select(
        F.col("id").alias("customer_id"),
        F.explode(fn.parse_objects(F.col("addresses"), _ADDRESS)).alias("address"),
        "_airbyte_extracted_at",
    ).select(
        "customer_id",
        *_address("address"),
        F.col("address.default").cast("boolean").alias("is_default"),
        "_airbyte_extracted_at",
    )


def customer_default_addresses(raw_customers: DataFrame) -> DataFrame:
    """One row per customer that has a default address."""
    return (
        raw_customers.where(F.col("default_address").isNotNull())
        .withColumn("address", fn.parse_object(F.col("default_address"), _ADDRESS))
        .select(
            F.col("id").alias("customer_id"), *_address("address"), "_airbyte_extracted_at"
        )
    )


def customer_email_consents(raw_customers: DataFrame) -> DataFrame:
    """One row per customer with an email consent record."""
    return (
        raw_customers.where(F.col("email_marketing_consent").isNotNull())
        .withColumn(
            "consent",
            fn.parse_object(
                F.col("email_marketing_consent"),
                "state:string,opt_in_level:string,consent_updated_at:string",
            ),
        )
        .select(
            F.col("id").alias("customer_id"),
            F.col("consent.state").alias("consent_state"),
            F.col("consent.opt_in_level").alias("opt_in_level"),
            F.col("consent.consent_updated_at").cast("timestamp").alias("consent_updated_at"),
            (F.col("consent.state") == "subscribed").alias("is_subscribed"),
            "_airbyte_extracted_at",
        )
    )


def _visit(which: str) -> list[Column]:
    visit = f"journey.{which}Visit"
    fields = {
        "at": F.col(f"{visit}.occurredAt").cast("timestamp"),
        "source": F.col(f"{visit}.source"),
        "source_type": F.col(f"{visit}.sourceType"),
        "landing_page": F.col(f"{visit}.landingPage"),
        "referrer_url": F.col(f"{visit}.referrerUrl"),
    }
    for part in ("source", "medium", "campaign", "content", "term"):
        value = F.col(f"{visit}.utmParameters.{part}")
        fields[f"utm_{part}"] = F.lower(value) if part in ("source", "medium") else value
    return [col.alias(f"{which}_visit_{name}") for name, col in fields.items()]


def customer_journeys(raw: DataFrame) -> DataFrame:
    """One row per order: first and last tracked visit, null when untracked."""
    ddl = (
        "customerOrderIndex:string,daysToConversion:string,momentsCount:string,"
        f"firstVisit:{_VISIT},lastVisit:{_VISIT}"
    )
    parsed = raw.withColumn("journey", fn.parse_object(F.col("customer_journey_summary"), ddl))
    return parsed.select(
        "order_id",
        F.col("created_at").alias("order_created_at"),
        fn.whole(F.col("journey.customerOrderIndex"), "int").alias("customer_order_index"),
        fn.whole(F.col("journey.daysToConversion"), "int").alias("days_to_conversion"),
        fn.whole(F.col("journey.momentsCount"), "int").alias("moments_count"),
        F.col("journey.firstVisit.occurredAt").isNotNull().alias("has_journey"),
        *_visit("first"),
        *_visit("last"),
        "_airbyte_extracted_at",
    )


def discount_codes(raw: DataFrame) -> DataFrame:
    """One row per discount code."""
    return raw.select(
        F.col("id").alias("discount_code_id"),
        "price_rule_id",
        F.col("code").alias("discount_code"),
        "usage_count",
        "created_at",
        "updated_at",
        "shop_url",
        "_airbyte_extracted_at",
    )


def price_rules(raw: DataFrame) -> DataFrame:
    """One row per price rule; the value is stored negative and flipped here.

    ``ends_at`` arrives as an integer column that is always null. Anything else
    in it stops the run: Spark would read a number as epoch seconds.
    """
    unexpected = F.raise_error(F.concat(F.lit("price rule end is not empty: "), F.col("ends_at")))
    return raw.select(
        F.col("id").alias("price_rule_id"),
        F.col("title").alias("price_rule_title"),
        "value_type",
        (-fn.money(F.col("value"))).alias("discount_value"),
        "target_type",
        "target_selection",
        "allocation_method",
        "customer_selection",
        F.col("once_per_customer").alias("is_once_per_customer"),
        "usage_limit",
        "starts_at",
        F.when(F.col("ends_at").isNotNull(), unexpected).cast("timestamp").alias("ends_at"),
        "created_at",
        "updated_at",
        "shop_url",
        "_airbyte_extracted_at",
    )


def products(raw: DataFrame) -> DataFrame:
    """One row per product; tags are ``<type>, <gender>, <season>``."""
    parsed = raw.withColumn("_image", fn.parse_object(F.col("image"), "src:string"))
    return parsed.select(
        F.col("id").alias("product_id"),
        "handle",
        F.col("title").alias("product_title"),
        "vendor",
        "product_type",
        (F.col("product_type") == "Gift Card").alias("is_gift_card"),
        fn.list_part(F.col("tags"), 2).alias("gender"),
        fn.list_part(F.col("tags"), 3).alias("season"),
        "tags",
        F.col("status").alias("product_status"),
        "published_scope",
        F.col("_image.src").alias("image_url"),
        "created_at",
        "published_at",
        "updated_at",
        "shop_url",
        "_airbyte_extracted_at",
    )


def product_variants(raw: DataFrame) -> DataFrame:
    """One row per variant; options are color and size."""
    return raw.select(
        F.col("id").alias("variant_id"),
        "product_id",
        "sku",
        "barcode",
        "inventory_item_id",
        F.col("title").alias("variant_title"),
        F.nullif(F.col("option1"), F.lit("Default")).alias("color"),
        F.col("option2").alias("size"),
        F.col("position").alias("variant_position"),
        fn.money(F.col("price")).alias("price"),
        fn.money(F.col("compare_at_price")).alias("compare_at_price"),
        F.col("taxable").alias("is_taxable"),
        "inventory_management",
        F.col("inventory_management").isNotNull().alias("is_inventory_tracked"),
        "inventory_policy",
        "inventory_quantity",
        "requires_shipping",
        "grams",
        "weight",
        "weight_unit",
        "created_at",
        "updated_at",
        "shop_url",
        "_airbyte_extracted_at",
    )
