"""Reporting plans on edge rows."""

from datetime import date

import pytest

from sparkmart.plans import reporting


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


FACT = (
    "platform string, campaign_key string, date_day date, spend decimal(38,2), impressions bigint, clicks bigint,"
    " platform_conversions double, platform_conversion_value decimal(38,2)"
)


def test_ratios_divide_sums_and_not_sum_ratios(spark):
    from decimal import Decimal as D

    data = [
        ("Meta", "a", date(2024, 1, 1), D("10.00"), 1000, 10, 0.1, D("30.00")),
        ("Meta", "a", date(2024, 1, 2), D("30.00"), 1000, 30, 0.2, D("10.00")),
        ("Meta", "b", date(2024, 1, 1), D("0.00"), 0, 0, None, None),
        ("TikTok", "c", date(2024, 1, 1), D("5.00"), None, 5, 1.0, D("5.00")),
    ]
    got = {(r.level, r.platform, r.campaign_key): r for r in reporting.campaign_ratios(spark.createDataFrame(data, FACT)).collect()}
    assert set(got) == {
        ("campaign", "Meta", "a"), ("campaign", "Meta", "b"), ("campaign", "TikTok", "c"),
        ("platform", "Meta", None), ("platform", "TikTok", None), ("total", None, None),
    }
    one = got["campaign", "Meta", "a"]
    assert (one.ctr, one.cpc, one.cpm, one.platform_roas) == (0.02, 1.0, 20.0, 1.0) and one.platform_conversions == 0.3
    none = got["campaign", "Meta", "b"]
    assert (none.ctr, none.cpc, none.cpm, none.platform_roas) == (None,) * 4
    assert got["platform", "TikTok", None].ctr is None and got["platform", "TikTok", None].cpc == 1.0
    assert got["total", None, None].cpc == 1.0 and float(got["total", None, None].spend) == 45.0
    plan = reporting.campaign_ratios(spark.createDataFrame(data, FACT))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate [platform")  # days are summed below the copies
    empty = reporting.campaign_ratios(spark.createDataFrame([], FACT)).collect()
    assert [r.level for r in empty] in ([], ["total"])


def test_channels_of_pairs_with_and_without_values(spark):
    mapping = spark.createDataFrame(
        [("google", "cpc", "Paid Search", "Google Ads", True), ("news", None, "Email", None, False)],
        "utm_source string, utm_medium string, channel string, platform string, is_paid boolean",
    )
    pairs = [("google", "cpc"), ("news", None), (None, None), ("google", None), (None, "cpc"), ("x", "y"), ("google", "cpc")]
    orders = spark.createDataFrame([(i, None, *p) for i, p in enumerate(pairs)], "order_id int, created_at timestamp, utm_source string, utm_medium string")
    got = reporting.order_channels(orders, mapping).orderBy("order_id").collect()
    none = reporting.UNATTRIBUTED
    assert [r.channel for r in got] == ["Paid Search", "Email", none, none, none, none, "Paid Search"]
    assert [r.is_paid for r in got] == [True, False, False, False, False, False, True]
    plan = reporting.order_channels(orders, mapping)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    twice = mapping.union(mapping)
    with pytest.raises(Exception, match="duplicate lookup key"):
        reporting.order_channels(orders, twice).collect()


CALENDAR = (
    "entry_type string, name string, start_date date, end_date date, discount_pct double, discount_code string, channels string, notes string"
)


def test_ranges_become_days(spark):
    d = lambda n: date(2024, 2, n)
    data = [
        ("promotion", "A", d(27), date(2024, 3, 1), 10.0, "TEN", "all", None),
        ("promotion", "B", d(28), d(28), 30.0, "Z30", "all", None),
        ("promotion", "C", d(28), None, 30.0, "B30", "all", None),
        ("event", "D", d(29), d(27), None, None, "all", None),  # reversed
        ("event", "E", None, d(28), None, None, "all", None),
        ("event", "F", d(28), d(28), None, None, "all", None),
        ("event", "F", d(28), d(28), None, None, "all", None),
        ("media_flight", "G", date(2024, 3, 9), date(2024, 3, 9), None, None, None, None),
    ]
    calendar = spark.createDataFrame(data, CALENDAR)
    days = [(r.date_day, r["name"]) for r in reporting.calendar_days(calendar).collect()]
    assert sorted(days) == sorted(
        [(d(27), "A"), (d(28), "A"), (d(29), "A"), (date(2024, 3, 1), "A"), (d(28), "B"), (d(28), "C"), (d(28), "F"), (d(28), "F"), (date(2024, 3, 9), "G")]
    )
    by_day = {r.date_day: r for r in reporting.calendar_by_day(calendar).collect()}
    one = by_day[d(28)]
    assert (one.promotions, one.events, one.media_changes, one.media_flights) == (3, 2, 0, 0)
    assert (one.entry_names, one.discount_pct, one.discount_code) == ("A; B; C; F", 30.0, "B30")
    assert by_day[date(2024, 3, 9)].discount_pct is None and len(by_day) == 5
    assert "Exchange" not in reporting.calendar_days(calendar)._jdf.queryExecution().executedPlan().toString()
    assert reporting.calendar_by_day(calendar.where("false")).count() == 0
