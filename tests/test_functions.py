"""Column builders on edge values, mostly side by side with DuckDB."""

import random
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkmart import functions as fn


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x"))).first()[0]


def many(spark, values, build, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[1] for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


#: utm_source of each URL.
SOURCES = {
    None: None,
    "": None,
    "/": None,
    "/p?utm_source=Google": "Google",
    "/p?a=1&UTM_Source=Face%20book&b=2": "Face book",
    "/p?utm_source=": None,
    "/p?utm_source=a%2Bb+c": "a+b+c",
    "/p?utm_source=100%zz%41": "100%zzA",
    "/p?utm_source=%": "%",
    "/p?xutm_source=no&utm_source=yes#utm_source=frag": "yes",
    "/p#x?utm_source=after": "after",
    "/p?utm_source=x?fbclid=1": "x?fbclid=1",
    "/p?utm_source=%C3%A9t%C3%A9": "été",
    "/p?utm_source": None,
    "utm_source=none": None,
}

#: Page and referrer domain of more URLs.
PARTS = {
    None: (None, None),
    "": ("", None),
    "/": ("/", None),
    "/p?utm_source=Google": ("/p", None),
    "/p?a=1&UTM_Source=Face%20book&b=2": ("/p", None),
    "/p?utm_source=": ("/p", None),
    "/p?utm_source=a%2Bb+c": ("/p", None),
    "/p?utm_source=100%zz%41": ("/p", None),
    "/p?utm_source=%": ("/p", None),
    "/p?xutm_source=no&utm_source=yes#utm_source=frag": ("/p", None),
    "/p#x?utm_source=after": ("/p", None),
    "/p?utm_source=x?fbclid=1": ("/p", None),
    "/p?utm_source=%C3%A9t%C3%A9": ("/p", None),
    "/p?utm_source": ("/p", None),
    "utm_source=none": ("utm_source=none", None),
    "https://a.b:80/c?d#e": ("https://a.b:80/c", "a.b:80"),
    "http://x": ("http://x", "x"),
    "ftp://x/y": ("ftp://x/y", None),
    "https://": ("https://", None),
    "/a#b?c": ("/a", None),
}


def test_url_param(spark):
    got = many(spark, list(SOURCES), lambda c: fn.url_param(c, "utm_source"))
    assert got == list(SOURCES.values())


def test_url_params_in_one_pass_equal_each_alone(spark):
    odd = ["/?a=1&A=2&b=3", "/?A=x?b=y&=z", "/p?b=a=1&a=%41?b", "?&a==", "/#?a=1#b=2", "/?xa=1&a", "/?\u212aa=1&a=\u212a+%zz"]
    urls = [*SOURCES, *odd, ""]
    df = spark.createDataFrame(list(enumerate(urls)), "i int, url string")
    url, names = F.col("url"), {"a": "a", "b": "B", "s": "utm_source", "f": "fbclid"}
    one_pass = F.struct(*[v.alias(k) for k, v in fn.url_params(url, names).items()])
    alone = F.struct(*[fn.url_param(url, v).alias(k) for k, v in names.items()])
    assert df.select(one_pass.alias("got"), alone.alias("want")).where("got is distinct from want").collect() == []


def test_url_parts(spark):
    got = zip(many(spark, list(PARTS), fn.without_query_and_fragment), many(spark, list(PARTS), fn.referrer_domain))
    assert list(got) == list(PARTS.values())


TAGGED = {
    None: False,
    "": False,
    "test": True,
    " test , x": True,
    "contest": False,
    "a,test": True,
    "test\n": True,
    "a,\ttest\t,b": True,
    "x, test y": False,
    "a,\vtest": False,
}


def test_has_tag(spark):
    assert many(spark, list(TAGGED), lambda c: fn.has_tag(c, "test")) == list(TAGGED.values())


@pytest.mark.parametrize(
    "agent,expected",
    [
        (None, None),
        ("", "desktop"),
        ("Mozilla (iPad; Mobile)", "tablet"),
        ("Android TABLET Mobile", "tablet"),
        ("iPhone MOBILE", "mobile"),
        ("ANDROID", "mobile"),
        ("Windows NT", "desktop"),
    ],
)
def test_device_type(spark, agent, expected):
    assert one(spark, agent, fn.device_type) == expected


def test_campaign_status(spark):
    values = ["active", "ENABLED", "Enable", "paused", "DISABLE", "removed", "DELETED", "archived",
              "IN_PROCESS", None]
    assert many(spark, values, fn.campaign_status) == [
        "active", "active", "active", "paused", "paused", "removed", "removed", "removed",
        "other", "other",
    ]


def test_urn_id(spark):
    assert one(spark, "urn:li:sponsoredCampaign:388013719", fn.urn_id) == 388013719
    assert one(spark, None, fn.urn_id) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "urn:li:12\n", fn.urn_id)  # digits must be at the very end


REASONS = {
    "Return - Too small": "Too small",
    "Return-x": "x",
    "Return -  ": None,
    "a, Return - b": "a, Return - b",
    "Return": "Return",
    None: None,
}


def test_strip_prefix_only_at_the_start(spark):
    got = many(spark, list(REASONS), lambda c: fn.tidy(fn.strip_prefix(c, "Return")))
    assert got == list(REASONS.values())


def test_list_and_id_parts(spark):
    assert one(spark, "shirt, women, fall", lambda c: fn.list_part(c, 2)) == "women"
    assert one(spark, "shirt", lambda c: fn.list_part(c, 3)) is None
    assert one(spark, "shopify_US_12_34", lambda c: fn.id_part(c, 4)) == 34


def test_full_name(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("", None), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(fn.full_name(F.col("a"), F.col("b"))).collect()]
    assert got == ["A B", "B", None, None]


def test_surrogate_key_with_a_null_part(spark):
    df = spark.createDataFrame([("a", None), ("a", 1)], "a string, b bigint")
    got = [r[0] for r in df.select(fn.surrogate_key(F.col("a"), F.col("b"))).collect()]
    expected = duckdb.sql(
        "SELECT md5('a-_dbt_utils_surrogate_key_null_'), md5('a-1')"
    ).fetchall()[0]
    assert got == list(expected)


def test_money_from_double_equals_duckdb(spark):
    rng = random.Random(7)
    values = [1.005, 0.285, 2.675, -1.005, 0.0, -0.0, 0.49999999999999994 / 100, None, 1e9 + 0.005]
    values += [rng.randrange(-10**7, 10**7) / 1000 for _ in range(3000)]
    values += [rng.randrange(0, 10**7) / 200 for _ in range(3000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i int, x double)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    expected = [r[0] for r in con.execute(
        "SELECT cast(x AS decimal(14,2)) FROM t ORDER BY i").fetchall()]
    assert many(spark, values, lambda c: fn.money_from_double(c, 14), "double") == expected


def test_money_from_text(spark):
    assert one(spark, "12.345", fn.money) == Decimal("12.35")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "", fn.money)


def test_units(spark):
    assert one(spark, 1234, fn.from_cents, "bigint") == 12.34
    micros = lambda c: fn.money_from_double(fn.from_micros(c), 14)
    assert one(spark, 1005000, micros, "bigint") == Decimal("1.00")


ITEMS = "id:string,amount:string"


def test_json_objects(spark):
    build = lambda c: fn.parse_object(c, ITEMS)["id"]
    texts = ['{"id":12345678901234567}', '{"id":null}', "{}", "null", None, '{"id":{"a":1}}']
    assert many(spark, texts, build) == ["12345678901234567", None, None, None, None, '{"a":1}']


@pytest.mark.parametrize("text", ["{bad", "[1", "abc", "", " "])
@pytest.mark.parametrize("parse", [fn.parse_object, fn.parse_objects])
def test_malformed_json_stops_the_run(spark, text, parse):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        one(spark, text, lambda c: parse(c, ITEMS).cast("string"))


ODD_DOCUMENTS = ["[]", '"x"', "5", "true", "null", "{}", ' \n{"id":"7"}', '{"a":{"id":"1"},"b":{"id":"2"}}']


def test_documents_of_another_kind_equal_duckdb(spark):
    con = duckdb.connect()
    ids = "SELECT (json(?)->>'id')"
    expected = [con.execute(ids, [t]).fetchone()[0] for t in ODD_DOCUMENTS]
    assert many(spark, ODD_DOCUMENTS, lambda c: fn.parse_object(c, ITEMS)["id"]) == expected
    lines = "SELECT list(v.value->>'id') FROM (SELECT json(?) AS j), json_each(j) AS v"
    expected = [con.execute(lines, [t]).fetchone()[0] or [] for t in ODD_DOCUMENTS]
    got = many(spark, ODD_DOCUMENTS, lambda c: F.transform(fn.parse_objects(c, ITEMS), lambda x: x["id"]))
    assert [sorted(x, key=str) for x in got] == [sorted(x, key=str) for x in expected]


def test_whole_numbers_from_text(spark):
    texts = ["2", "2.0", "2.5", "-2.4", " 7 ", None, "12345678901234567"]
    want = [int(x) if x else None for x in ("2", "2", "3", "-2", "7", None, "12345678901234567")]
    assert many(spark, texts, lambda c: fn.whole(c, "bigint")) == want
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "x", lambda c: fn.whole(c, "int"))


def test_json_array_items(spark):
    total = lambda c: fn.sum_items(
        fn.parse_objects(c, ITEMS), lambda i: fn.money(i["amount"]), "decimal(38,2)"
    )
    texts = ['[{"amount":"1.10"},{"amount":null},{"id":1},null,{"amount":2}]', "[]", None, "null"]
    assert many(spark, texts, total) == [Decimal("3.10"), 0, 0, 0]
    some = lambda c: fn.sum_items(
        fn.parse_objects(c, ITEMS), lambda i: fn.money(i["amount"]), "decimal(38,2)",
        where=lambda i: i["id"] == "a",
    )
    texts = ['[{"id":"a","amount":1},{"id":null,"amount":5},{"id":"a","amount":2}]']
    assert many(spark, texts, some) == [Decimal("3.00")]
    assert many(spark, ["[]", '["x"]', None], lambda c: fn.first(fn.parse_array(c, "string"))) == [
        None, "x", None,
    ]


def test_param_value(spark):
    kind = ("array<struct<key:string,value:struct<string_value:string,int_value:bigint,"
            "float_value:double,double_value:double>>>")  # fmt: skip
    entry = lambda k, s=None, i=None: (k, (s, i, None, None))
    lists = [
        [entry("a", "first"), entry("b", i=7), entry("a", "second")],
        [(None, ("x", None, None, None)), entry("a", "found")],
        [],
        None,
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], f"i int, p {kind}")
    got = df.select(fn.param_value("p", "a"), fn.param_value("p", "b", "int")).collect()
    assert [tuple(r) for r in got] == [("first", 7), ("found", None), (None, None), (None, None)]


def test_times(spark):
    late = datetime(2024, 3, 1, 23, 30)
    df = spark.createDataFrame([(late, datetime(2024, 3, 2, 0, 10))], "a timestamp, b timestamp")
    assert df.select(fn.midnights_between(F.col("a"), F.col("b"))).first()[0] == 1
    assert one(spark, "20240229", fn.day_from_text) == date(2024, 2, 29)
    assert one(spark, date(2024, 2, 29), fn.day_to_text, "date") == "20240229"
    text = lambda c: fn.from_epoch_millis(c).cast("string")
    assert one(spark, "1700000000123", text) == "2023-11-14 22:13:20.123"
    text = lambda c: fn.from_epoch_micros(c).cast("string")
    assert one(spark, 1700000000123456, text, "bigint") == "2023-11-14 22:13:20.123456"
