"""Joins, unions, ranking and quality checks on small frames."""

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.conform import conform_union
from sparkmart.operators.enrich import guard_unique, left_enrich, unmatched
from sparkmart.operators.latest import latest_per_key
from sparkmart.operators.quality import Checks, Watch, failing_rows, linked, orphans, report


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_conform_union_keeps_text_ids(spark):
    a = spark.createDataFrame([("00x1",)], "id string")
    b = spark.createDataFrame([(7,)], "id bigint")
    got = conform_union({"A": a, "B": b}, {"id": "string"})
    assert rows(got) == [("A", "00x1"), ("B", "7")]


def test_left_enrich_keeps_every_left_row(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    assert rows(left_enrich(left, right, ["k"])) == [(1, "a"), (1, "a"), (2, None), (None, None)]
    assert rows(left_enrich(left, right, ["k"], guard=True)) == rows(
        left_enrich(left, right, ["k"])
    )


def test_guard_finds_duplicate_keys(spark):
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate lookup key: 1"):
        guard_unique(right, ["k"]).select("k").collect()


def test_unmatched_keeps_null_keys(spark):
    left = spark.createDataFrame([("a", "x"), ("a", None), (None, None)], "s string, m string")
    right = spark.createDataFrame([("a", "x"), (None, None)], "s string, m string")
    assert rows(unmatched(left, right, ["s", "m"])) == [("a", None), (None, None)]


def test_latest_puts_null_dates_last_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [(1, None, "n"), (1, 5, "five"), (2, None, "only"), (1, 4, "four")], "k int, d int, v string"
    )
    got = latest_per_key(df, ["k"], [F.col("d").desc()])
    assert rows(got.select("k", "v")) == [(1, "five"), (2, "only")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_rolls_up_before_the_shuffle(spark):
    df = spark.range(10000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("k"))
    plan = df.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("partial_count")


CLEAN = [(1, "a", 5, 10), (2, "b", 6, 20)]
PARENT = [(10,), (20,)]
SUITE = {
    "t": Checks(
        not_null=["id"],
        unique=["id"],
        unique_together=[["id", "kind"]],
        accepted={"kind": ("a", "b")},
        minimum={"amount": 0},
        refers_to={"parent": ("p", "id")},
    )
}


def _report(spark, data):
    tables = {
        "t": spark.createDataFrame(data, "id int, kind string, amount int, parent int"),
        "p": spark.createDataFrame(PARENT, "id int"),
    }
    return {(r.check_name, r.column_name): r.failures for r in report(tables, SUITE).collect()}


def test_clean_data_passes_every_check(spark):
    assert set(_report(spark, CLEAN).values()) == {0}


@pytest.mark.parametrize(
    "bad_row,failed",
    [
        ((None, "a", 1, 10), {("not_null", "id"): 1}),
        ((1, "b", 1, 10), {("unique", "id"): 1}),
        ((1, "a", 1, 10), {("unique", "id"): 1, ("unique_together", "id, kind"): 1}),
        ((3, "z", 1, 10), {("accepted_values", "kind"): 1}),
        ((3, "a", -1, 10), {("accepted_range", "amount"): 1}),
        ((3, "a", 1, 99), {("relationships", "parent"): 1}),
        ((3, None, None, None), {}),  # nulls only fail not_null
    ],
)
def test_one_planted_violation_is_found(spark, bad_row, failed):
    got = _report(spark, [*CLEAN, bad_row])
    assert {k: v for k, v in got.items() if v} == failed


def test_failing_rows_names_the_checks(spark):
    df = spark.createDataFrame([*CLEAN, (None, "z", -1, 10)], "id int, kind string, amount int, parent int")
    got = failing_rows(df, SUITE["t"]).collect()
    assert [sorted(r.failed_checks) for r in got] == [
        ["accepted_range:amount", "accepted_values:kind", "not_null:id"]
    ]


def test_orphans_compare_text_with_numbers(spark):
    child = spark.createDataFrame([("1",), ("x9",), ("x9",), (None,)], "id string")
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert rows(orphans(child, "id", parent, "id")) == [("x9", 2)]


def test_shared_keys_are_counted_once_and_every_table_is_read_once(spark, tmp_path):
    spark.createDataFrame([(1, 5, 10), (2, 6, 20), (2, -1, 30)], "id int, amount int, parent int").write.parquet(f"{tmp_path}/t")
    spark.range(25).write.parquet(f"{tmp_path}/p")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in "tp"}
    suite = {
        "t": Checks(not_null=["id", "amount"], unique=["id", "parent"], minimum={"amount": 0}, refers_to={"parent": ("p", "id"), "id": ("p", "id")}),
        "p": Checks(unique=["id"], refers_to={"id": ("t", "id")}),
    }
    df = report(tables, suite)
    got = {(r.table_name, r.check_name, r.column_name): r.failures for r in df.collect()}
    assert {k: n for k, n in got.items() if n} == {
        ("t", "unique", "id"): 1, ("t", "accepted_range", "amount"): 1, ("t", "relationships", "parent"): 1, ("p", "relationships", "id"): 23,
    }
    assert len(got) == 9
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    executed = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert executed.count("FileScan parquet") == 2


def test_rows_are_checked_while_they_are_written(spark, tmp_path):
    df = spark.createDataFrame([*CLEAN, (None, "z", -1, 10), (2, "z", 1, 99)], "id int, kind string, amount int, parent int")
    watch = Watch(df, SUITE["t"])
    watch.rows.write.parquet(f"{tmp_path}/t")
    known = watch.failures()
    assert known == {("not_null", "id"): 1, ("accepted_values", "kind"): 2, ("accepted_range", "amount"): 1}
    tables = {"t": spark.read.parquet(f"{tmp_path}/t"), "p": spark.createDataFrame(PARENT, "id int")}
    got, want = (sorted(map(tuple, report(tables, SUITE, k).collect())) for k in ({"t": known}, {}))
    assert got == want and sum(r[3] for r in got) == 6
    only_rows = {"t": Checks(not_null=["id"])}
    assert [tuple(r) for r in report(tables, only_rows, {"t": known}).collect()] == [("t", "not_null", "id", 1)]


def test_a_published_table_is_checked_by_the_job_that_writes_it(spark, tmp_path):
    from sparkmart.plans.pipeline import Tables
    from sparkmart.sources.catalog import use_schema

    use_schema(spark, "watched", f"file://{tmp_path}")
    tables = Tables(None, {"t": spark.createDataFrame([*CLEAN, (None, "a", 1, 10)], "id int, kind string, amount int, parent int")})
    tables.write("t", "watched", SUITE["t"])
    assert tables.row_failures["t"]["not_null", "id"] == 1 and spark.table("watched.t").count() == 3


def test_linked_keys_meet_in_one_shuffle(spark):
    tables = {
        "a": spark.createDataFrame([("1", 1), ("1", 2), ("x", 2), (None, 9)], "id string, b int"),
        "b": spark.createDataFrame([(1, "1"), (2, "y"), (2, None)], "id int, a string"),
    }
    suite = {
        "a": Checks(unique=["id"], refers_to={"b": ("b", "id")}),
        "b": Checks(unique=["id"], unique_together=[["id", "a"]], refers_to={"a": ("a", "id"), "id": ("a", "id")}),
    }
    df = report(tables, suite)
    got = {(r.table_name, r.check_name, r.column_name): r.failures for r in df.collect()}
    assert got == {
        ("a", "unique", "id"): 1, ("a", "relationships", "b"): 1,
        ("b", "unique", "id"): 1, ("b", "unique_together", "id, a"): 0, ("b", "relationships", "a"): 1, ("b", "relationships", "id"): 2,
    }
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    by_value = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "value#" in line]
    assert len(by_value) == 1
    assert "array_compact" not in plan and "filter(" not in plan


def test_columns_of_checks():
    assert SUITE["t"].columns() == ["id", "kind", "amount", "parent"]


def test_linked_tables_stay_together():
    to = lambda *tables: Checks(refers_to={t: (t, "id") for t in tables})
    got = linked({"a": to("b"), "c": to("d"), "b": to(), "e": to("e"), "d": to("b", "out")})
    assert sorted(map(sorted, got)) == [["a", "b", "c", "d", "out"], ["e"]]
