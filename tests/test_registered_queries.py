"""Every registered query against its SQL on whole tables."""

import duckdb  # noqa: F401
import pytest
from compare import connect, differences

import __spark_entry__ as contract
from sparkmart.registry import QUERIES
from sparkmart.plans.pipeline import DERIVED, STAGING


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_table_and_query_has_sql():
    assert set(STAGING) | set(DERIVED) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    assert differences(df, con, contract.oracle_sql()[name]) is None


def test_written_tables_start_from_dealt_rows(spark, sf_dir, monkeypatch):
    from sparkmart.registry import quality

    dealt = []
    call = quality.raw_tables
    monkeypatch.setattr(quality, "raw_tables", lambda *a, **k: dealt.append(call(*a, **k)) or dealt[-1])
    quality.written_report(spark, sf_dir)
    plan = dealt[0]("shopify", "orders")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
