"""Every query key against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as E
from tillsight.registry import QUERIES
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)


def test_every_key_has_oracle_or_is_rows_only():
    rows_only = set(KEYS) - set(E.oracle_sql())
    assert rows_only == {"churn_eval", "churn_cost_benefit"}
    assert set(KEYS) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, key):
    from tillsight.verify import compare
    result = compare(spark, SF_SMALL, [key], verbose=False, strict=True)[key]
    assert result.startswith("ok") or result.startswith("rows-only"), result


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "revenue", "revenue_prev_month", "growth_pct"]
    assert df.count() > 0
