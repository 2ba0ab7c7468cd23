"""Loader rules on a small raw export: null keys, unrounded prices, unreadable values,
line descriptions, the exploratory rule set, filtered line facts."""

from decimal import Decimal

import pytest

from tillsight.operators.cleaning import clean
from tillsight.plans import dashboard, eda, etl, star
from tillsight.sources.csv import malformed_values, read_raw_transactions

RAW = '''Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country
1,10001,RED MUG,2,2010-01-03 10:00:00,1.50,0.0,France
1,10001,RED MUG NEW,1,2010-01-03 10:00:00,2.00,0.0,France
2,10002,TINY,100,2010-01-04 10:00:00,0.004,7.0,EIRE
3,10003,BAD,many,2010-01-05 10:00:00,1.00,7.0,EIRE
,10004,NO INVOICE,1,2010-01-06 10:00:00,1.00,8.0,EIRE
4,POST,POSTAGE,1,2011-01-07 10:00:00,9.00,9.0,EIRE
5,10005,LATE,3,2011-02-07 10:00:00,1.00,9.0,
C6,M,Manual,-1,2010-02-01 10:00:00,5.00,0.0,EIRE
C7,M,Manual,-1,2010-02-02 10:00:00,5.00,5.0,EIRE
C8,,GONE,-1,2010-02-03 10:00:00,5.00,6.0,EIRE
'''


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text(RAW, encoding="utf-8")
    raw = read_raw_transactions(spark, str(path)).cache()
    sales, returns = clean(raw)
    return str(path), raw, sales.cache(), returns.cache()


def test_unreadable_values_are_counted(spark, loaded):
    got = {r.column: r.malformed for r in malformed_values(spark, loaded[0]).collect()}
    assert got == {"quantity": 1, "invoice_date": 0, "unit_price": 0, "customer_id": 0}


def test_price_is_filtered_before_rounding(loaded):
    tiny = loaded[2].filter("stock_code = '10002'").collect()[0]
    assert (tiny.unit_price, tiny.revenue) == (Decimal("0.00"), Decimal("0.40"))


def test_null_keys_are_not_loaded(loaded):
    r = star.build(loaded[2], loaded[3])
    assert r.products.filter("stock_code is null").isEmpty()
    assert r.invoices.filter("invoice_no is null").isEmpty()
    assert r.items.filter("invoice_no is null").isEmpty()
    assert {x.invoice_no for x in r.returns.collect()} == {"C6", "C7"}
    assert {x.customer_id for x in r.customers.collect()} >= {0, 5, 7, 9}


def test_reports_group_the_lines_own_description(loaded):
    from dataclasses import replace
    r = star.build(loaded[2], loaded[3])
    r = replace(r, lines=star.flat_lines(star.loadable(loaded[2], loaded[3])[0]))
    top = {x.description: x.revenue for x in dashboard.top10_products(r).collect()}
    assert (top["RED MUG"], top["RED MUG NEW"]) == (3.0, 2.0)
    back = {x.description: x.return_count for x in dashboard.returns_by_product(r).collect()}
    assert back == {"Manual": 2}
    assert {x.value for x in dashboard.filter_options(r).collect()} == {
        "2010", "2011", "France", "EIRE"}


def test_filter_reaches_the_line_facts(loaded):
    r = star.build(loaded[2], loaded[3]).filtered(years=[2010])
    assert {x.invoice_no for x in r.items.collect()} == {"1", "2"}


def test_exploratory_rule_set_keeps_service_lines(loaded):
    summary = etl.eda_totals(loaded[1])
    got = eda.kpi_overview(summary).collect()[0]
    # the line without an invoice counts in the total and its customer, not in a ticket
    assert (got.total_orders, got.total_customers) == (4, 4)
    assert got.total_revenue == pytest.approx(3.0 + 2.0 + 0.4 + 9.0 + 3.0 + 1.0)
    assert got.avg_ticket == pytest.approx((3.0 + 2.0 + 0.4 + 9.0 + 3.0) / 4)
    shares = {x.market: x for x in eda.home_market_share(summary, "France").collect()}
    assert shares["rest"].revenue == pytest.approx(0.4 + 9.0 + 1.0)
    kept = eda.retention_split(summary).collect()[0]
    assert (kept.customers, kept.single_customers, kept.repeat_customers) == (4, 2, 1)


def test_exploratory_figures_differ_from_the_cleaned_ones(spark):
    """On the test tables the two populations give different figures."""
    from tests.conftest import SF_MID
    from tillsight.registry import QUERIES
    from tillsight.warehouse import cleaned, synthetic
    summary = cleaned(spark, SF_MID).eda_summary()
    of_star = synthetic(spark, SF_MID).invoice_totals()
    for fn in (eda.kpi_overview, eda.peak_month, eda.retention_split, eda.revenue_by_weekday):
        assert fn(summary).collect() != fn(of_star).collect()
    texts = {x.description for x in QUERIES["price_volume_top200"](spark, SF_MID).collect()}
    assert any(t.endswith(" NEW") for t in texts)


def test_missing_tokens_and_dates_of_typed_columns(spark, tmp_path):
    """NaN is a missing id, not a number; a date in another format is malformed, not silent."""
    path = tmp_path / "raw.csv"
    path.write_text("""Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country
1,10001,A,2,2011-01-05 10:00:00,1.50,NaN,France
2,10002,B,NA,2011-01-05,1.50,7.0,France
3,10003,C,1,2011-01-05T10:00:00,null,8.0,France
4,10004,D,1.5,2011-13-05 10:00:00,x,9.0,France
""", encoding="utf-8")
    raw = read_raw_transactions(spark, str(path))
    rows = {r.invoice_no: r for r in raw.collect()}
    assert rows["1"].customer_id is None and str(rows["1"].invoice_date) == "2011-01-05 10:00:00"
    assert [rows[i].invoice_date for i in "234"] == [None] * 3
    assert (rows["2"].quantity, rows["4"].quantity) == (None, None)
    got = {r.column: r.malformed for r in malformed_values(spark, str(path)).collect()}
    assert got == {"quantity": 1, "invoice_date": 3, "unit_price": 1, "customer_id": 0}
    sales, returns = clean(raw)
    r = star.build(sales, returns)
    assert sales.filter("invoice_no = '1'").first().is_guest
    assert {c.customer_id for c in r.customers.collect()} == {-1}
