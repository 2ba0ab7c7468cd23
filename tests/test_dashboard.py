"""Dashboard filter semantics."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillsight.plans import dashboard
from tillsight.sources import synthetic


def test_no_year_selected_gives_zero_kpis(spark):
    r = synthetic.load(spark, SF_SMALL).filtered(years=[], countries=None)
    row = dashboard.kpi_cards(r).collect()[0]
    assert row.total_revenue == 0.0 and row.total_orders == 0 and row.total_customers == 0
    assert row.return_rate_pct == 0.0 and row.avg_order_value is None
    assert dashboard.returns_kpis(r).count() == 0


def test_year_and_country_filter_reach_both_tables(spark):
    base = synthetic.load(spark, SF_SMALL)
    years = [1997, 1998]
    countries = ["NATION_1", "NATION_2"]
    r = base.filtered(years=years, countries=countries)
    got = dashboard.kpi_cards(r).collect()[0]
    sales = base.sales().filter(F.col("year").isin(years) & F.col("country").isin(countries))
    rets = base.returns.filter(F.year("invoice_date").isin(years)
                               & F.col("country").isin(countries))
    assert got.total_orders == sales.select("invoice_no").distinct().count()
    assert got.units_returned == rets.agg(F.sum("quantity")).collect()[0][0]


def test_empty_country_list_means_all(spark):
    base = synthetic.load(spark, SF_SMALL)
    a = dashboard.kpi_cards(base.filtered(years=None, countries=[])).collect()[0]
    b = dashboard.kpi_cards(base).collect()[0]
    assert a == b


def test_filter_is_pushed_to_the_scan(spark):
    r = synthetic.load(spark, "/root/testdata/sf0.01").filtered(countries=["NATION_3"])
    plan = dashboard.kpi_cards(r)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "n_name" in line]
    assert scans and all("EqualTo(n_name,NATION_3)" in line for line in scans)


def test_year_filter_prunes_stored_partitions(spark):
    from tillsight import warehouse
    r = warehouse.synthetic(spark, "/root/testdata/sf0.01").filtered(years=[1999])
    plan = dashboard.kpi_cards(r)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    totals = [line for line in scans if "units:bigint" in line]
    assert totals and all("PartitionFilters: [isnotnull(year" in line and "= 1999" in line
                          for line in totals)
    returns = [line for line in scans if "ReadSchema: struct<quantity:int,invoice_date" in line]
    assert returns and all("GreaterThanOrEqual(invoice_date,1999-01-01" in line
                           for line in returns)


def test_views_answer_sql(spark):
    from tillsight import warehouse
    from tillsight.plans import views
    r = warehouse.synthetic(spark, "/root/testdata/sf0.01")
    views.register_views(r)
    via_sql = spark.sql("SELECT customer_id FROM vw_customer_rfm WHERE segment = 'At risk'")
    direct = views.rfm_at_risk(r).select("customer_id")
    assert via_sql.exceptAll(direct).count() == 0 and direct.exceptAll(via_sql).count() == 0
    top = spark.sql("SELECT COUNT(*) AS n FROM vw_top_products WHERE cumulative_pct <= 80")
    assert top.collect()[0].n == views.pareto_count(r).collect()[0].products_in_pareto


def test_jdbc_options():
    import pytest
    from tillsight.sources.jdbc import jdbc_read_options, jdbc_write_options
    o = jdbc_read_options("jdbc:postgresql://db/retail", "invoice_items",
                          partition_column="item_id", lower=1, upper=1_000_000,
                          num_partitions=32)
    assert o["partitionColumn"] == "item_id" and o["numPartitions"] == "32"
    assert o["lowerBound"] == "1" and o["upperBound"] == "1000000"
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", "t", partition_column="id")
    assert jdbc_write_options("jdbc:x", "t", 1000)["batchsize"] == "1000"


def test_stored_and_lazy_paths_agree_under_filters(spark):
    from tillsight import warehouse
    folder = "/root/testdata/sf0.01"
    years, countries = [1996, 2000], ["NATION_4", "NATION_9"]
    stored = warehouse.synthetic(spark, folder).filtered(years, countries)
    lazy = synthetic.load(spark, folder).filtered(years, countries)
    assert dashboard.kpi_cards(stored).collect() == dashboard.kpi_cards(lazy).collect()
    a = dashboard.top10_products(stored).collect()
    b = dashboard.top10_products(lazy).collect()
    assert a == b
