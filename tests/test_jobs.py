"""End-to-end batch jobs on the hand-written raw export."""

from pyspark.sql import functions as F

from tests.test_cleaning import RAW
from tillsight.jobs import MART_ORDER, run_etl, run_marts
from tillsight.sources.ordered import read_ordered


def test_etl_then_marts(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text(RAW, encoding="utf-8")
    out = str(tmp_path / "wh")
    r = run_etl(spark, str(raw), out)
    counts = {row.table: row.rows for row in spark.read.parquet(f"{out}/_reports/row_counts")
              .collect()}
    assert counts["invoice_items"] == 20 and counts["returns"] == 2
    report = spark.read.parquet(f"{out}/_reports/cleaning").collect()[0]
    assert (report.raw_rows, report.clean_rows, report.return_rows) == (29, 20, 2)
    paths = run_marts(spark, out, str(tmp_path / "marts"), years=[2011], countries=[])
    kpi = spark.read.parquet(paths["dashboard/kpi_cards"]).collect()[0]
    assert kpi.total_orders == r.items.select("invoice_no").distinct().count()
    assert kpi.units_returned == 4
    growth = spark.read.parquet(paths["views/monthly_growth"])
    assert growth.filter(F.col("year") == 2011).count() == 6
    assert len(paths) == 49
    # every mart of an ORDER BY query comes back in its order
    for name, order in MART_ORDER.items():
        rows = [tuple(r[c] for c, _ in order) for r in read_ordered(spark, paths[name]).collect()]
        for (column, ascending), *_ in [order]:
            values = [r[0] for r in rows if r[0] is not None]
            assert values == sorted(values, reverse=not ascending), (name, column)
    assert [tuple(r) for r in read_ordered(spark, paths["views/rfm_segments"], 2).collect()] == \
        [tuple(r) for r in read_ordered(spark, paths["views/rfm_segments"]).collect()][:2]
