"""The streaming ingest cleans file drops like the batch job."""

from tillsight.operators.cleaning import clean
from tillsight.sources.csv import read_raw_transactions
from tillsight.streaming.ingest import start_ingest
from tests.test_cleaning import RAW


def test_ingest_matches_batch_cleaning(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header, *rows = RAW.strip("\n").split("\n")
    # two drops; the second holds the line whose description must be imputed
    (landing / "a.csv").write_text("\n".join([header] + rows[:14]) + "\n", encoding="utf-8")
    (landing / "b.csv").write_text("\n".join([header] + rows[14:]) + "\n", encoding="utf-8")
    out = tmp_path / "out"
    q = start_ingest(spark, str(landing), str(out / "sales"), str(out / "returns"),
                     str(out / "ckpt"), available_now=True, max_files=1)
    q.awaitTermination(300)
    streamed = spark.read.parquet(str(out / "sales"))
    batch_sales, batch_returns = clean(read_raw_transactions(spark, str(tmp_path / "landing")))
    cols = ["invoice_no", "stock_code", "description", "quantity", "revenue", "is_guest"]
    assert streamed.select(*cols).exceptAll(batch_sales.select(*cols)).count() == 0
    assert batch_sales.select(*cols).exceptAll(streamed.select(*cols)).count() == 0
    assert spark.read.parquet(str(out / "returns")).count() == batch_returns.count()
    assert streamed.select("batch_id").distinct().count() == 2
