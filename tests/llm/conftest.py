import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, spark  # noqa: F401

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "id long, n long, size long, `key` string, row long")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def _text(seed, n):
    return " ".join(WORDS[(i * i + seed * 7 + i // 3) % len(WORDS)] + str(seed % 5)
                    for i in range(n))


def messy_rows():
    texts = [None, "", " \t\n ", "one", "ONE", "12 34 !!", _text(1, 40), _text(1, 40),
             _text(2, 40), _text(2, 39) + " other", "long " * 3000 + _text(3, 3000),
             "a\nb\nc\nd\ne\nf", "x\na\nb\nc\nd\ne\nf", "été déjà vu", "привет мир", "×÷"]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s2", "s10", None][i % 3], 0, 1, 2, 3, "k", 5)
            for i, t in enumerate(texts)]
    # a null id, and a row twice
    return [*rows, (None, _text(4, 30), None, None, None, None, None, None, None, None), rows[6]]


def write_tables(session, folder, rows):
    session.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    session.createDataFrame(
        [(0, _text(2, 40)), (1, None), (2, ""), (None, "q r s")] if rows else [],
        "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    session.createDataFrame([(6, 1, 0), (7, None, 1), (11, 0, 0), (99, 0, 0)] if rows else [],
                            "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    session.createDataFrame(
        [(0, "http://a/", "<html><title>T</title><p>x<script>y</script></p><br>z"),
         (1, None, None), (2, "http://b/", ""), (2, "http://b/", ""), (None, "u", "<p")]
        if rows else [], "page_id long, url string, html string") \
        .write.parquet(f"{folder}/pages.parquet")
    session.createDataFrame(
        [(0, 0, "user", "a"), (0, None, None, None), (1, 0, "user", "a"), (None, 1, "user", "b"),
         (1, 0, "user", "a"), (5, 2, "user", ""), (8, 1, "bot", "x"), (9, 1, "bot", "x")]
        if rows else [], "conv_id long, turn long, role string, text string") \
        .write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):  # noqa: F811
    return write_tables(spark, tmp_path_factory.mktemp("messy"), messy_rows())


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):  # noqa: F811
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [])


@pytest.fixture(scope="session")
def documents(spark):  # noqa: F811
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("text"), "lang", "source").collect()
    return {r["doc_id"]: r for r in rows}
