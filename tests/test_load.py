"""Versioned loads: constraints, quarantine, surrogate keys, appends and interrupted reloads."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillsight.operators import quality
from tillsight.operators.keys import extend_registry, with_surrogate_keys
from tillsight.operators.load_checks import Constraints, check_batch
from tillsight.plans import star
from tillsight.plans.load import load, star_batch
from tillsight.sources.snapshots import SnapshotStore
from tillsight.warehouse import cleaned

T0 = datetime.datetime(2011, 1, 1)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "wh"))


def test_versions(spark, store):
    df = spark.createDataFrame([(1, "a", 2010), (2, "b", 2011)], "id int, s string, year int")
    assert store.version() == 0 and store.tables() == {}
    assert store.replace({"t": df, "u": df.limit(1)}, {"t": ["year"]}) == 1
    assert store.append({"t": df.selectExpr("id + 10 as id", "s", "year")}, {"t": ["year"]}) == 2
    now = store.tables()
    assert now["t"].schema.names == df.schema.names
    assert rows(now["t"], "id") == [(1,), (11,), (12,), (2,)] and now["u"].count() == 1
    assert rows(store.tables(1)["t"], "id") == [(1,), (2,)]
    assert rows(now["t"].filter("year = 2011"), "id") == [(12,), (2,)]
    assert store.replace({"t": df.filter("id = 1")}) == 3
    assert set(store.tables()) == {"t"} and store.tables()["t"].count() == 1


def test_stopped_reload_reads_the_old_version(spark, store):
    df = spark.range(5)
    store.replace({"a": df, "b": df})
    broken = df.select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.replace({"a": spark.range(99), "b": broken})
    assert store.version() == 1
    assert {k: v.count() for k, v in store.tables().items()} == {"a": 5, "b": 5}
    # what was written before the stop disturbs no later load
    assert store.append({"a": spark.range(2)}) == 2 and store.tables()["a"].count() == 7


def test_concurrent_loads_do_not_overwrite(spark, store, monkeypatch):
    store.replace({"a": spark.range(1)})
    monkeypatch.setattr(store, "version", lambda: 0)
    with pytest.raises(Exception, match="(?i)already exists"):
        store.append({"a": spark.range(9)})
    monkeypatch.undo()
    assert store.tables()["a"].count() == 1


def test_surrogate_keys_stay(spark):
    lines = [("1", "a", None), ("1", "a", None), ("1", "a", 2), (None, "a", 2), ("1", None, 2)]
    df = spark.createDataFrame(lines, "i string, c string, q int")
    natural = ["i", "c", "q"]
    first = extend_registry(df, natural).cache()
    a = with_surrogate_keys(df, natural, first)
    assert sorted(r["id"] for r in a.collect()) == [1, 2, 3, 4, 5]
    more = df.union(spark.createDataFrame([("9", "z", 1), ("1", "a", None)], df.schema))
    second = extend_registry(more.repartition(3), natural, first)
    b = with_surrogate_keys(more, natural, second)
    assert sorted(r["id"] for r in b.collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert set(map(tuple, a.collect())) <= set(map(tuple, b.collect()))


def test_one_pass_counts_equal_separate_checks(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    batch = spark.createDataFrame(
        [(1, 1, 5, None), (1, 2, 5, True), (2, 3, -1, False), (None, None, 0, True), (3, 1, None, None)],
        "id int, fk int, q int, flag boolean")
    got = check_batch(batch, Constraints(["id", "q", "flag"], {"q > 0": F.col("q") > 0}, ["id"],
                                         {"fk": (parent, "k")}, {"flag": False}))
    assert got.counts == {"rows": 5, "id not null": 1, "q not null": 1, "flag not null": 0,
                          "check q > 0": 2, "primary key id": 1, "foreign key fk": 1}
    # the earlier of two rows with one key stays; a missing flag has become false
    assert rows(got.rows, "id", "fk", "flag") == [(1, 1, False)]
    held = {r["fk"]: r["reasons"] for r in got.quarantine.filter("id is not null").collect()}
    assert held == {2: ["primary key id"], 3: ["check q > 0", "foreign key fk"], 1: ["q not null"]}


def test_load_append_and_reload(spark, store):
    r = cleaned(spark, SF_SMALL).star()
    half = r.invoices.agg(
        F.min("invoice_date")).first()[0] + datetime.timedelta(days=1200)
    early = r.invoices.filter(F.col("invoice_date") < half)
    batch = star_batch(r)
    first = {**batch, "invoices": early,
             "invoice_items": r.items.join(early.select("invoice_no"), "invoice_no", "left_semi")
             .select(*r.items.columns), "returns": r.returns.filter(F.col("invoice_date") < half)}
    clean_counts = {"products": r.products.filter("not (unit_price > 0)").count()}
    version, counts = load(spark, store, first, reload=True)
    assert version == 1
    assert counts["products"]["check unit_price > 0"] == clean_counts["products"]
    one = store.tables()
    # headers without a country are set aside, and so are the lines that hang on them
    aside = one["quarantine"].filter("table = 'invoices'").count()
    assert aside > 0 and one["invoices"].count() + aside == early.count()
    keys = rows(one["invoice_items"], "item_id")
    assert len(keys) == len(set(keys))
    # the second half, with lines that break every rule
    late = r.invoices.join(early.select("invoice_no"), "invoice_no", "left_anti")
    bad_items = spark.createDataFrame(
        [("nowhere", "nothing", 1, 1.0, 1.0), (None, None, -1, 0.0, 0.0)],
        "invoice_no string, stock_code string, quantity int, unit_price double, revenue double")
    late_items = r.items.join(late.select("invoice_no"), "invoice_no", "left_semi")
    second = {
        "customers": r.customers.limit(3), "products": r.products.limit(0),
        "invoices": late.select(*r.invoices.columns).unionByName(
            early.limit(2).select(*r.invoices.columns)),
        "invoice_items": late_items.select(*r.items.columns).unionByName(
            bad_items.select(*[F.col(f.name).cast(f.dataType) for f in r.items.schema])),
        "returns": r.returns.filter(F.col("invoice_date") >= half)}
    version, counts = load(spark, store, second)
    assert version == 2
    assert counts["customers"]["primary key customer_id"] == 3
    assert counts["invoices"]["primary key invoice_no"] == 2
    items = counts["invoice_items"]
    assert items["invoice_no not null"] == items["check quantity > 0"] == 1
    assert items["check unit_price > 0"] >= 1 and items["foreign key invoice_no"] >= 1
    assert items["foreign key stock_code"] >= 1
    two = store.tables()
    aside = two["quarantine"].filter("table = 'invoices'").count()
    assert two["invoices"].count() + aside == r.invoices.count() + 2
    assert two["customers"].count() == r.customers.filter("country is not null").count()
    # every line is stored once or set aside once
    stored = two["invoice_items"].count() + two["quarantine"].filter("table = 'invoice_items'").count()
    assert stored == r.items.count() + 2
    ids = two["invoice_items"].select("item_id")
    assert ids.distinct().count() == ids.count()
    # a line keeps its key through the append and through a reload of everything
    kept = dict((r[0], r[1:]) for r in map(tuple, one["invoice_items"].select(
        "item_id", "invoice_no", "stock_code", "quantity", "unit_price").collect()))
    cols = ("item_id", "invoice_no", "stock_code", "quantity", "unit_price")
    after = {x[0]: x[1:] for x in map(tuple, two["invoice_items"].select(*cols).collect())}
    assert all(after[k] == v for k, v in kept.items())
    version, counts = load(spark, store, batch, reload=True)
    third = store.tables()
    again = {x[0]: x[1:] for x in map(tuple, third["invoice_items"].select(*cols).collect())}
    assert version == 3 and again == after
    # what is stored passes the separate checks
    from tillsight.model import Retail
    whole = Retail(third["invoices"], third["invoice_items"], third["returns"], third["products"],
                   third["customers"])
    assert quality.dq_not_null(whole).agg(F.sum("nulls")).first()[0] == 0
    assert quality.dq_check(whole).agg(F.sum("violations")).first()[0] == 0
    assert quality.dq_pk_dups(whole).agg(F.sum("duplicate_keys")).first()[0] == 0
    assert quality.dq_fk_orphans(whole).agg(F.sum("orphans")).first()[0] == 0


def test_loader_star_is_unchanged(spark):
    assert star.row_counts(cleaned(spark, SF_SMALL).star()).count() == 5
