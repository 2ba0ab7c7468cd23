"""Incremental load of star batches into a versioned store.

A batch is five tables in the shape of :mod:`tillsight.plans.star`.  Parents are checked and joined to
what is stored before their children are looked up; lines that break a constraint go to the
``quarantine`` table; accepted lines get surrogate keys that a reload does not change.  All tables of
a batch, the key registries and the quarantine become visible in one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.model import Retail
from tillsight.operators.keys import extend_registry, with_surrogate_keys
from tillsight.operators.load_checks import Checked, Constraints, check_batch
from tillsight.operators.quality import NOT_NULL
from tillsight.sources.sinks import scratch_path
from tillsight.sources.snapshots import SnapshotStore

PARTITIONS = {"invoices": ["year"]}
#: Surrogate keys and the columns that identify their lines.
SURROGATES = {
    "invoice_items": ("item_id", ["invoice_no", "stock_code", "quantity", "unit_price"]),
    "returns": ("return_id", ["invoice_no", "customer_id", "stock_code", "country", "quantity",
                              "unit_price", "invoice_date"]),
}


def constraints(parents: dict[str, DataFrame]) -> dict[str, Constraints]:
    """The constraints of the five tables; ``parents``: customers, products and invoices as
    they will be after the load."""
    above = {"unit_price > 0": F.col("unit_price") > 0}
    return {
        "customers": Constraints(NOT_NULL["customers"], {}, ["customer_id"],
                                 defaults={"is_guest": False}),
        "products": Constraints(NOT_NULL["products"], above, ["stock_code"]),
        "invoices": Constraints(
            NOT_NULL["invoices"], {}, ["invoice_no"],
            {"customer_id": (parents["customers"], "customer_id")}
            if "customers" in parents else {}, {"is_guest": False}),
        "invoice_items": Constraints(
            NOT_NULL["invoice_items"], {"quantity > 0": F.col("quantity") > 0} | above, (),
            {"invoice_no": (parents["invoices"], "invoice_no"),
             "stock_code": (parents["products"], "stock_code")} if "invoices" in parents else {}),
        "returns": Constraints(
            NOT_NULL["returns"], {}, (),
            {"customer_id": (parents["customers"], "customer_id"),
             "stock_code": (parents["products"], "stock_code")} if "products" in parents else {}),
    }


def load(spark: SparkSession, store: SnapshotStore, batch: dict[str, DataFrame],
         reload: bool = False) -> tuple[int, dict[str, dict[str, int]]]:
    """Load a batch; (new version, violation counts by table).

    ``reload``: the batch replaces the stored tables (truncate and reload) instead of being
    appended; key registries live on, so lines that come again keep their keys."""
    before = store.tables()
    stored = {} if reload else before
    parents: dict[str, DataFrame] = {}
    done: dict[str, Checked] = {}
    for name in ("customers", "products", "invoices", "invoice_items", "returns"):
        done[name] = check_batch(batch[name], constraints(parents)[name], stored.get(name), name)
        parents[name] = done[name].rows if name not in stored else \
            done[name].rows.unionByName(stored[name].select(*batch[name].columns))
    new = {name: c.rows for name, c in done.items()}
    registries = {}
    for name, (key, natural) in SURROGATES.items():
        # an appended line is a new one, whatever is stored; a reloaded one keeps its key
        table, registry = f"{name}_keys", before.get(f"{name}_keys")
        rows = new[name] if reload or name not in stored else \
            stored[name].select(*batch[name].columns).unionByName(new[name])
        path = scratch_path(spark, table)
        extend_registry(rows, natural, registry, key).write.parquet(path)
        registries[table] = spark.read.parquet(path)
        keyed = with_surrogate_keys(rows, natural, registries[table], key)
        if not reload and name in stored:
            keyed = keyed.join(stored[name].select(key), key, "left_anti")
        new[name] = keyed
    held = [c.quarantine.select(F.lit(name).alias("table"), "reasons", F.to_json(F.struct(
        *[F.col(col) for col in batch[name].columns])).alias("line")) for name, c in done.items()]
    new["quarantine"] = held[0].unionByName(held[1]).unionByName(held[2]) \
        .unionByName(held[3]).unionByName(held[4])
    counts = {name: c.counts for name, c in done.items()}
    if reload or not before:
        return store.replace({**new, **registries}, PARTITIONS), counts
    fresh = {t: r.join(before[t].select("__k1", "__k2", "__nth"), ["__k1", "__k2", "__nth"],
                       "left_anti") if t in before else r for t, r in registries.items()}
    return store.append({**new, **fresh}, PARTITIONS), counts


def star_batch(r: Retail) -> dict[str, DataFrame]:
    """A star as a batch to load."""
    return {"customers": r.customers, "products": r.products, "invoices": r.invoices,
            "invoice_items": r.items, "returns": r.returns}


def surrogate_keys(r: Retail) -> DataFrame:
    """(table, rows, distinct_keys, first_key, last_key) of the lines' surrogate keys."""
    tables = star_batch(r)
    parts = []
    for name, (key, natural) in SURROGATES.items():
        keyed = with_surrogate_keys(tables[name], natural,
                                    extend_registry(tables[name], natural, None, key), key)
        per_key = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("distinct_keys"), F.min(key).alias("first_key"),
            F.max(key).alias("last_key")).select(F.lit(name).alias("table"), "*"))
    return parts[0].unionByName(parts[1])


def line_checks(lines: DataFrame, r: Retail) -> DataFrame:
    """(check, violations) of raw sale lines against a star's item constraints, one pass."""
    parents = {"invoices": r.invoices, "products": r.products, "customers": r.customers}
    found = check_batch(lines.select("invoice_no", "stock_code", "quantity", "unit_price"),
                        constraints(parents)["invoice_items"], name="lines")
    return lines.sparkSession.createDataFrame(list(found.counts.items()),
                                              "check string, violations long")


def quarantined_lines(lines: DataFrame, r: Retail) -> DataFrame:
    """The raw sale lines that break an item constraint, with the first reason and their number."""
    parents = {"invoices": r.invoices, "products": r.products, "customers": r.customers}
    found = check_batch(lines.select("invoice_no", "stock_code", "quantity", "unit_price"),
                        constraints(parents)["invoice_items"], name="lines").quarantine
    return found.select("invoice_no", "stock_code", "quantity", "unit_price",
                        F.col("reasons")[0].alias("first_reason"),
                        F.size("reasons").alias("n_reasons"))
