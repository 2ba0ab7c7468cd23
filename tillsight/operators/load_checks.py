"""Constraint checks of a batch in one pass, with the lines that break one set aside.

Every row gets the list of the constraints it breaks; rows without any are loaded, the others go to
a quarantine table with their reasons.  The counts are gathered while the rows are written
(``DataFrame.observe``), so a batch is neither read nor joined again for its report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillsight.sources.sinks import scratch_path


@dataclass(frozen=True)
class Constraints:
    """What a table demands of its rows."""
    not_null: Sequence[str] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)  # name → condition (null passes)
    primary_key: Sequence[str] = ()
    # column → parent table's DataFrame and key; a null reference passes
    foreign_keys: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)  # column → value for a null


@dataclass(frozen=True)
class Checked:
    rows: DataFrame        # rows that break nothing, in the batch's columns
    quarantine: DataFrame  # the others, with ``reasons``
    counts: dict[str, int]  # rows, and violations by constraint


def with_reasons(batch: DataFrame, c: Constraints, stored: DataFrame | None = None) -> DataFrame:
    """``batch`` with defaults filled in and ``reasons``: the names of the broken constraints.

    A row repeats a primary key if the batch has an earlier row with it (in the order of all
    columns) or ``stored``, the table's rows so far, has it.  A parent is looked up by its distinct
    keys; lines without a reference skip that, whatever share of the rows they are."""
    columns = batch.columns
    df = batch.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in c.defaults.items()}) \
        if c.defaults else batch
    broken = {f"{col} not null": F.col(col).isNull() for col in c.not_null}
    broken |= {f"check {name}": ~F.coalesce(ok, F.lit(True)) for name, ok in c.checks.items()}
    if c.primary_key:
        keys = list(c.primary_key)
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*columns))
        df = df.withColumn("__again", known & (nth > 1))
        if stored is not None:
            there = stored.select(*keys).distinct().withColumn("__there", F.lit(True))
            df = df.join(there, keys, "left").withColumn(
                "__again", F.col("__again") | F.col("__there").isNotNull()).drop("__there")
        broken[f"primary key {', '.join(keys)}"] = F.col("__again")
    for i, (col, (parent, key)) in enumerate(c.foreign_keys.items()):
        keys = parent.filter(F.col(key).isNotNull()).select(F.col(key).alias(f"__p{i}")).distinct()
        df = df.join(keys, F.col(col) == F.col(f"__p{i}"), "left")
        broken[f"foreign key {col}"] = F.col(col).isNotNull() & F.col(f"__p{i}").isNull()
    reasons = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in broken.items()]),
                       lambda r: r.isNotNull())
    return df.select(*columns, reasons.alias("reasons"))


def constraint_names(c: Constraints) -> list[str]:
    return [f"{col} not null" for col in c.not_null] + [f"check {n}" for n in c.checks] \
        + ([f"primary key {', '.join(c.primary_key)}"] if c.primary_key else []) \
        + [f"foreign key {col}" for col in c.foreign_keys]


def check_batch(batch: DataFrame, c: Constraints, stored: DataFrame | None = None,
                name: str = "batch") -> Checked:
    """Write the batch once, divided into good rows and quarantine, and count on the way."""
    spark = batch.sparkSession
    names = constraint_names(c)
    seen = Observation(f"load-{name}")
    marked = with_reasons(batch, c, stored).observe(
        seen, F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.array_contains("reasons", n)).alias(f"c{i}") for i, n in enumerate(names)])
    path = scratch_path(spark, f"load-{name}")
    marked.withColumn("__good", F.size("reasons") == 0).write.partitionBy("__good").parquet(path)
    got = seen.get
    back = spark.read.schema(marked.schema.add("__good", "boolean")).parquet(path)
    return Checked(
        back.filter("__good").select(*batch.columns),
        back.filter("not __good").select(*batch.columns, "reasons"),
        {"rows": got["rows"], **{n: got[f"c{i}"] for i, n in enumerate(names)}})
