"""Sharding along a Hilbert curve (DataFrame functions only).

1. Every metadata dimension is quantised to ``2**bits`` equal-depth bins: count
   rows per distinct value, order the values (nulls first), and place a value by
   the share of rows before it.  The counts are aggregated map-side, the ordering
   is distributed, and the value table joins back on null-safe equality (the
   planner broadcasts it below its size threshold; beyond, a sort-merge join whose
   hot values AQE splits).
2. The bins are the axes of a Hilbert curve; its index is plain integer arithmetic
   (per bit plane: invert or exchange axes, then Gray-code and interleave).
3. Rows are ordered by (index, text hash, id) and cut into runs: law ``rows``,
   shard sizes at most one row apart.  Neighbouring rows share narrow ranges in all
   dimensions, so min/max statistics of a shard prune on each of them, and equal
   texts with equal metadata sit side by side.

Only ids, metadata and text digests are shuffled, never texts.

Defined cases: a null dimension value is the lowest value of its dimension; null
text has size 1 and null CRC; an empty table gives no rows; rows that agree in
everything are placed in either order; other columns of the input (clashing names
included) are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import stored
from tillsight.operators.ordered import with_row_numbers


def hilbert_steps(df: DataFrame, axes: list[str], bits: int, out: str) -> DataFrame:
    """Add the Hilbert index ``out`` of integer columns ``axes`` (each below ``2**bits``).

    Each step rewrites two axis columns; the columns are plain projections."""
    first = axes[0]
    for plane in range(bits - 1, 0, -1):
        low = (1 << plane) - 1
        for axis in axes:
            here = F.col(axis).bitwiseAND(1 << plane) != 0
            if axis == first:
                df = df.withColumn(first, F.when(here, F.col(first).bitwiseXOR(F.lit(low)))
                                   .otherwise(F.col(first)))
                continue
            swap = F.col(first).bitwiseXOR(F.col(axis)).bitwiseAND(low)
            df = df.withColumn("__swap", F.when(here, F.lit(0)).otherwise(swap)) \
                .withColumns({
                    first: F.col(first).bitwiseXOR(
                        F.when(here, F.lit(low)).otherwise(F.col("__swap"))),
                    axis: F.col(axis).bitwiseXOR(F.col("__swap"))})
    for before, axis in zip(axes, axes[1:], strict=False):
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    # undo the excess work of the Gray code: parity of the higher bits of the last axis
    flip: Column = F.lit(0)
    for plane in range(bits - 1, 0, -1):
        flip = flip.bitwiseXOR(F.when(F.col(axes[-1]).bitwiseAND(1 << plane) != 0,
                                      F.lit((1 << plane) - 1)).otherwise(F.lit(0)))
    df = df.withColumn("__swap", flip)
    index: Column = F.lit(0).cast("long")
    for plane in range(bits):
        for k, axis in enumerate(reversed(axes)):
            bit = F.shiftright(F.col(axis).bitwiseXOR(F.col("__swap")), plane).bitwiseAND(1)
            index = index + F.shiftleft(bit.cast("long"), plane * len(axes) + k)
    return df.withColumn(out, index).drop("__swap")


def equal_depth_bins(df: DataFrame, column: str, bits: int, out: str) -> DataFrame:
    """(``column``, ``out``): the bin of every distinct value, by rows before it."""
    # the numbering reads its input three times: the rows are counted once
    counts = stored(df.groupBy(column).agg(F.count(F.lit(1)).alias("__n")), "bin-counts")
    placed = with_row_numbers(counts, [(column, True)], "__rn", {"__through": "__n"})
    total = counts.agg(F.sum("__n")).first()[0] or 1
    share = (F.col("__through") - F.col("__n")) * (1 << bits) / F.lit(total)
    return stored(placed.select(column, F.floor(share).cast("int").alias(out)), "bins")


def hilbert_shards(df: DataFrame, dims: Mapping[str, Column], text: str = "text",
                   id_col: str = "doc_id", shards: int = 16, bits: int = 5,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Place every row of ``df`` into one of ``shards`` runs of the Hilbert order.

    ``dims``: name -> expression of each curve dimension.  Returns ``id_col``,
    ``keep`` columns, size, text_crc32, curve_index, law, shard, slot, grown_shard.
    """
    axes = [f"__a{i}" for i in range(len(dims))]
    rows = stored(df.select(
        F.col(id_col).alias("__id"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("__size"),
        F.crc32(F.col(text).cast("binary")).alias("__crc"),
        F.xxhash64(F.col(text)).alias("__hash"),
        *[e.alias(f"__d{i}") for i, e in enumerate(dims.values())]), "shard-rows")
    placed = rows
    for i, axis in enumerate(axes):
        bins = equal_depth_bins(rows, f"__d{i}", bits, axis) \
            .withColumnRenamed(f"__d{i}", f"__v{i}")
        placed = placed.join(bins, F.col(f"__d{i}").eqNullSafe(F.col(f"__v{i}"))) \
            .drop(f"__d{i}", f"__v{i}")
    # the numbering reads its input three times: the joins and the curve are planned once
    placed = stored(hilbert_steps(placed, axes, bits, "__h").drop(*axes), "shard-order")
    numbered = with_row_numbers(
        placed, [("__h", True), ("__hash", True), ("__id", True)], "__rn",
        total_count="__n")
    position, n = F.col("__rn") - 1, F.col("__n")
    shard = F.expr(f"(__rn - 1) * {shards} div __n")
    return numbered.withColumn("__shard", shard).select(
        F.col("__id").alias(id_col),
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
        F.col("__h").alias("curve_index"), F.lit("rows").alias("law"),
        F.col("__shard").cast("int").alias("shard"),
        (position - F.expr(f"(__shard * __n + {shards - 1}) div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def document_dims() -> dict[str, Column]:
    """Curve dimensions of the documents table: language, source, size class."""
    return {"lang": F.col("lang"), "source": F.col("source"),
            "size_class": F.floor(F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 1.0) * 2)}
