"""Equal-width histograms as aggregations (no driver-side binning)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_width_histogram(df: DataFrame, value: str, bins: int,
                          count_name: str = "count") -> DataFrame:
    """``bins`` equal-width bins between the column's min and max, all bins listed.

    Bin ``b`` (0-based) holds ``lo + (hi-lo)*b/bins <= v < lo + (hi-lo)*(b+1)/bins``;
    the last bin is closed (the maximum falls in it).  When every value is equal
    all rows land in bin 0.  Bounds come from scalar subqueries; rows are binned
    and counted with a partial aggregation, so no group or task sees more than
    the per-bin counts.
    """
    v = F.col(value).cast("double")
    bounds = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    # the bounds subquery is bound once per side as a column
    rows = df.filter(F.col(value).isNotNull()).withColumn("__b", bounds)
    lo, width = F.col("__b.lo"), F.col("__b.hi") - F.col("__b.lo")
    raw = F.floor((v - lo) * F.lit(float(bins)) / F.nullif(width, F.lit(0.0)))
    b = F.coalesce(F.least(raw, F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = rows.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias(count_name))
    # the bin list is bounded by ``bins`` and only exists when the input is non-empty
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")) \
        .withColumn("__b", bounds).filter(F.col("__b.lo").isNotNull())
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (lo + width * F.col("bin") / F.lit(float(bins))).alias("bin_start"),
        (lo + width * (F.col("bin") + 1) / F.lit(float(bins))).alias("bin_end"),
        F.coalesce(F.col(count_name), F.lit(0)).alias(count_name))
