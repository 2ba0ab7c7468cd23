"""Exact percentiles by selection: histograms instead of a sort.

A pass counts values per cell (partial aggregation, so a task sends one row per cell whatever
it reads); the driver sees a bounded histogram, finds the cells that hold the wanted positions
and the next pass looks into these cells alone.  No exchange carries table rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells a window is cut into per pass.
CELLS = 2048


@dataclass
class _Window:
    """Values between two occurring values, with the wanted positions inside."""
    column: str
    low: float
    high: float
    before: int
    ranks: list[int] = field(default_factory=list)


def _cell(v: Column, low: Column, high: Column, cells: int) -> Column:
    """Cell of ``v`` in [low, high], non-decreasing in v; low and high never share one."""
    def share(f) -> Column:
        return (f(v) - f(low)) / (f(high) - f(low))

    def log(x: Column) -> Column:
        return F.signum(x) * F.log1p(F.abs(x))
    # magnitudes first: a wide window is cut by ratio, a narrow one evenly
    wide = (high - low > F.lit(cells)) & (log(high) > log(low))
    whole = F.when(wide, share(log)).otherwise(share(lambda x: x))
    return F.least(F.floor(whole * cells), F.lit(cells - 1)).cast("int")


def extremes(long: DataFrame) -> dict[str, tuple[int, float, float]]:
    """column → (values, smallest, largest); nulls and NaN are no values."""
    rows = _values(long).groupBy("column").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    return {r["column"]: (r["n"], r["low"], r["high"]) for r in rows}


def _values(long: DataFrame) -> DataFrame:
    # infinities count as the largest finite numbers
    finite = F.greatest(F.least(F.col("v"), F.lit(8e307)), F.lit(-8e307))
    return long.filter(F.col("v").isNotNull() & ~F.isnan("v")).select("column", finite.alias("v"))


def exact_percentiles(long: DataFrame, probs: list[float],
                      known: dict[str, tuple[int, float, float]] | None = None,
                      cells: int = CELLS) -> dict[str, list[float]]:
    """Exact linear-interpolation percentiles (as ``numpy.percentile``): column → values.

    ``long`` has columns ``column`` and ``v`` (double).  Each pass counts the values of
    every open window per cell, with the smallest and largest one of each cell; a wanted
    position whose cell holds a single value is found, the others go on in the window
    between their cell's extremes.  A pass separates at least a window's ends, usually 2,048
    cells; the first cuts by magnitude, so 64-bit numbers need a handful.
    """
    known = extremes(long) if known is None else known
    found: dict[tuple[str, int], float] = {}
    windows = [_Window(c, low, high, 0, sorted({f((n - 1) * p) for p in probs for f in (floor, ceil)}))
               for c, (n, low, high) in known.items()]
    spark = long.sparkSession
    while True:
        for w in windows:
            if w.low == w.high:
                found.update({(w.column, r): w.low for r in w.ranks})
        windows = [w for w in windows if w.low < w.high]
        if not windows:
            break
        # a few rows: at most two windows for each percentile and column
        asked = spark.createDataFrame(
            [(w.column, i, w.low, w.high) for i, w in enumerate(windows)],
            "column string, w int, low double, high double")
        inside = _values(long).join(F.broadcast(asked), "column") \
            .filter(F.col("v").between(F.col("low"), F.col("high")))
        counts = inside.groupBy(
            "w", _cell(F.col("v"), F.col("low"), F.col("high"), cells).alias("cell")) \
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        narrower: list[_Window] = []
        at: dict[int, int] = {}
        for c in sorted(counts.collect(), key=lambda c: (c["w"], c["cell"])):
            w = windows[c["w"]]
            start = at.get(c["w"], w.before)
            at[c["w"]] = start + c["n"]
            ranks = [r for r in w.ranks if start <= r < start + c["n"]]
            if ranks:
                narrower.append(_Window(w.column, c["low"], c["high"], start, ranks))
        windows = narrower

    def value(c: str, n: int, p: float) -> float:
        h = (n - 1) * p
        low, high = found[c, floor(h)], found[c, ceil(h)]
        return low + (high - low) * (h - floor(h))
    return {c: [value(c, n, p) for p in probs] for c, (n, _, _) in known.items()}
