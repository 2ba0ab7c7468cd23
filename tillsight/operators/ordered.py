"""Global ordered window functions without a single-partition collapse, as lazy plans.

``rank() / ntile() / row_number() / SUM() OVER (ORDER BY …)`` with no
``PARTITION BY`` makes Spark move every row into one task (``Exchange
SinglePartition``).  After aggregation to products or customers that is still
one row per product / customer, which does not fit one task at scale.  The
operators here compute the same values with the work spread over buckets.  Building
a plan runs no job:

1. *Boundaries* (:func:`_boundaries`): a scalar subquery gives about ``partitions`` boundaries
   of the sort order.  They are quantiles of a bottom-k sample, the rows with the smallest
   hashes of their sort columns: it merges from per-partition samples, and it depends on the
   rows alone, so every evaluation in a query finds the same boundaries.  They are whole sort
   keys, so a value held by a third of all rows is split by the columns after it.
2. *Buckets* (:func:`_with_buckets`): a row's bucket is the number of boundaries at or before it, found
   in two steps of the square root of their number.
3. *Offsets* (:func:`_offsets`): a second subquery counts and sums per bucket (partial
   aggregation) and turns that into what stands before each bucket; one row per bucket.
4. A window per bucket plus the bucket's offset gives global positions and running sums.

``df`` is evaluated three times (sample, counts, result), so its sort columns must be
deterministic.  Several orderings of one table are added together
(:func:`with_ntiles`); chaining them would multiply the evaluations.

Ties: :func:`with_row_numbers` needs a total order (callers append a unique
tiebreak).  :func:`with_rank` and RANGE-frame running sums (peers share a value)
first aggregate to one row per distinct sort value — partial aggregation, so a
value held by a third of all rows costs nothing extra — number those distinct
values with steps 1–4, and join the result back on the sort value.  The join back
is an equi-join whose hot keys AQE's skew-join handling splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CNT = "__cnt"
#: Sampled rows per boundary: a bucket holds more than twice its share with probability
#: below 1e-9.
SAMPLES = 64

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def _sort_exprs(order: Order) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def _side(df: DataFrame, partitions: int | None) -> int:
    """Square root of the number of buckets."""
    wanted = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(ceil(sqrt(wanted)), 2)


def _boundaries(df: DataFrame, order: Order, side: int) -> Column:
    """Scalar subquery: struct(coarse, fine) of sorted boundary keys; ``fine`` has up to
    side² - 1 of them, ``coarse`` the last of each full run of ``side``."""
    cols = [c for c, _ in order]
    parts = side * side
    sample = df.select(*cols).orderBy(F.xxhash64(*cols), *cols).limit(SAMPLES * parts)
    # both windows run over the sample only
    place = F.row_number().over(Window.orderBy(*_sort_exprs(order))) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy())
    placed = sample.select(*cols, place.alias("__ord_place"), n.alias("__ord_n"))
    cut = F.floor(F.col("__ord_place") * parts / F.col("__ord_n"))
    before = F.floor((F.col("__ord_place") - 1) * parts / F.col("__ord_n"))
    keys = F.array_sort(F.collect_list(F.struct("__ord_place", F.struct(*cols).alias("key"))))
    fine = F.transform(keys, lambda k: k["key"])
    return placed.filter((F.col("__ord_place") > 0) & (cut > before)).agg(fine.alias("fine")) \
        .select(F.struct(
            F.transform(F.filter("fine", lambda k, i: i % side == side - 1), lambda k: k)
            .alias("coarse"), "fine")).scalar()


def _at_or_before(key: Column, order: Order) -> Column:
    """Whether a boundary key sorts at or before the row (nulls as ``asc``/``desc`` place them)."""
    out = F.lit(True)
    for c, asc in reversed(list(order)):
        b, x = key[c], F.col(c)
        first = b.isNull() & x.isNotNull() if asc else x.isNull() & b.isNotNull()
        less = first | F.coalesce(b < x if asc else b > x, F.lit(False))
        out = less | (b.eqNullSafe(x) & out)
    return out


def _with_buckets(df: DataFrame, orders: dict[str, Order], side: int) -> DataFrame:
    """``df`` with a bucket per order, in the column the order is named by."""
    def passed(keys: Column, order: Order) -> Column:
        return F.size(F.filter(keys, lambda k: _at_or_before(k, order)))
    cols = df.columns
    # subqueries must be columns before a higher-order function may read them
    df = df.withColumns({f"__ord_k{i}": _boundaries(df, order, side)
                         for i, order in enumerate(orders.values())})
    found = []
    for i, (name, order) in enumerate(orders.items()):
        keys = F.col(f"__ord_k{i}")
        full = passed(keys["coarse"], order)
        found.append((full * side + passed(F.slice(keys["fine"], full * side + 1, side), order))
                     .alias(name))
    return df.select(*cols, *found)


def bucketed(df: DataFrame, orders: dict[str, Order], partitions: int | None = None) -> DataFrame:
    """``df`` with the bucket of each order (name → order), about ``partitions`` of them.  Buckets
    follow the order and hold similar numbers of rows if it is total."""
    return _with_buckets(df, orders, _side(df, partitions))


def _offsets(df: DataFrame, names: Sequence[str], sums: Sequence[str] = ()) -> Column:
    """Scalar subquery: per bucket column in ``names`` a map from bucket to struct(rows,
    total, s0, s1, …) of what stands before it; ``total`` counts all rows."""
    which = F.explode(F.array(*[F.struct(F.lit(i).alias("w"), F.col(n).alias("b"))
                                for i, n in enumerate(names)]))
    per_bucket = df.select(which.alias("__ord_x"), *sums).groupBy("__ord_x.w", "__ord_x.b").agg(
        F.count(F.lit(1)).alias(_CNT), *[F.sum(s).alias(f"s{i}") for i, s in enumerate(sums)])
    # one row per bucket: the windows below are bounded by the number of buckets
    before = Window.partitionBy("w").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    entry = per_bucket.select("w", F.struct("b", F.struct(
        F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias("rows"),
        F.sum(_CNT).over(Window.partitionBy("w")).alias("total"),
        *[F.sum(f"s{i}").over(before).alias(f"s{i}") for i in range(len(sums))])).alias("e"))
    maps = entry.agg(*[F.map_from_entries(F.collect_list(F.when(F.col("w") == i, F.col("e"))))
                       .alias(n) for i, n in enumerate(names)])
    return maps.select(F.struct(*names)).scalar()


def with_row_numbers(df: DataFrame, order: Order, row_number: str = "row_number",
                     running_sums: dict[str, str] | None = None,
                     total_count: str | None = None,
                     partitions: int | None = None,
                     buckets: Column | None = None) -> DataFrame:
    """Add a global ``row_number`` (1-based) in ``order`` and ROWS-frame running sums.

    ``order`` must be a total order over ``df``.  ``running_sums`` maps an output
    column to the column summed over ``ROWS BETWEEN UNBOUNDED PRECEDING AND
    CURRENT ROW``.  ``total_count`` optionally names a column holding the row count.
    ``partitions``: about how many buckets (default: the session's shuffle partitions).
    ``buckets``: an expression that follows ``order`` and spreads the rows evenly, where one
    is known; it saves the sample.
    """
    running_sums = running_sums or {}
    df = _with_buckets(df, {"__ord_b": order}, _side(df, partitions)) if buckets is None \
        else df.withColumn("__ord_b", buckets)
    at = _offsets(df, ["__ord_b"], list(running_sums.values()))["__ord_b"][F.col("__ord_b")]
    within = Window.partitionBy("__ord_b").orderBy(*_sort_exprs(order))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({
        "__ord_at": at, row_number: F.row_number().over(within),
        **{f"__ord_r{i}": F.sum(src).over(running)
           for i, src in enumerate(running_sums.values())}})
    added = {row_number: F.col("__ord_at.rows") + F.col(row_number)}
    for i, name in enumerate(running_sums):
        prior = F.col(f"__ord_at.s{i}")
        added[name] = F.coalesce(prior + F.col(f"__ord_r{i}"), F.col(f"__ord_r{i}"), prior)
    if total_count:
        added[total_count] = F.col("__ord_at.total")
    return out.withColumns(added).drop("__ord_b", "__ord_at",
                                       *[f"__ord_r{i}" for i in range(len(running_sums))])


def ntile_from_row_number(rn: Column | str, n: Column | str, k: int) -> Column:
    """SQL ``NTILE(k)`` from a 1-based row number and the row count: the first
    ``n mod k`` tiles hold one extra row."""
    rn = F.col(rn) if isinstance(rn, str) else rn
    n = F.col(n) if isinstance(n, str) else n
    q = (n / F.lit(k)).cast("long")
    r = n % F.lit(k)
    threshold = r * (q + 1)
    return F.when(rn <= threshold, ((rn - 1) / (q + 1)).cast("long") + 1) \
        .otherwise(r + ((rn - 1 - threshold) / F.nullif(q, F.lit(0))).cast("long") + 1) \
        .cast("int")


def with_ntiles(df: DataFrame, tiles: dict[str, tuple[Order, int]],
                partitions: int | None = None) -> DataFrame:
    """Several ``NTILE(k) OVER (ORDER BY order)`` of one table: output column → (order, k).
    The orders must be total.  ``df`` is evaluated once for all counts and once for the result."""
    side = _side(df, partitions)
    cols = df.columns
    df = _with_buckets(df, {f"__ord_b_{out}": order for out, (order, _) in tiles.items()}, side)
    offsets = _offsets(df, [f"__ord_b_{out}" for out in tiles])
    for out, (order, k) in tiles.items():
        within = Window.partitionBy(f"__ord_b_{out}").orderBy(*_sort_exprs(order))
        df = df.withColumns({"__ord_at": offsets[f"__ord_b_{out}"][F.col(f"__ord_b_{out}")],
                             "__ord_rn": F.row_number().over(within)})
        rn = F.col("__ord_at.rows") + F.col("__ord_rn")
        df = df.withColumn(out, ntile_from_row_number(rn, F.col("__ord_at.total"), k))
    return df.select(*cols, *tiles)


def with_ntile(df: DataFrame, order: Order, k: int, out: str,
               partitions: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)``; ``order`` must be total (add a tiebreak)."""
    return with_ntiles(df, {out: (order, k)}, partitions)


def with_rank(df: DataFrame, key: str, ascending: bool = True, rank: str | None = "rank",
              range_sums: dict[str, str] | None = None,
              partitions: int | None = None) -> DataFrame:
    """``RANK() OVER (ORDER BY key)`` and RANGE-frame running sums (peers share).

    ``range_sums`` maps an output column to the summed column, i.e.
    ``SUM(col) OVER (ORDER BY key)`` with SQL's default RANGE frame.
    ``key`` must be non-null.
    """
    range_sums = range_sums or {}
    per_value = df.groupBy(key).agg(
        F.count(F.lit(1)).alias(_CNT),
        *[F.sum(src).alias(f"__v_{out}") for out, src in range_sums.items()])
    numbered = with_row_numbers(
        per_value, [(key, ascending)], row_number="__vrn",
        running_sums={"__rows_before_incl": _CNT,
                      **{out: f"__v_{out}" for out in range_sums}},
        partitions=partitions)
    cols = [key]
    if rank:
        numbered = numbered.withColumn(rank, (F.col("__rows_before_incl") - F.col(_CNT) + 1)
                                       .cast("int"))
        cols.append(rank)
    cols += list(range_sums)
    return df.join(numbered.select(*cols), key)


def top_k_with_ties(df: DataFrame, key: str, k: int, rank: str = "rank") -> DataFrame:
    """Rows with ``RANK() OVER (ORDER BY key DESC) <= k``, with that rank.

    The k largest keys come from a bounded top-k (per-partition top-k, then a merge
    of k rows per partition).  Every row at or above the last of them has rank ≤ k, and
    all keys above it are among them, so they give every rank.
    """
    best = df.select(key).filter(F.col(key).isNotNull()).orderBy(F.col(key).desc()).limit(k) \
        .agg(F.collect_list(key)).scalar()
    return df.filter(F.col(key) >= F.array_min(best)).withColumn("__ord_best", best).withColumn(
        rank, (F.size(F.filter("__ord_best", lambda v: v > F.col(key))) + 1).cast("int")) \
        .drop("__ord_best")
