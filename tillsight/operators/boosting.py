"""Second-order gradient boosting of a 0/1 label from histograms, one aggregate a level.

Values are cut into bins once, at exact percentiles of the training rows.  Growing a level of
a tree is one partially aggregated pass: gradient sums per (node, feature, bin), so a task
sends at most nodes x features x bins rows whatever it reads, and no row is shuffled.  The
driver sees these sums alone and picks each node's best split; a tree then is an expression
over the bins, and the rows of the next pass are routed by it.

Gradients, curvatures and margins are whole millionths.  Their sums are exact in any order,
so a model does not depend on how the rows are laid out.

Defined cases: a null or NaN value falls into the lowest bin; rows with a null label are not
trained on; without training rows, or where no split gains anything, trees have one leaf; of
equal gains the first feature and lowest bin win; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from math import floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.selection import exact_percentiles

#: Fixed-point unit of gradients, curvatures and margins.
UNIT = 1_000_000
#: Trees whose margins are carried as expressions before the rows are stored again.
STORE_EVERY = 5


@dataclass(frozen=True)
class Split:
    """Inner node: rows whose bin of ``feature`` is at most ``bin`` go left."""
    feature: int
    bin: int
    left: Split | int
    right: Split | int


@dataclass(frozen=True)
class Boosted:
    features: tuple[str, ...]
    #: Per feature, the values its bins end at.
    edges: tuple[tuple[float, ...], ...]
    #: Margin of a row before any tree (millionths of log-odds).
    base: int
    #: Trees whose leaves are margins.
    trees: tuple[Split | int, ...]

    def bins(self) -> list[Column]:
        return [_bin(F.col(f"`{c}`"), e) for c, e in zip(self.features, self.edges, strict=True)]

    def score(self, rows: DataFrame, name: str = "p") -> DataFrame:
        """``rows`` with the probability of label 1 as column ``name``."""
        binned = rows.select("*", *[b.alias(f"__b{i}") for i, b in enumerate(self.bins())])
        margin = sum((_routed(t) for t in self.trees), F.lit(self.base).cast("long"))
        return binned.select(*[F.col(f"`{c}`") for c in rows.columns if c != name],
                             probability(margin).alias(name))


def probability(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(margin.cast("double") / F.lit(float(UNIT)))))


def _millionths(x: Column) -> Column:
    return F.floor(x * F.lit(float(UNIT)) + F.lit(0.5)).cast("long")


def _bin(value: Column, edges: tuple[float, ...]) -> Column:
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    above = sum((F.when(v > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return above.cast("int")


def _routed(tree: Split | int) -> Column:
    """The leaf of ``tree`` a row with bins ``__b0``, ``__b1`` … falls into."""
    if isinstance(tree, int):
        return F.lit(tree).cast("long")
    return F.when(F.col(f"__b{tree.feature}") <= F.lit(tree.bin), _routed(tree.left)) \
        .otherwise(_routed(tree.right))


def _map_leaves(tree: Split | int, fn: Callable[[int], Split | int]) -> Split | int:
    if isinstance(tree, int):
        return fn(tree)
    return Split(tree.feature, tree.bin,
                 _map_leaves(tree.left, fn), _map_leaves(tree.right, fn))


def _best_split(cells: dict[tuple[int, int], tuple[int, int]], n_features: int,
                ridge: float, least: float) -> tuple[int, int] | None:
    """(feature, bin) of the largest gain among one node's cells, None where none gains."""
    best, found = 0.0, None
    for f in range(n_features):
        mine = sorted((b, *gh) for (feature, b), gh in cells.items() if feature == f)
        g_all, h_all = sum(x[1] for x in mine), sum(x[2] for x in mine)
        g = h = 0
        for b, dg, dh in mine[:-1]:
            g, h = g + dg, h + dh
            if min(h, h_all - h) < least:
                continue
            gain = _strength(g, h, ridge) + _strength(g_all - g, h_all - h, ridge) \
                - _strength(g_all, h_all, ridge)
            if gain > best:
                best, found = gain, (f, b)
    return found


def _total(cells: dict[tuple[int, int], tuple[int, int]], feature: int,
           wanted: Callable[[int], bool] = lambda b: True) -> tuple[int, int]:
    """Gradient and curvature of a node's rows whose bin of ``feature`` is wanted."""
    got = [gh for (f, b), gh in cells.items() if f == feature and wanted(b)]
    return sum(g for g, _ in got), sum(h for _, h in got)


def _strength(g: int, h: int, ridge: float) -> float:
    return float(g) * float(g) / (float(h) + ridge)


def fit(rows: DataFrame, features: list[str], label: str, rounds: int = 10, depth: int = 3,
        bins: int = 16, rate: float = 0.3, ridge: float = 1.0,
        least_weight: float = 1.0) -> Boosted:
    """Boosted trees that predict ``label`` (0 or 1) from numeric ``features``.

    ``rounds`` trees of at most ``depth`` levels; ``rate`` shrinks each tree's leaves,
    ``ridge`` is added to the curvature of a leaf, and both sides of a split have a
    curvature of at least ``least_weight``.
    """
    known = rows.filter(F.col(f"`{label}`").isNotNull())
    values = F.inline(F.array(*[
        F.struct(F.lit(str(i)).alias("column"), F.col(f"`{c}`").cast("double").alias("v"))
        for i, c in enumerate(features)]))
    cuts = exact_percentiles(known.select(values), [k / bins for k in range(1, bins)])
    edges = tuple(tuple(cuts.get(str(i), ())) for i in range(len(features)))
    blank = Boosted(tuple(features), edges, 0, ())
    stored = known.select(F.col(f"`{label}`").cast("int").alias("__y"),
                          *[b.alias(f"__b{i}") for i, b in enumerate(blank.bins())]).checkpoint()
    count = stored.agg(F.count_if(F.col("__y") == 1).alias("ones"),
                       F.count_if(F.col("__y") == 0).alias("zeros")).first()
    base = floor(log((count["ones"] + 0.5) / (count["zeros"] + 0.5)) * UNIT + 0.5)

    trees: list[Split | int] = []
    state = stored.withColumn("__m", F.lit(base).cast("long"))
    for _ in range(rounds):
        tree = _grow(state, len(features), depth, rate, ridge * UNIT, least_weight * UNIT)
        trees.append(tree)
        state = state.withColumn("__m", F.col("__m") + _routed(tree))
        if len(trees) % STORE_EVERY == 0 and len(trees) < rounds:
            state = state.checkpoint()
    return Boosted(tuple(features), edges, base, tuple(trees))


def _grow(state: DataFrame, n_features: int, depth: int, rate: float, ridge: float,
          least: float) -> Split | int:
    """One tree on the gradients of ``state``'s margins."""
    p = probability(F.col("__m"))
    pulled = state.select(_millionths(p - F.col("__y")).alias("g"),
                          _millionths(p * (F.lit(1.0) - p)).alias("h"),
                          *[f"__b{i}" for i in range(n_features)])
    tree: Split | int = 0      # leaves hold the number of their node while the tree grows
    sums: dict[int, tuple[int, int]] = {}
    open_nodes = {0}
    for _ in range(depth):
        if not open_nodes:
            break
        # closed leaves have negative numbers and are complete
        here = pulled.withColumn("node", _routed(tree)).filter(F.col("node") >= 0)
        cells = here.select("node", "g", "h", F.posexplode(F.array(
            *[F.col(f"__b{i}") for i in range(n_features)])).alias("feature", "bin")) \
            .groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        per_node: dict[int, dict] = defaultdict(dict)
        # at most 2 ** level nodes x features x bins sums
        for r in cells.collect():
            per_node[r["node"]][r["feature"], r["bin"]] = (r["g"], r["h"])
        grown: dict[int, Split | int] = {}
        for node in open_nodes:
            mine = per_node.get(node, {})
            split = _best_split(mine, n_features, ridge, least)
            if split is None:
                grown[node] = -1 - node
                sums[node] = _total(mine, 0)
            else:
                left, right = 2 * node + 1, 2 * node + 2
                grown[node] = Split(*split, left, right)
                sums[left] = _total(mine, split[0], lambda b, at=split[1]: b <= at)
                sums[right] = _total(mine, split[0], lambda b, at=split[1]: b > at)
        tree = _map_leaves(tree, lambda n: grown.get(n, n))
        open_nodes = {c for x in grown.values() if isinstance(x, Split)
                      for c in (x.left, x.right)}

    def value(node: int) -> int:
        g, h = sums.get(node if node >= 0 else -1 - node, (0, 0))
        return floor(rate * (-float(g) / (float(h) + ridge)) * UNIT + 0.5) if g else 0
    return _map_leaves(tree, value)
