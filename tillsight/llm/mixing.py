"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are aggregated by *membership pattern* (the set of sources a document
   belongs to): word capacity per pattern, map-side combined.
2. Targets: each source's share of all words by weight, stopped at ``max_copies``
   times the source's words; the excess is reshared by weight until none is above.
3. A min-cost flow routes pattern capacity to source quotas: one arc per copy of a
   pattern, each with the pattern's words as capacity and a cost that rises with
   the copy (convex), so no document is repeated before all first copies that can
   serve the quota are used.  The graph has one node per pattern and source; it is
   solved per connected component on the driver, after a check that it has at most
   ``max_patterns`` patterns (an aggregate of the metadata, not of the documents).
4. A pattern with flow ``f`` over capacity ``c`` takes every document ``f div c``
   times, and a seeded subset of ``f mod c`` words once more: documents in the order
   of a seeded hash, a distributed running sum, whole documents while they fit;
   ``fills`` further passes offer what is left to the documents that still fit, and the
   document nearest to the rest is added where that lowers the difference.

Defined cases: null text has no words and is taken 0 times; a null source is a
source of its own, last in the order; rows with equal ids are separate documents;
an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import stored, word_count
from tillsight.operators.ordered import with_row_numbers


def source_order(sources) -> list:
    """Sources by code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def cyclic_weights(sources, cycle: Sequence[int] = (1, 2, 3)) -> dict:
    return {s: float(cycle[i % len(cycle)]) for i, s in enumerate(source_order(sources))}


def capped_targets(sizes: Mapping, weights: Mapping, total: float,
                   max_copies: int = 3) -> dict:
    """Shares of ``total`` by weight, each at most ``max_copies`` times its size."""
    target, open_ = {}, [s for s in source_order(sizes)]
    left = float(total)
    while open_:
        unit = left / (sum(weights[s] for s in open_) or 1.0)
        full = [s for s in open_ if weights[s] * unit > max_copies * sizes[s]]
        if not full:
            target.update({s: weights[s] * unit for s in open_})
            break
        for s in full:
            target[s] = float(max_copies * sizes[s])
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    return target


def components(patterns: Sequence[tuple]) -> list[list[int]]:
    """Groups of pattern numbers that share sources, directly or in a chain."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for members in patterns:
        for s in members[1:]:
            parent[root(s)] = root(members[0])
    groups = defaultdict(list)
    for i, members in enumerate(patterns):
        if members:
            groups[root(members[0])].append(i)
    return list(groups.values())


def min_cost_flow(capacity: Sequence[int], members: Sequence[tuple], quota: Mapping,
                  max_copies: int = 3) -> dict[tuple[int, object], int]:
    """Words routed from each pattern to each source: as much of the quotas as can
    be met, at least total repetition cost (copy k costs k * k).

    Successive shortest paths with potentials over pattern and source nodes."""
    nodes: dict = {}
    node = lambda x: nodes.setdefault(x, len(nodes))
    start, end = node("start"), node("end")
    arcs: list[list[int]] = []  # to, capacity left, cost; the pair of arc a is a ^ 1
    leaving: dict[int, list[int]] = defaultdict(list)

    def arc(a: int, b: int, cap: int, cost: int) -> int:
        leaving[a].append(len(arcs))
        leaving[b].append(len(arcs) + 1)
        arcs.extend(([b, cap, cost], [a, 0, -cost]))
        return len(arcs) - 2

    routes = {}
    for i, cap in enumerate(capacity):
        for copy in range(max_copies):
            arc(start, node(("p", i)), cap, copy * copy)
        for s in members[i]:
            routes[i, s] = arc(node(("p", i)), node(("s", s)), cap * max_copies, 0)
    for s, q in quota.items():
        arc(node(("s", s)), end, q, 0)
    potential = [0] * len(nodes)
    while True:
        dist: dict[int, int] = {start: 0}
        via: dict[int, int] = {}
        heap, done = [(0, start)], set()
        while heap:
            d, a = heapq.heappop(heap)
            if a in done:
                continue
            done.add(a)
            for k in leaving[a]:
                b, cap, cost = arcs[k]
                new = d + cost + potential[a] - potential[b]
                if cap > 0 and new < dist.get(b, new + 1):
                    dist[b], via[b] = new, k
                    heapq.heappush(heap, (new, b))
        if end not in dist:
            return {r: arcs[k ^ 1][1] for r, k in routes.items() if arcs[k ^ 1][1]}
        far = max(dist.values())
        for a in range(len(nodes)):
            potential[a] += dist.get(a, far)
        path, b = [], end
        while b != start:
            path.append(via[b])
            b = arcs[via[b] ^ 1][0]
        push = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push


def plan_mix(patterns: Sequence[tuple], capacity: Sequence[int], weights: Mapping,
             total: int, max_copies: int = 3) -> tuple[dict, dict]:
    """(targets by source, words by (pattern, source))."""
    sizes: dict = defaultdict(int)
    for members, cap in zip(patterns, capacity, strict=True):
        for s in members:
            sizes[s] += cap
    targets = capped_targets(sizes, weights, total, max_copies)
    flow = {}
    for group in components(patterns):
        quota = {s: round(targets[s]) for i in group for s in patterns[i]}
        part = min_cost_flow([capacity[i] for i in group], [patterns[i] for i in group],
                             quota, max_copies)
        flow.update({(group[i], s): w for (i, s), w in part.items()})
    return targets, flow


def mix_sources(df: DataFrame, membership: Column, size: Column, id_col: str = "doc_id",
                weights: Mapping | None = None, max_copies: int = 3, seed: int = 17,
                fills: int = 3, max_patterns: int = 100_000,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Words taken from every document so that sources come near their targets.

    ``membership``: array<string> of a document's sources (null elements allowed).
    ``weights``: by source; default 1, 2, 3 repeating in source order.  Returns
    ``id_col``, ``keep``, sources, size, copies, taken."""
    spark = df.sparkSession
    docs = stored(df.select(
        F.col(id_col).alias("__id"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
        F.coalesce(F.array_sort(F.array_distinct(membership)), F.array().cast("array<string>"))
        .alias("__m"),
        size.cast("long").alias("__size")), "mix-docs")
    found = docs.groupBy("__m").agg(F.sum("__size").alias("c")) \
        .limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than max_patterns={max_patterns} membership patterns")
    found.sort(key=lambda r: [(s is None, s or "") for s in r["__m"] or ()])
    patterns = [tuple(r["__m"] or ()) for r in found]
    capacity = [int(r["c"]) for r in found]
    weights = weights or cyclic_weights({s for p in patterns for s in p})
    _, flow = plan_mix(patterns, capacity, weights, sum(capacity), max_copies)
    words = defaultdict(int)
    for (i, _), w in flow.items():
        words[i] += w
    before, at = [], 0
    for cap in capacity:
        before.append(at)
        at += cap
    plan = stored(spark.createDataFrame(
        [(list(p), i, before[i], words[i] // max(capacity[i], 1),
          words[i] % max(capacity[i], 1)) for i, p in enumerate(patterns)],
        "__pm array<string>, __p int, __before long, __copies int, __left long"), "mix-plan")

    # tables with one row a pattern (``max_patterns`` at most) are broadcast: a pattern may
    # hold a third of all documents
    # seeded order inside each pattern; the row number is the row's own key
    # a numbering reads its input three times, and here is read twice itself: both are stored,
    # else the plan that the driver holds repeats the joins before it six times a pass
    offered = docs.join(F.broadcast(plan), F.col("__m").eqNullSafe(F.col("__pm"))).drop("__pm") \
        .withColumn("__draw", F.xxhash64(F.lit(seed), "__id", "__size"))
    offered = stored(offered, "mix-offered")
    numbered = stored(with_row_numbers(
        offered, [("__p", True), ("__draw", True), ("__id", True), ("__size", True)],
        "__rn", {"__through": "__size"}), "mix-order")
    first = F.col("__through") - F.col("__before") <= F.col("__left")
    chosen = numbered.filter(first & (F.col("__size") > 0)).select("__rn", "__p", "__size")
    rest = numbered.filter(~first & (F.col("__size") > 0)) \
        .select("__rn", "__p", "__size", "__left")
    for _ in range(fills):
        got = chosen.groupBy("__p").agg(F.sum("__size").alias("__got"))
        fits = rest.join(F.broadcast(got), "__p", "left") \
            .withColumn("__room", F.col("__left") - F.coalesce("__got", F.lit(0))) \
            .filter(F.col("__size") <= F.col("__room"))
        fits = stored(fits.select("__p", "__rn", "__size", "__room"), "mix-fits")
        running = stored(with_row_numbers(
            fits, [("__p", True), ("__rn", True)], "__at", {"__sum": "__size"}), "mix-running")
        heads = running.groupBy("__p").agg(F.min(F.col("__sum") - F.col("__size")).alias("__h"))
        more = stored(running.join(F.broadcast(heads), "__p")
                      .filter(F.col("__sum") - F.col("__h") <= F.col("__room"))
                      .select("__rn", "__p", "__size"), "mix-fill")
        rest = rest.join(more.select("__rn"), "__rn", "left_anti")
        chosen = stored(chosen.unionByName(more), "mix-chosen")
    # one more document where it brings the pattern nearer to its flow
    got = chosen.groupBy("__p").agg(F.sum("__size").alias("__got"))
    off = F.abs(F.col("__room") - F.col("__size"))
    last = rest.join(F.broadcast(got), "__p", "left") \
        .withColumn("__room", F.col("__left") - F.coalesce("__got", F.lit(0))) \
        .filter(off < F.col("__room")) \
        .groupBy("__p").agg(F.min_by(F.struct("__rn", "__size"), F.struct(off, "__rn")).alias("x")) \
        .select("x.__rn", "__p", "x.__size")
    extra = chosen.unionByName(last).select("__rn", F.lit(1).alias("__one"))
    copies = F.when(F.col("__size") > 0, F.col("__copies") + F.coalesce("__one", F.lit(0))) \
        .otherwise(0)
    return numbered.join(extra, "__rn", "left").select(
        F.col("__id").alias(id_col),
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("__m").alias("sources"), F.col("__size").alias("size"),
        copies.cast("int").alias("copies"),
        (F.col("__size") * copies).cast("long").alias("taken"))


def source_targets(mixed: DataFrame, max_copies: int = 3, max_sources: int = 100_000) -> DataFrame:
    """(source, source_size, target) of a mix whose documents have one source each."""
    spark = mixed.sparkSession
    rows = mixed.groupBy(F.col("sources")[0].alias("source")) \
        .agg(F.sum("size").alias("n")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than max_sources={max_sources} sources")
    sizes = {r["source"]: int(r["n"]) for r in rows}
    targets = capped_targets(sizes, cyclic_weights(sizes), sum(sizes.values()), max_copies)
    return stored(spark.createDataFrame(
        [(s, sizes[s], float(targets[s])) for s in source_order(sizes)],
        "source string, source_size long, target double"), "mix-targets")


def mix_documents(df: DataFrame) -> DataFrame:
    """The mix of the documents table: one source each, sizes in words."""
    mixed = stored(mix_sources(df, F.array("source"), word_count(F.col("text"))), "mixed")
    t = source_targets(mixed).withColumnRenamed("source", "__s")
    return mixed.join(t, F.col("sources")[0].eqNullSafe(F.col("__s"))).select(
        "doc_id", "size", "source_size", "target", "taken")
