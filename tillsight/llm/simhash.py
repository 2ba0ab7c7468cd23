"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has 64 bits; bit i is 1 if more than half of its shingles' hashes
have it set (shingles of ``shingle`` words, repeats included; lower-cased A-Z).  Two
fingerprints are linked if at most ``distance`` bits differ.

1. *Classes*: rows with one fingerprint are one class from here on.
2. *Segments*: the 64 bits are cut into three segments, or two where so many classes exist
   that longer ones are less work (:func:`segments`), so a table entry holds few classes at
   any size.  By the pigeonhole principle a linked pair differs in at most ``radius`` bits
   of some segment.
3. *Tables*: every class stands in each segment's table under its own value, and probes
   the table with all values of the Hamming ball of that radius around it.  What a probe
   meets is verified on all 64 bits inside the join.
4. *Large entries*: an entry of more than ``LARGE`` classes (a cloud of fingerprints that
   share a segment) would be compared in all pairs.  Its classes and all that probe it
   are linked through *midpoints* instead: two fingerprints at distance 4 or less have
   a value at distance 2 or less from both, so each is put under every value that near to
   it, and a value's classes are linked to the smallest of them (:func:`by_midpoints`).
   That is exact as well, and linear in the number of classes.
5. Links give components (:mod:`tillsight.llm.graph`); ``component_id`` is the smallest
   id of a component.

Defined cases: a text that is null or has no word has fingerprint zero, which is linked
like any other; fewer words than a shingle: the whole sequence is the only shingle.  Every
row is a node of its own: rows with equal ids or a null id are judged by their texts, and
a component whose rows all have null ids has a null ``component_id``.  Empty tables give no
rows; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import ship, stored
from tillsight.llm.graph import connected_components

BITS = 64
SEED = 42
#: Classes of a table entry up to which they are compared directly.  Above, midpoints cost
#: less (2,081 values a class at distance 4); both ways find the same components.
LARGE = 256
#: Bytes of a batch of shingle hashes unpacked into bits at once, over 64.
_BLOCK = 4096


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``n`` words, joined by one space."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    n = min(n, len(tokens))
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(tokens) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[n - 1:].tolist())),
                       np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """The SimHash as a signed 64-bit number (zero without hashes)."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at:at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py() or b"", n)) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], ["id", "fp"])
    return run


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` ones (signed for 64 bits)."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1)
             for bits in combinations(range(width), r)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def segments(classes: int, distance: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment for so many classes.

    The number m of segments is 2 or 3, whichever is less work a class: the probes and
    the classes these meet when values are spread evenly.  With r = distance // m, the
    first distance - m * r + 1 segments are searched to radius r and the others to r - 1:
    a pair that no segment catches differs in more than ``distance`` bits."""
    def layout(m: int) -> list[tuple[int, int, int]]:
        r, over = divmod(distance, m)
        widths = [BITS // m + (s < BITS % m) for s in range(m)]
        return [(sum(widths[:s]), widths[s], r if s <= over else r - 1) for s in range(m)]

    def work(m: int) -> float:
        return sum(sum(comb(w, k) for k in range(r + 1)) * (1 + classes / 2 ** w)
                   for _, w, r in layout(m) if r >= 0)
    return [s for s in layout(min(range(2, max(min(distance, 3), 2) + 1), key=work)) if s[2] >= 0]


def table_keys(classes: DataFrame, layout: list[tuple[int, int, int]]) -> DataFrame:
    """(key, fp): every class under its own value of each segment."""
    return classes.select("fp", F.explode(F.array(*[
        _key(s, F.col("fp"), shift, width) for s, (shift, width, _) in enumerate(layout)]))
        .alias("key"))


def probe_keys(classes: DataFrame, layout: list[tuple[int, int, int]]) -> DataFrame:
    """(key, fp): every class under all values of its segments' Hamming balls."""
    def near(s: int, shift: int, width: int, radius: int) -> F.Column:
        own = _key(s, F.col("fp"), shift, width)
        masks = F.array(*[F.lit(m).cast("long") for m in ball(width, radius)])
        return F.transform(masks, lambda m: own.bitwiseXOR(m))

    parts = [near(s, *segment) for s, segment in enumerate(layout)]
    return classes.select("fp", F.explode(F.concat(*parts)).alias("key"))


def _key(segment: int, fp: F.Column, shift: int, width: int) -> F.Column:
    value = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
    return value + F.lit(segment << 40)


def by_midpoints(cloud: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that connect what the cloud's links within ``distance`` connect.

    A linked pair has a value at distance // 2 or less (*near*) from one end and at
    (distance + 1) // 2 or less from the other: flip half of the differing bits.  A near
    class of a value and any other class of it are linked, so all classes of a value are
    linked to its smallest near one."""
    near, far = distance // 2, (distance + 1) // 2
    masks = F.array(*[F.lit(m).cast("long") for m in ball(BITS, far)])
    rows = cloud.select("fp", F.explode(masks).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), "fp",
        (F.bit_count("mask") <= near).alias("near"))
    least = rows.groupBy("value").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("least"),
                                      F.count(F.lit(1)).alias("held")).filter("held > 1")
    # a class's row became thousands, which the planner's estimate does not count: no broadcast
    return rows.hint("merge").join(least.select("value", "least"), "value") \
        .filter("fp <> least") \
        .select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def links(classes: DataFrame, count: int, distance: int, large: int = LARGE) -> DataFrame:
    """(a, b): links between classes that give the components of all links."""
    layout = segments(count, distance)
    tables, probes = table_keys(classes, layout), probe_keys(classes, layout)
    crowded = stored(tables.groupBy("key").agg(F.count(F.lit(1)).alias("held"))
                     .filter(F.col("held") > large).select("key"), "simhash-crowded")
    some = not crowded.isEmpty()
    if some:
        tables = tables.join(crowded, "key", "left_anti")
    # exploded on both sides, while the planner's estimate is that of the classes: no broadcast
    direct = tables.hint("merge").join(probes.withColumnRenamed("fp", "probe"), "key").filter(
        (F.col("fp") != F.col("probe"))
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("probe"))) <= distance)) \
        .select(F.least("fp", "probe").alias("a"), F.greatest("fp", "probe").alias("b")).distinct()
    if not some:
        return direct
    cloud = stored(probes.join(crowded, "key", "left_semi").select("fp").distinct(),
                   "simhash-cloud")
    return direct.union(by_midpoints(cloud, distance))


def simhash_groups(df: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id",
                   text: str = "text", large: int = LARGE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``df``."""
    ship(df.sparkSession)
    docs = stored(df.select(F.col(id_col).cast("long").alias("id"),
                            F.col(text).cast("binary").alias("text"))
                  .mapInArrow(_fingerprints(shingle), "id long, fp long"), "fingerprints")
    classes = stored(docs.groupBy("fp").agg(F.min("id").alias("id")), "simhash-classes")
    comp = stored(connected_components(
        links(classes, classes.count(), distance, large)), "simhash-components")
    # a component is named by a fingerprint; its id is the smallest one of its rows
    named = classes.join(comp, F.col("fp") == F.col("node"), "left") \
        .select("fp", "id", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = stored(named.join(least, "component").select("fp", "component_id"),
                      "simhash-named")
    return docs.join(of_class, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")
