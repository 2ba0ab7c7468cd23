"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its distinct word shingles.

1. *Signatures*: ``CHUNKS * WIDTH`` min-hashes of the set, ``b = 16`` bits of each.
   Documents with the same set (128-bit digest and size) are one class from here on.
2. *Multi-index*: the signature is cut into ``CHUNKS`` chunks of ``WIDTH`` symbols.
   If two signatures differ in at most ``2 * CHUNKS - 1`` symbols, some chunk differs in
   at most one (pigeonhole).  Every chunk is indexed ``WIDTH`` times, each time with one
   symbol left out, so each such pair meets under a common key: all pairs within the
   signature distance are found.  At similarity 0.8 that distance covers 99.6 % of pairs;
   pairs beyond it usually meet as well (a pair at 0.8 misses all keys with probability
   3e-6, at 0.85 with 4e-9).
3. *Links*: under a key, every class is compared with the key's smallest class (its hub),
   not with all.  Compared pairs are confirmed on full shingle sets (``array_intersect``),
   and confirmed links give components.  A link that is still missing has an end that is
   not in the component of a hub both ends met; :func:`pairs_by_difference` finds all such
   links from the elements in which classes differ from the hub, without enumerating the
   pairs of the group.  Links inside one component need no comparison.
4. ``component_id`` is the smallest id reachable; exact copies follow their class.

Large groups: copies collapse before keys are made; a key's classes are never gathered
in a row or task group (minimum and maximum are partial aggregates, joins are
sort-merge joins whose hot keys AQE splits).

Defined cases: null or blank text has the empty set, linked with nothing; fewer words
than a shingle: the whole sequence is the only shingle; a null id is kept, with a null
component; rows with equal ids count as one document (linked if one of its texts is);
empty tables give no rows; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import mix64, ngram_hashes, ship, stored, word_hashes
from tillsight.llm.graph import connected_components

CHUNKS, WIDTH = 12, 6
SYMBOLS = CHUNKS * WIDTH
#: Pairs that meet, but differ in more symbols than this, are not confirmed (similarity
#: 0.8 differs in 14.4 symbols on average, with a deviation of 3.4).
FAR = 36
_ODD = np.random.default_rng(9).integers(0, 2**63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    k = min(n, len(tokens))
    return np.unique(ngram_hashes(word_hashes(tokens), k) + np.uint64(k))


def signature(shingles: np.ndarray) -> bytes:
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = mix64(shingles[at:at + 2048])
        np.minimum(low, (_ODD[:, None] * part).min(1), out=low)
    return ((low >> np.uint64(16)) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, h1, h2, sig = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), n)
                size.append(len(s))
                h1.append(int(mix64(s).sum(dtype=np.uint64).astype(np.int64)))
                h2.append(int(mix64(s ^ np.uint64(0x9E3779B97F4A7C15))
                              .sum(dtype=np.uint64).astype(np.int64)))
                sig.append(signature(s) if len(s) else None)
            yield pa.record_batch({
                "id": batch.column(0), "n": pa.array(size, pa.int64()),
                "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()),
                "sig": pa.array(sig, pa.binary())})
    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), n).view(np.int64) for t in part.column(1)]
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.record_batch({
                    "id": part.column(0),
                    "shingles": pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.concatenate(sets), pa.int64()))})
    return run


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SYMBOLS)


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """One row per signature: the keys of all chunks with one symbol left out."""
    at = np.arange(SYMBOLS, dtype=np.uint64) << np.uint64(20)
    mixed = mix64(symbols.astype(np.uint64) + at + np.uint64(1)).reshape(-1, CHUNKS, WIDTH)
    without = mixed.sum(2, keepdims=True, dtype=np.uint64) - mixed
    return mix64(without.reshape(-1, SYMBOLS) + at).view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = chunk_keys(_symbols(batch.column(1)))
            cls = np.repeat(batch.column(0).to_numpy(), SYMBOLS)
            yield pa.record_batch({"key": pa.array(keys.ravel()), "cls": pa.array(cls)})


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            differ = (_symbols(batch.column(2)) != _symbols(batch.column(3))).sum(1)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]) \
                .filter(pa.array(differ <= FAR))


def _whole(sets: DataFrame, name: str) -> DataFrame:
    return sets.select(F.col("id").alias(name), F.col("shingles").alias(f"s_{name}"))


def confirm(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have ``100 * common >= percent * union``."""
    side = lambda x: classes.select(
        F.col("cls").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n").alias(f"n_{x}"))
    close = pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) \
        .select("a", "b", "sig_a", "sig_b").mapInArrow(_near, "a long, b long")
    close = stored(close.distinct(), "close-pairs")
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    return stored(close.join(_whole(sets, "a"), "a").join(_whole(sets, "b"), "b")
                  .filter(100 * common >= percent * union).select("a", "b").distinct(), "links")


def pairs_by_difference(hubs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may be linked although neither is linked to their hub.

    ``hubs``: x, c (component of x), b (its hub), h (component of the hub).  For a class
    x, let d(x) be the elements in which it differs from the hub.  Sizes n, and
    r = (100 - percent) / (100 + percent): a link of x and y is a symmetric difference of
    at most r * (n_x + n_y) = |d(x)| + |d(y)| - 2 * |d(x) & d(y)|.  As x is not linked to
    the hub, |d(x)| > r * (n_x + n_hub), so |d(x) & d(y)| > (|d(y)| + r * (n_hub - n_y)) / 2,
    and it is also at least |d(x)| - n_x * (100 - percent) / percent.  By the prefix-filter
    principle the pair shares one of the first elements, rarest first, of both differences;
    only such pairs are returned, which is far from all pairs of a large group."""
    up, down = 100 + percent, 100 - percent
    stray = hubs.filter("c <> h").select("b").distinct()
    s_x, s_b = F.col("s_x"), F.col("s_b")
    differ = F.concat(F.array_except(s_x, s_b), F.array_except(s_b, s_x))
    rows = hubs.join(stray, "b").join(_whole(sets, "x"), "x").join(_whole(sets, "b"), "b") \
        .withColumn("d", differ).withColumn("size", F.size("d"))
    least_index = F.floor((up * F.col("size") + down * (F.size(s_b) - F.size(s_x))) / (2 * up))
    least_probe = F.col("size") - F.floor(down * F.size(s_x) / percent) - 1
    rows = rows.select(
        "b", "x", "c", (F.col("c") != F.col("h")).alias("stray"), "d", "size",
        F.size(s_x).alias("n"),
        (F.col("size") - F.greatest(F.lit(0), least_index)).alias("as_index"),
        (F.col("size") - F.greatest(F.lit(0), least_probe)).alias("as_probe"))
    rows = stored(rows.select("b", "x", "c", "stray", "size", "n", "as_index", "as_probe",
                              F.explode("d").alias("el")), "differences")
    often = rows.groupBy("b", "el").agg(F.count(F.lit(1)).alias("often"),
                                        F.bool_or("stray").alias("probed")) \
        .filter("often > 1 and probed").select("b", "el", "often")
    # an element of one class only is first in the order, and meets nothing
    place = Window.partitionBy("b", "x").orderBy(F.coalesce("often", F.lit(1)), "el")
    ranked = stored(rows.join(often, ["b", "el"], "left")
                    .withColumn("place", F.row_number().over(place))
                    .filter("often is not null and place <= greatest(as_index, as_probe)"),
                    "prefixes")
    side = lambda k: [F.col(c).alias(f"{k}_{c}") for c in ("x", "c", "size", "n", "place")]
    probe = ranked.filter("stray and place <= as_probe").select("b", "el", *side("p"))
    index = ranked.filter("place <= as_index").select("b", "el", *side("q"))
    # both sizes known: the common elements a link needs, and so the places a first one has
    needs = up * (F.col("p_size") + F.col("q_size")) - down * (F.col("p_n") + F.col("q_n"))
    met = probe.alias("p").join(index.alias("q"), (
        (F.col("p.b") == F.col("q.b")) & (F.col("p.el") == F.col("q.el"))
        & (F.col("p_c") != F.col("q_c"))
        & (100 * F.least("p_n", "q_n") >= percent * F.greatest("p_n", "q_n"))
        & (needs <= 2 * up * (F.col("p_size") + 1 - F.col("p_place")))
        & (needs <= 2 * up * (F.col("q_size") + 1 - F.col("q_place")))))
    return met.select(F.least("p_x", "q_x").alias("a"),
                      F.greatest("p_x", "q_x").alias("b")).distinct()


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``df``."""
    ship(df.sparkSession)
    texts = df.select(F.col(id_col).cast("long").alias("id"),
                      F.col(text).cast("binary").alias("text"))
    docs = stored(texts.mapInArrow(
        _signatures(shingle), "id long, n long, h1 long, h2 long, sig binary"), "signatures")
    linkable = docs.filter("n > 0 and id is not null")
    classes = stored(linkable.groupBy("h1", "h2", "n")
                     .agg(F.min("id").alias("cls"), F.min("sig").alias("sig")), "classes")
    keys = classes.select("cls", "sig").mapInArrow(_keys, "key long, cls long")
    shared = keys.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")) \
        .filter("lo < hi").select("key", "lo")
    members = stored(keys.join(shared, "key"), "members")
    ids = members.select(F.col("cls").alias("id")).distinct()
    sets = stored(texts.join(ids, "id").select("id", "text")
                  .mapInArrow(_sets(shingle), "id long, shingles array<long>"), "sets")

    tried = stored(members.filter("lo < cls").select(
        F.col("lo").alias("a"), F.col("cls").alias("b")).distinct(), "stars")
    links = confirm(tried, classes, sets, percent)
    comp = stored(connected_components(links), "components")

    # classes that met a hub under some key, and are not in its component
    of = lambda x, c: comp.select(F.col("node").alias(x), F.col("component").alias(c))
    hubs = tried.select(F.col("b").alias("x"), F.col("a").alias("b")) \
        .join(of("x", "c"), "x", "left").join(of("b", "h"), "b", "left") \
        .select("x", "b", F.coalesce("c", "x").alias("c"), F.coalesce("h", "b").alias("h"))
    across = pairs_by_difference(stored(hubs, "hubs"), sets, percent) \
        .join(tried, ["a", "b"], "left_anti")
    more = confirm(stored(across, "across"), classes, sets, percent)
    comp = stored(connected_components(links.union(more)), "components")

    of_class = classes.join(comp, F.col("cls") == F.col("node"), "left").select(
        "h1", "h2", F.col("n").alias("size"), F.coalesce("component", "cls").alias("component"))
    joined = linkable.select("id", "n", "h1", "h2").join(
        of_class.withColumnRenamed("size", "n"), ["h1", "h2", "n"])
    placed = joined.select("id", "n", "component").union(
        docs.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component")))
    return placed.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
