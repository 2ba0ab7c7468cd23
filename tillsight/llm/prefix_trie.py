"""Prefix trie of conversations from range minima over sorted prefixes.

A node is a distinct sequence of first d turns; its members are the conversations that
start with it.  Sorted by their turns, the members of a node are neighbours, and lcp[j], the
number of turns that the j-th conversation shares with the one before it, says how far a node
reaches: position j belongs to the node (i, d) if no lcp between i and j is below d.

1. *Sort* (:func:`sorted_blocks`): turns become 16-byte digests, a conversation one row of
   them; rows are range-partitioned by (digests, conv_id), so copies spread over
   partitions, and cut into blocks of ``BLOCK`` rows or ``BLOCK_BYTES`` of digests.
2. *Sparse tables* (:class:`RangeMin`): every block has one over its lcps and its ids;
   a second level of one entry a block (some numbers, see :class:`Blocks`) is sent
   to all tasks.
3. *Extents* (:func:`trie`): each candidate prefix (position, depth) searches its left and its
   right extent independently by binary descent in the tables, in its block and, past its
   end, over the blocks.  Where it ends inside another block, what that block's first or last
   rows add is joined (:func:`block_edges`); at a block's edge only prefixes that both
   neighbours share can reach over it, so these are few.
4. *Sums*: members, leaves and shared bytes of a node are differences of running sums over its
   extent: a leaf ends at j if lcp[j + 1] < len[j], and the bytes its subtree saves are
   what each member shares with the one before it, less the bytes above the node.
5. *Digests*: copies are neighbours; a run's ids are joined block by block, and the pieces of
   a run that spans blocks stream through one SHA-256 (:func:`run_digests`).

No stack, no group collected: a block is bounded, a conversation takes 24 bytes a turn
(its texts are never gathered), the second level grows with the number of blocks.

Defined cases: null role or text counts as empty; turns are ordered by ``turn`` (null first),
equal ones by their digest, and repeated rows are repeated turns; rows without a conv_id
belong to no conversation; empty tables give no nodes; only the four named columns are
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import ship, stored

BLOCK = 16_384
BLOCK_BYTES = 8 << 20
#: Candidates searched at once.
SLICE = 1 << 17
#: Bytes of a turn's digest (128 bits of SHA-256 over its role and text).
DIGEST = 16
EMPTY = hashlib.sha256(b"").hexdigest()
_BIG = np.iinfo(np.int64).max


class RangeMin:
    """Minima of all runs of 2**k values: range minima, and extents by binary descent."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.levels = [np.asarray(values, np.int64)]
        while (1 << len(self.levels)) <= self.n:
            half = 1 << (len(self.levels) - 1)
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of values[a:b] for each pair (the largest number where empty)."""
        out = np.full(len(a), _BIG, np.int64)
        size = b - a
        for k, level in enumerate(self.levels):
            at = np.flatnonzero((size >> k) == 1)
            out[at] = np.minimum(level[a[at]], level[b[at] - (1 << k)])
        return out

    def right(self, at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The first position from ``at`` on whose value is below d (n if none)."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            inside = at < len(level)
            ok = np.zeros(len(at), bool)
            ok[inside] = level[at[inside]] >= d[inside]
            at[ok] += 1 << k
        return at

    def left(self, at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The last position up to ``at`` whose value is below d (-1 if none)."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = at - (1 << k) + 1
            inside = start >= 0
            ok = np.zeros(len(at), bool)
            ok[inside] = self.levels[k][start[inside]] >= d[inside]
            at[ok] -= 1 << k
        return at


# -- sequences -------------------------------------------------------------------------

def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, as (digest, bytes of the text)."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    # the length makes the pair (role, text) readable from the digested string
    digest = F.sha2(F.concat_ws(":", F.octet_length(who), who, what), 256)
    row = F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"),
                   F.substring(digest, 1, 2 * DIGEST).alias("digest"),
                   F.octet_length(what).cast("long").alias("bytes"))
    return turns.filter(F.col(conv).isNotNull()) \
        .groupBy(F.col(conv).cast("long").alias("conv_id")) \
        .agg(F.array_sort(F.collect_list(row)).alias("t")) \
        .select("conv_id", F.transform("t", lambda t: F.struct(
            t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def regrafted(seqs: DataFrame, every: int = 5, span: int = 9) -> DataFrame:
    """Conversation c with its first h turns replaced by those of c - c % ``every``;
    h = crc32(decimal c) % ``span``."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string")) % span).cast("int")
    heads = seqs.filter(c % every == 0).select(
        c.alias("base"), F.slice("turns", 1, span - 1).alias("head"))
    own = F.slice(F.col("turns"), h + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.slice(F.coalesce(F.col("head"), F.slice("turns", 1, 0)), F.lit(1), h)
    return seqs.join(heads, c - c % every == F.col("base"), "left") \
        .select("conv_id", F.concat(head, own).alias("turns"))


# -- blocks ----------------------------------------------------------------------------

_BLOCKS = ("part int, seq int, convs array<long>, lens array<int>, lcps array<int>, "
           "bytes array<long>, first binary, last binary")


def _common(a: bytes, b: bytes) -> int:
    """Number of digests that two keys share at their start."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    apart = np.flatnonzero(x != y)
    return (int(apart[0]) if len(apart) else n) // DIGEST


def _cut(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        convs, lens, lcps, sizes, first, last, held = [], [], [], [], b"", b"", 0

        def block() -> pa.RecordBatch:
            return pa.record_batch({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "convs": pa.array([convs], pa.list_(pa.int64())),
                "lens": pa.array([lens], pa.list_(pa.int32())),
                "lcps": pa.array([lcps], pa.list_(pa.int32())),
                "bytes": pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                "first": pa.array([first], pa.binary()), "last": pa.array([last], pa.binary())})

        for batch in batches:
            for conv, key, size in zip(*batch.columns):
                key = key.as_py()
                if convs and (len(convs) >= rows or held >= BLOCK_BYTES):
                    yield block()
                    convs, lens, lcps, sizes, held, seq = [], [], [], [], 0, seq + 1
                if not convs:
                    first = key
                # the first lcp of a block is known when blocks are in order
                lcps.append(_common(last, key) if convs else 0)
                convs.append(conv.as_py())
                lens.append(len(key) // DIGEST)
                sizes.append(size.values.to_numpy(zero_copy_only=False))
                last, held = key, held + len(key)
        if convs:
            yield block()
    return run


def sorted_blocks(seqs: DataFrame, rows: int = BLOCK) -> DataFrame:
    """Conversations sorted by (digests, conv_id), a row a block."""
    keyed = seqs.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
        .alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))
    return keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id") \
        .mapInArrow(_cut(rows), _BLOCKS)


@dataclass(frozen=True)
class Blocks:
    """The second level: one entry a block, in order."""
    lcp: np.ndarray      # lcp of the block's first row (-1 for the very first)
    least: np.ndarray    # smallest lcp of the block
    conv: np.ndarray     # smallest id of the block
    leaves: np.ndarray   # running sums before the block, and the total
    shared: np.ndarray
    start: np.ndarray    # position of the first row, and the number of rows
    owner: np.ndarray    # block in which the run of copies at the block's start begins


def _edge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(at, -1 if last is None else _common(last, first))
                for at, last, first in zip(*(c.to_pylist() for c in batch.columns))]
        yield _table(rows, [("at", pa.int64()), ("lcp", pa.int32())])


class Block:
    """A block's rows with what its neighbours determine filled in."""

    def __init__(self, convs, lens, lcps, sizes, lcp: int, next_lcp: int):
        self.convs, self.lens = np.asarray(convs, np.int64), np.asarray(lens, np.int64)
        self.lcps = np.asarray(lcps, np.int64).copy()
        self.lcps[0] = lcp
        self.n = len(self.convs)
        # bytes of the turns before each turn, over all rows, and where rows begin
        self.before = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])
        self.begin = np.concatenate([[0], np.cumsum(self.lens)])[:-1]
        following = np.append(self.lcps[1:], next_lcp)
        self.leaf = (following < self.lens).astype(np.int64)
        self.shared = self.upto(np.arange(self.n), np.maximum(self.lcps, 0))
        # what starts with all of a row and sorts before it can only be a copy
        self.copy = self.lcps == self.lens

    def upto(self, row: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Bytes of the first d turns of each row."""
        return self.before[self.begin[row] + d] - self.before[self.begin[row]]


def _rows(batch: pa.RecordBatch, edges: np.ndarray) -> Iterator[tuple[int, Block]]:
    for i in range(batch.num_rows):
        at = batch.column("at")[i].as_py()
        cols = [batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                for c in ("convs", "lens", "lcps", "bytes")]
        nxt = int(edges[at + 1]) if at + 1 < len(edges) else -1
        yield at, Block(*cols, int(edges[at]), nxt)


def _sql(schema: list[tuple[str, pa.DataType]]) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean"}
    return ", ".join(f"{n} {names[t]}" for n, t in schema)


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(cols, schema)],
                           [n for n, _ in schema])


_SCALARS = [("at", pa.int64()), ("least", pa.int64()), ("conv", pa.int64()),
            ("leaves", pa.int64()), ("shared", pa.int64()), ("n", pa.int64()),
            ("len_first", pa.int64()), ("single", pa.bool_())]


def _scalars(edges: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _table([(at, int(b.lcps.min()), int(b.convs.min()), int(b.leaf.sum()),
                           int(b.shared.sum()), b.n, int(b.lens[0]), bool(b.copy[1:].all()))
                          for at, b in _rows(batch, edges)], _SCALARS)
    return run


def second_level(blocks: DataFrame) -> Blocks:
    """Some numbers a block, gathered: at least ``BLOCK`` rows or ``BLOCK_BYTES`` stand
    behind each, apart from one block a partition."""
    last = blocks.select((F.col("at") + 1).alias("at"), "last")
    edge = blocks.join(last.withColumnRenamed("last", "before"), "at", "left") \
        .select("at", "before", "first").mapInArrow(_edge, "at long, lcp int")
    lcp = edge.orderBy("at").toArrow()["lcp"].to_numpy().astype(np.int64)
    s = blocks.mapInArrow(_scalars(lcp), _sql(_SCALARS)).orderBy("at").toArrow()
    s = {c: s[c].to_numpy() for c in s.column_names}

    def running(x) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    goes_on = lcp == s["len_first"]
    # the run at a block's end begins in the block itself, unless all of it goes on
    begins = np.maximum.accumulate(np.where(goes_on & s["single"], 0, np.arange(len(lcp))))
    owner = np.where(goes_on, np.append(0, begins[:-1]), np.arange(len(lcp)))
    return Blocks(lcp, s["least"], s["conv"], running(s["leaves"]), running(s["shared"]),
                  running(s["n"]), owner)


# -- extents ---------------------------------------------------------------------------

_NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent", pa.int64()),
         ("first_child", pa.bool_()), ("n_convs", pa.int64()), ("n_leaves", pa.int64()),
         ("saved", pa.int64()), ("above", pa.int64()), ("has_own_child", pa.bool_()),
         ("ends_sha256", pa.string()), ("run", pa.int64()),
         ("right_at", pa.int64()), ("right_d", pa.int64()),
         ("up_left_at", pa.int64()), ("up_right_at", pa.int64()), ("up_d", pa.int64())]


def _extents(level: Blocks):
    """Nodes of a block: everything its own rows and the second level tell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over_lcp, over_conv = RangeMin(level.least), RangeMin(level.conv)
        for batch in batches:
            for at, b in _rows(batch, level.lcp):
                yield from _block_nodes(at, b, level, over_lcp, over_conv)
    return run


def _block_nodes(at: int, b: Block, level: Blocks, over_lcp: RangeMin,
                 over_conv: RangeMin) -> Iterator[pa.RecordBatch]:
    lcps, convs = RangeMin(b.lcps), RangeMin(b.convs)
    leaves = np.concatenate([[0], np.cumsum(b.leaf)])
    shared = np.concatenate([[0], np.cumsum(b.shared)])
    blocks = len(level.lcp)

    def extent(i: np.ndarray, d: np.ndarray):
        """Rows [l, r) of this block, and where the extent ends beyond it: the block whose
        last (first) rows belong to it, or none."""
        l, r = lcps.left(i, d), lcps.right(i + 1, d)
        beyond_l = np.where(l < 0, over_lcp.left(np.full(len(i), at - 1), d), -1)
        past = r >= b.n
        beyond_r = np.full(len(i), -1)
        beyond_r[past] = over_lcp.right(np.full(past.sum(), at + 1), d[past])
        return np.maximum(l, 0), r, beyond_l, beyond_r

    def smallest(l, r, beyond_l, beyond_r):
        low = convs.least(l, r)
        left, right = beyond_l >= 0, beyond_r >= 0
        low[left] = np.minimum(low[left], over_conv.least(
            beyond_l[left] + 1, np.full(left.sum(), at)))
        low[right] = np.minimum(low[right], over_conv.least(
            np.full(right.sum(), at + 1), beyond_r[right]))
        return low

    # row i brings the nodes of depths lcp + 1 .. len, the very first row also the root
    fresh = b.lens - b.lcps
    # a slice of rows at a time bounds the candidates held
    ends = np.cumsum(fresh)
    cuts = np.searchsorted(ends, np.arange(0, ends[-1], SLICE), "right")
    cuts = np.unique(np.append(cuts, b.n))
    for a, z in zip(np.append(0, cuts[:-1]), cuts):
        rows = np.repeat(np.arange(a, z), fresh[a:z])
        if not len(rows):
            continue
        step = np.arange(len(rows)) - np.repeat(np.cumsum(fresh[a:z]) - fresh[a:z], fresh[a:z])
        d = b.lcps[rows] + 1 + step
        l, r, beyond_l, beyond_r = extent(rows, d)
        # a node belongs to its first row
        mine = (l == rows) & (beyond_l < 0)
        rows, d, step, l, r, beyond_r = (x[mine] for x in (rows, d, step, l, r, beyond_r))
        none = np.full(len(rows), -1)
        conv = smallest(l, r, none, beyond_r)
        n, leaf, save = r - l, leaves[r] - leaves[l], shared[r] - shared[l + 1]
        right = beyond_r >= 0
        # whole blocks between this one and the one in which the extent ends
        whole = np.where(right, beyond_r, at + 1)
        n = n + level.start[whole] - level.start[at + 1]
        leaf = leaf + level.leaves[whole] - level.leaves[at + 1]
        save = save + level.shared[whole] - level.shared[at + 1]
        pending = right & (beyond_r < blocks)
        pending[pending] = level.lcp[beyond_r[pending]] >= d[pending]
        # the parent: the same row's node, or for its first one a search of both extents
        up = np.flatnonzero((step == 0) & (d > 0))
        up_l, up_r, up_bl, up_br = extent(rows[up], d[up] - 1)
        low = smallest(up_l, up_r, up_bl, up_br)
        parent = np.append(-1, conv[:-1])
        parent[up] = low
        up_left, up_right = none.copy(), none.copy()
        up_left[up] = up_bl
        ok = (up_br >= 0) & (up_br < blocks)
        ok[ok] = level.lcp[up_br[ok]] >= d[up][ok] - 1
        up_right[up[ok]] = up_br[ok]
        # a parent that is the row's own node and reaches over the edge is completed with it
        own = np.flatnonzero((step > 0) & np.append(False, pending[:-1]))
        up_right[own] = beyond_r[own - 1]
        digests, run_of = _ends(at, b, rows, d, level)
        yield pa.record_batch([pa.array(c, t, mask=m) for c, m, (_, t) in zip(
            (conv, d, parent, step == 0, n, leaf, save, b.upto(rows, np.maximum(d - 1, 0)),
             d < b.lens[rows], digests, run_of, beyond_r, d, up_left, up_right, d - 1),
            (None, None, d == 0, None, None, None, None, None, None, None, run_of < 0,
             ~pending, None, up_left < 0, up_right < 0, None), _NODE)], [n for n, _ in _NODE])


def _ends(at: int, b: Block, rows: np.ndarray, d: np.ndarray, level: Blocks):
    """SHA-256 of the ids of the members with d turns; for a run of copies that goes on in
    the next block the run's name (its first block) instead."""
    out, run_of = np.full(len(rows), EMPTY, object), np.full(len(rows), -1)
    starts = np.append(np.flatnonzero(~b.copy), b.n)
    following = at + 1 < len(level.owner) and level.owner[at + 1] != at + 1
    for k in np.flatnonzero(d == b.lens[rows]).tolist():
        i = rows[k]
        end = starts[np.searchsorted(starts, i, "right")]
        if end == b.n and following:
            run_of[k] = level.owner[at + 1]
        else:
            out[k] = hashlib.sha256(",".join(map(str, b.convs[i:end].tolist())).encode()).hexdigest()
    return out, run_of


# -- over the edges --------------------------------------------------------------------

_EDGES = [("at", pa.int64()), ("d", pa.int64()), ("side", pa.string()), ("n", pa.int64()),
          ("conv", pa.int64()), ("leaves", pa.int64()), ("shared", pa.int64())]


def _edges(level: Blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, b in _rows(batch, level.lcp):
                least = int(b.lcps.min())
                low = np.minimum.accumulate(b.convs)
                lcps = RangeMin(b.lcps)
                # depths that enter the block and end inside it
                d = np.arange(max(least + 1, 0), int(b.lcps[0]) + 1)
                k = lcps.right(np.zeros(len(d), np.int64), d)
                rows += zip([at] * len(d), d.tolist(), ["first"] * len(d), k.tolist(),
                            low[k - 1].tolist(), np.cumsum(b.leaf)[k - 1].tolist(),
                            np.cumsum(b.shared)[k - 1].tolist())
                # depths that leave it and begin inside it
                out = int(level.lcp[at + 1]) if at + 1 < len(level.lcp) else -1
                d = np.arange(max(least + 1, 0), out + 1)
                j = lcps.left(np.full(len(d), b.n - 1), d)
                low = np.minimum.accumulate(b.convs[::-1])[::-1]
                rows += zip([at] * len(d), d.tolist(), ["last"] * len(d), (b.n - j).tolist(),
                            low[j].tolist(), [0] * len(d), [0] * len(d))
            yield _table(rows, _EDGES)
    return run


def block_edges(blocks: DataFrame, level: Blocks) -> DataFrame:
    """What a block's first rows add to an extent that ends among them, and its last rows to
    one that begins among them, for each depth for which that happens."""
    return blocks.mapInArrow(_edges(level), _sql(_EDGES))


def _pieces(level: Blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, b in _rows(batch, level.lcp):
                starts = np.append(np.flatnonzero(~b.copy), b.n)
                if level.owner[at] != at:
                    rows.append((int(level.owner[at]), at, b.convs[:starts[0]]))
                if at + 1 < len(level.owner) and level.owner[at + 1] == at:
                    rows.append((at, at, b.convs[starts[-2]:]))
            yield _table([(r, k, ",".join(map(str, ids.tolist()))) for r, k, ids in rows],
                         [("run", pa.int64()), ("at", pa.int64()), ("ids", pa.string())])
    return run


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, digest = None, None
    for batch in batches:
        done = []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            if name != run:
                if digest is not None:
                    done.append((run, digest.hexdigest()))
                run, digest = name, hashlib.sha256(ids.as_py().encode())
            else:
                digest.update(b"," + ids.as_py().encode())
        yield _table(done, [("run", pa.int64()), ("run_sha256", pa.string())])
    if digest is not None:
        yield _table([(run, digest.hexdigest())],
                     [("run", pa.int64()), ("run_sha256", pa.string())])


def run_digests(blocks: DataFrame, level: Blocks) -> DataFrame:
    """(run, run_sha256) of the runs of copies that span blocks: one row a block and run goes
    to the run's task, which digests them in order without holding them."""
    pieces = blocks.mapInArrow(_pieces(level), "run long, at long, ids string")
    return pieces.repartition("run").sortWithinPartitions("run", "at").select("run", "ids") \
        .mapInArrow(_stream, "run long, run_sha256 string")


def trie(seqs: DataFrame, rows: int = BLOCK) -> DataFrame:
    """Every node of the prefix trie of ``seqs`` (conv_id, turns); ``rows`` bounds a block."""
    ship(seqs.sparkSession)
    blocks = stored(sorted_blocks(seqs, rows), "trie-blocks")
    # one row a block: small numbers only
    order = Window.orderBy("part", "seq")
    named = blocks.select("part", "seq") \
        .withColumn("at", (F.row_number().over(order) - 1).cast("long"))
    blocks = stored(blocks.join(named, ["part", "seq"]).drop("part", "seq"), "trie-ordered")
    level = second_level(blocks)
    nodes = stored(blocks.mapInArrow(_extents(level), _sql(_NODE)), "trie-nodes")
    edges = stored(block_edges(blocks, level), "trie-reach")

    def side(which: str, at: str, d: str, *names: str) -> DataFrame:
        return edges.filter(F.col("side") == which).select(
            F.col("at").alias(at), F.col("d").alias(d),
            *[F.col(n).alias(f"{at}_{n}") for n in names])

    crossing = F.coalesce("right_at", "up_left_at", "up_right_at").isNotNull()
    met = nodes.filter(crossing) \
        .join(side("first", "right_at", "right_d", "n", "conv", "leaves", "shared"),
              ["right_at", "right_d"], "left") \
        .join(side("last", "up_left_at", "up_d", "conv"), ["up_left_at", "up_d"], "left") \
        .join(side("first", "up_right_at", "up_d", "conv"), ["up_right_at", "up_d"], "left")

    def plus(name: str) -> F.Column:
        return F.coalesce(F.col(f"right_at_{name}"), F.lit(0))
    met = met.withColumns({
        "conv_id": F.least("conv_id", "right_at_conv"),
        "parent": F.least("parent", "up_left_at_conv", "up_right_at_conv"),
        "n_convs": F.col("n_convs") + plus("n"), "n_leaves": F.col("n_leaves") + plus("leaves"),
        "saved": F.col("saved") + plus("shared")}).select(*nodes.columns)
    nodes = nodes.filter(~crossing).union(met)

    kids = nodes.filter("first_child and parent is not null") \
        .groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count(F.lit(1)).alias("kids"))
    spans = run_digests(blocks, level)
    return nodes.join(kids, ["conv_id", "depth"], "left").join(spans, "run", "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        (F.coalesce("kids", F.lit(0)) + F.col("has_own_child").cast("long")).alias("n_children"),
        "n_leaves", (F.col("saved") - (F.col("n_convs") - 1) * F.col("above"))
        .alias("saved_tokens"), F.coalesce("run_sha256", "ends_sha256").alias("ends_sha256"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations with the first turns of every fifth one grafted on."""
    return trie(regrafted(sequences(turns)))
