"""Substring dedup: word windows that an earlier document has, found by FM-index shards.

A window is ``SPAN`` consecutive words.  A word goes if a window that covers it also
starts in a document with a smaller id.

Streaming every document through the index of every shard of documents would cost
documents x shards.  Here shards are cut by *content*: a window belongs to the shard of
its fingerprint, the smallest hash of the ``GRAM``-word sequences inside it, so all
occurrences of a window meet in one shard.  Consecutive windows of a document with one
fingerprint form a run (13 to 20 words).

1. Fingerprints are counted over all documents (partial counts per task); a fixed-size bit
   map of those in several documents spares the next scans most other runs.  It never
   decides: a false hit is only carried along, and no hit is missed.
2. Equal runs collapse to one sequence with its smallest document: a later document loses
   all windows of such a run.
3. Sequences that share a fingerprint, but differ, go to the FM-index of their shard
   (wavelet matrix over the BWT, :mod:`tillsight.llm.fm_index`), which streams them by
   backward search and reports, per window, the smallest document it occurs in.  The
   number of shards follows the volume.  A fingerprint whose sequences would outgrow a shard
   alone (``SHARD_WORDS`` words) is cut into single windows instead: equal ones are merged to
   their smallest document by partial counts per task, and that is joined back (an index of
   distinct windows of ``SPAN`` words finds no others), so no task holds more than two shards.
4. The windows found are merged per document and applied to its text.  Only texts in a
   bit map of affected ids are shuffled.

Words are compared by 64-bit hashes in fingerprints and runs, by 32-bit hashes inside a
shard (all 13 words of a window, next to an equal fingerprint).

Defined cases: null text has no words; a text shorter than a window loses nothing; a null
id loses nothing and takes nothing from others; rows with equal ids never take from one
another, and each loses only windows of its own text (:func:`~tillsight.llm.common.text_tag`);
empty tables give no rows; only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import mix64, ngram_hashes, ship, stored, text_tag, word_hashes
from tillsight.llm.fm_index import FMIndex

SPAN, GRAM = 13, 6
SHARD_WORDS = 400_000
BITS = 27  # of a bit map: 16 MB
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class BitMap:
    """A fixed-size set of hashes: no false negatives."""

    def __init__(self, hashes: DataFrame, column: str):
        place = F.shiftrightunsigned(column, 64 - BITS)
        rows = hashes.groupBy(F.shiftright(place, 6).alias("w")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - BITS}) "
                            "& 63 as int))")).alias("bits")).toArrow()
        self.bits = np.zeros(1 << (BITS - 6), np.uint64)
        self.bits[rows["w"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - BITS)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) > 0


class Runs:
    """Runs of windows with one fingerprint, in some documents' words."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]
        sizes = np.array([len(s) for s in split])
        self.h = word_hashes([w for s in split for w in s])
        doc = np.repeat(np.arange(len(texts)), sizes)
        first = np.cumsum(sizes) - sizes
        g = ngram_hashes(self.h, GRAM)
        reach, width = SPAN - GRAM + 1, 1
        while width < reach:
            k = min(width, reach - width)
            g = np.minimum(g[:-k], g[k:]) if len(g) > k else g[:0]
            width += k
        here = doc[:len(g)]
        whole = np.flatnonzero(here == doc[SPAN - 1:SPAN - 1 + len(g)])
        g, here = g[whole], here[whole]
        new = np.ones(len(whole), bool)
        new[1:] = (g[1:] != g[:-1]) | (here[1:] != here[:-1])
        at = np.flatnonzero(new)
        self.fingerprint, self.doc = g[at], here[at]
        self.begin = whole[at]  # in the words of all texts
        self.start = self.begin - first[self.doc]  # in the words of its text
        self.windows = np.diff(np.append(at, len(whole)))

    def sequence_hashes(self) -> np.ndarray:
        """64-bit hash of the words of each run, wherever it stands."""
        n = len(self.h)
        up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]))
        through = np.concatenate([[np.uint64(0)], np.cumsum(self.h * up[:-1], dtype=np.uint64)])
        end = self.begin + self.windows + SPAN - 1
        held = (through[end] - through[self.begin]) * down[self.begin]
        return mix64(held + self.windows.astype(np.uint64))


def _parts(batches: Iterator[pa.RecordBatch], limit: int = 1 << 21):
    """(ids and tags, Runs) of consecutive documents, about ``limit`` bytes each."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, tag, t in zip(batch.column("id").to_pylist(), batch.column("tag").to_pylist(),
                             batch.column("text"), strict=True):
            t = t.as_py() or b""
            ids.append((i, tag))
            texts.append(t)
            held += len(t)
            if held >= limit:
                yield np.array(ids, np.int64), Runs(texts)
                ids, texts, held = [], [], 0
        if ids:
            yield np.array(ids, np.int64), Runs(texts)


def _count_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, r in _parts(batches):
        order = np.lexsort((r.doc, r.fingerprint))
        f, d = r.fingerprint[order], r.doc[order]
        new_doc = np.ones(len(f), bool)
        new_doc[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
        f = f[new_doc]
        edge = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])[:len(f)])
        yield pa.record_batch({
            "f": pa.array(f[edge].view(np.int64)),
            "n": pa.array(np.minimum(np.diff(np.append(edge, len(f))), 2).astype(np.int32))})


def instance_hash(f, sequence, doc, start) -> np.ndarray:
    return mix64(mix64(mix64(f + sequence) + doc.astype(np.uint64)) + start.astype(np.uint64))


def _runs(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, r in _parts(batches):
            at = np.flatnonzero(shared.value.has(r.fingerprint))
            f, seq = r.fingerprint[at], r.sequence_hashes()[at]
            doc, tag, start = ids[r.doc[at], 0], ids[r.doc[at], 1], r.start[at]
            yield pa.record_batch({
                "f": pa.array(f.view(np.int64)), "seq": pa.array(seq.view(np.int64)),
                "id": pa.array(doc), "tag": pa.array(tag),
                "start": pa.array(start.astype(np.int32)),
                "windows": pa.array(r.windows[at].astype(np.int32)),
                "own": pa.array(instance_hash(f, seq, doc, start).view(np.int64))})
    return run


def _run_words(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, r in _parts(batches):
            seq = r.sequence_hashes()
            own = instance_hash(r.fingerprint, seq, ids[r.doc, 0], r.start)
            at = np.flatnonzero(shared.value.has(own))
            short = (r.h >> np.uint64(32)).astype("<u4")
            yield pa.record_batch({
                "own": pa.array(own[at].view(np.int64)),
                "words": pa.array([short[b:b + n + SPAN - 1].tobytes() for b, n in zip(
                    r.begin[at].tolist(), r.windows[at].tolist(), strict=True)], pa.binary())})
    return run


def _to_shards(shards: int):
    """Sequences with the shard of their fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column("f").to_numpy().view(np.uint64)
            yield pa.record_batch({
                "shard": pa.array((mix64(f) % np.uint64(shards)).astype(np.int32)),
                **{c: batch.column(c) for c in ("f", "seq", "id", "words")}})
    return run


def _to_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of each sequence."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            rows = [(i, k, w[4 * k:4 * (k + SPAN)])
                    for i, w in enumerate(part.column("words").to_pylist())
                    for k in range(len(w) // 4 - SPAN + 1)]
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.record_batch({
                **{c: part.column(c).take(take) for c in ("f", "seq", "id")},
                "offset": pa.array([r[1] for r in rows], pa.int32()),
                "words": pa.array([r[2] for r in rows], pa.binary())})


def search_shard(table: pa.Table) -> pa.Table:
    """Windows of a shard's sequences that occur in a document before their own."""
    table = table.combine_chunks()
    parts = table["words"].to_pylist()
    flat = np.frombuffer(b"".join(parts), "<u4")
    lengths = np.array([len(p) // 4 for p in parts], np.int64)
    ids = table["id"].to_numpy()
    row, offset, least = FMIndex(flat, lengths, SPAN).matches(ids)
    gone = least < ids[row]
    row, offset = row[gone], offset[gone]
    order = np.lexsort((offset, row))
    row, offset = row[order], offset[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)
    at = np.flatnonzero(new)
    take = pa.array(row[at])
    return pa.table({
        "f": table["f"].take(take), "seq": table["seq"].take(take),
        "offset": pa.array(offset[at].astype(np.int32)),
        "windows": pa.array(np.diff(np.append(at, len(row))).astype(np.int32))})


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(id, tag, start, windows): runs of windows that an earlier document has.

    ``texts``: id (long, not null), tag (long), text (binary)."""
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    several = texts.mapInArrow(_count_fingerprints, "f long, n int") \
        .groupBy("f").agg(F.sum("n").alias("n")).filter("n > 1").select("f")
    several = BitMap(several, "f")
    runs = stored(texts.mapInArrow(
        _runs(share(several)),
        "f long, seq long, id long, tag long, start int, windows int, own long"),
        "runs")
    sequences = stored(runs.groupBy("f", "seq").agg(
        F.min(F.struct("id", "start", "own", "windows")).alias("at"))
        .select("f", "seq", F.col("at.id").alias("lo"), "at.own", "at.windows"), "sequences")
    of_run = runs.join(sequences.select("f", "seq", "lo"), ["f", "seq"])
    whole = of_run.filter("id > lo").select("id", "tag", "start", "windows")

    mixed = sequences.groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.min("lo").alias("a"), F.max("lo").alias("b"),
        F.sum(F.col("windows") + SPAN - 1).alias("volume")).filter("n > 1 and a < b")
    unclear = stored(sequences.join(mixed.select("f", (F.col("volume") > SHARD_WORDS).alias("hot"),
                                                 "volume"), "f"), "unclear")
    volume = unclear.filter("not hot").agg(F.sum(F.col("windows") + SPAN - 1)).first()[0] or 0
    shards = max(1, -(-int(volume) // SHARD_WORDS))
    wanted = BitMap(unclear, "own")
    words = texts.mapInArrow(_run_words(share(wanted)), "own long, words binary")
    found = unclear.select("own", "f", "seq", F.col("lo").alias("id"), "hot").join(words, "own")
    matches = found.filter("not hot").mapInArrow(
        _to_shards(shards), "shard int, f long, seq long, id long, words binary") \
        .groupBy("shard").applyInArrow(search_shard, "f long, seq long, offset int, windows int")
    single = stored(found.filter("hot").mapInArrow(
        _to_windows, "f long, seq long, id long, offset int, words binary"), "hot-windows")
    least = single.groupBy("f", "words").agg(F.min("id").alias("least"))
    matches = matches.union(single.join(least, ["f", "words"]).filter("least < id")
                            .select("f", "seq", "offset", F.lit(1).alias("windows")))
    inside = of_run.filter("id = lo").select("f", "seq", "id", "tag", "start").join(
        stored(matches, "matches"), ["f", "seq"]) \
        .select("id", "tag", (F.col("start") + F.col("offset")).alias("start"), "windows")
    return stored(whole.union(inside), "repeated-windows")


def _split_by(shared, inside: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            known = np.array([i is not None for i in ids.to_pylist()], bool)
            h = mix64(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
            hit = known & shared.value.has(h) if len(h) else known
            yield batch.filter(pa.array(hit == inside))
    return run


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, kept = [], [], []
        cuts = batch.column("cuts").to_pylist() if "cuts" in batch.schema.names \
            else [None] * batch.num_rows
        for text, cut in zip(batch.column("text"), cuts, strict=True):
            words = (text.as_py() or b"").split()
            total.append(len(words))
            if cut:
                edge = np.zeros(len(words) + 1, np.int64)
                for c in cut:
                    if c["start"] < len(words):
                        edge[c["start"]] += 1
                        edge[min(len(words), c["start"] + c["windows"] + SPAN - 1)] -= 1
                keep = np.cumsum(edge[:-1]) == 0
                words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            gone.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.record_batch({
            "doc_id": batch.column("id"), "n_words": pa.array(total, pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "kept_text": pa.array([k.decode() for k in kept], pa.string())})


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _apply(batches):
        texts = batch.column("kept_text").to_pylist()
        yield pa.record_batch({
            **{c: batch.column(c) for c in ("doc_id", "n_words", "n_removed")},
            "kept_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])})


def drop_repeated_windows(df: DataFrame, id_col: str = "doc_id", text: str = "text",
                          digests: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (or kept_sha256) of every row of ``df``."""
    spark = df.sparkSession
    ship(spark)
    body = F.col(text).cast("binary")
    texts = df.select(F.col(id_col).cast("long").alias("id"), text_tag(body).alias("tag"),
                      body.alias("text"))
    cuts = repeated_windows(texts.filter("id is not null"))
    affected = stored(cuts.select("id").distinct().mapInArrow(_hash_ids, "h long"), "affected")
    shared = spark.sparkContext.broadcast(BitMap(affected, "h"))
    schema = "id long, tag long, text binary"
    untouched = texts.mapInArrow(_split_by(shared, False), schema)
    grouped = cuts.groupBy("id", "tag") \
        .agg(F.collect_list(F.struct("start", "windows")).alias("cuts"))
    touched = texts.mapInArrow(_split_by(shared, True), schema) \
        .join(grouped, ["id", "tag"], "left").select("id", "text", "cuts")
    how = _digest if digests else _apply
    out = "doc_id long, n_words long, n_removed long, " \
        + ("kept_sha256 string" if digests else "kept_text string")
    return untouched.mapInArrow(how, out).union(touched.mapInArrow(how, out))


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = mix64(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        yield pa.record_batch({"h": pa.array(h.view(np.int64))})
