"""Line dedup over content-defined chunks of lines.

A text is cut into runs of lines at two scales.

* Coarse: a rolling hash over the hashes of the last ``SPAN`` lines ends a chunk where it
  is 0 modulo ``EVERY`` (at most ``LONGEST`` lines), so boundaries depend on the lines
  themselves only and fall into step again after an insertion.
* Fine: every line ends a chunk of ``SHORTEST`` lines, so one begins at every line.  Any
  repeated run of two or more lines is covered by its fine chunks, wherever the coarse
  boundaries fall.

A chunk of two or more lines that occurs before, in the order of (id, text, position), is
removed from the text, after its bytes were compared with the first occurrence; it may
overlap that one (of three equal lines the first stays).  Single lines and chunks without a
word are never removed.

Plan: chunk digests are counted with partial aggregation; a fixed-size bit map of those
that recur spares the next scan most other chunks (it never decides: a false hit is only
carried along); chunks whose digest recurs keep their bytes after one join on the digest;
each is compared with its first occurrence (a join on the digest: hot chunks are split by
AQE); texts are rebuilt in one join on the row's id and text hash.

Defined cases: null text has no lines and stays null; an empty table gives no rows; rows
with equal ids are told apart by their texts and lose chunks to one another as others do,
except that copies (one id, one text) are all treated as the first of them; ids may be null
(their chunks count as earliest); only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import mix64, ship, stored, text_tag
from tillsight.llm.substring_dedup import BitMap

SPAN, EVERY, SHORTEST, LONGEST = 1, 3, 2, 16


def chunk_ends(lines: list[bytes]) -> list[int]:
    """Positions after the last line of each chunk."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines))
    rolling = h.copy()
    for k in range(1, SPAN):
        rolling[k:] += mix64(h[:-k] + np.uint64(k))
    cut = mix64(rolling) % np.uint64(EVERY) == 0
    ends, start = [], 0
    for i in range(len(lines)):
        if i + 1 - start == LONGEST or cut[i]:
            ends.append(i + 1)
            start = i + 1
    if start < len(lines):
        ends.append(len(lines))
    return ends


def chunks(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(first line, lines, bytes) of each removable chunk, coarse ones first."""
    lines = text.split(b"\n")
    ends = chunk_ends(lines)
    coarse = [(a, b) for a, b in zip([0, *ends], ends, strict=False) if b - a > SHORTEST]
    fine = [(a, a + SHORTEST) for a in range(len(lines) - SHORTEST + 1)]
    for start, end in coarse + fine:
        body = b"\n".join(lines[start:end])
        if body.split(None, 1):
            yield start, end - start, body


def _chunk_rows(recurring=None):
    """Digests of all chunks, or digests and bytes of those in the bit map."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for doc, tag, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    rows += [(doc, s, n, b, tag) for s, n, b in chunks(text or b"")]
                h = np.fromiter((xxhash.xxh64_intdigest(r[3]) for r in rows), np.uint64,
                                len(rows))
                if recurring is not None:
                    at = np.flatnonzero(recurring.value.has(h))
                    h, rows = h[at], [rows[i] for i in at.tolist()]
                out = {"h": pa.array(h.view(np.int64)),
                       "id": pa.array([r[0] for r in rows], pa.int64()),
                       "tag": pa.array([r[4] for r in rows], pa.int64()),
                       "first": pa.array([r[1] for r in rows], pa.int32())}
                if recurring is not None:
                    out |= {"n": pa.array([r[2] for r in rows], pa.int32()),
                            "body": pa.array([r[3] for r in rows], pa.binary())}
                yield pa.record_batch(out)
    return run


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, kept = [], [], []
        for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                              strict=True):
            lines = [] if text is None else text.split(b"\n")
            total.append(len(lines))
            drop = np.zeros(len(lines), bool)
            for cut in cuts or []:
                drop[cut["first"]:cut["first"] + cut["n"]] = True
            gone.append(int(drop.sum()))
            kept.append(None if text is None else b"\n".join(
                [x for x, d in zip(lines, drop, strict=True) if not d]).decode())
        yield pa.record_batch({
            "doc_id": batch.column(0), "n_lines": pa.array(total, pa.int64()),
            "n_removed": pa.array(gone, pa.int64()), "kept_text": pa.array(kept, pa.string())})


def repeated_chunks(texts: DataFrame) -> DataFrame:
    """(id, tag, first, n) of every chunk that occurs before; ``texts``: id, tag, text
    (binary)."""
    place = F.struct("id", "tag", "first")
    seen = texts.mapInArrow(_chunk_rows(), "h long, id long, tag long, first int")
    recur = stored(seen.groupBy("h").agg(
        F.min(place).alias("at"), F.count(F.lit(1)).alias("times")) \
        .filter("times > 1").select("h", "at"), "recurring-digests")
    shared = texts.sparkSession.sparkContext.broadcast(BitMap(recur, "h"))
    bodies = texts.mapInArrow(_chunk_rows(shared),
                              "h long, id long, tag long, first int, n int, body binary")
    rows = stored(bodies.join(recur, "h").withColumn(
        "is_first", place.eqNullSafe(F.col("at"))), "repeated-chunks")
    firsts = rows.filter("is_first").groupBy("h").agg(F.min("body").alias("first_body"))
    return rows.filter("not is_first").join(firsts, "h") \
        .filter(F.col("body") == F.col("first_body")).select("id", "tag", "first", "n")


def drop_repeated_chunks(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed and kept_text of every row of ``df``."""
    ship(df.sparkSession)
    body = F.col(text).cast("binary")
    texts = df.select(F.col(id_col).cast("long").alias("id"), text_tag(body).alias("tag"),
                      body.alias("text"))
    cuts = repeated_chunks(texts) \
        .groupBy(F.col("id").alias("cut_id"), F.col("tag").alias("cut_tag")) \
        .agg(F.collect_list(F.struct("first", "n")).alias("cuts"))
    return texts.join(cuts, F.col("id").eqNullSafe(F.col("cut_id"))
                      & (F.col("tag") == F.col("cut_tag")), "left") \
        .select("id", "text", "cuts") \
        .mapInArrow(_rebuild, "doc_id long, n_lines long, n_removed long, kept_text string")
