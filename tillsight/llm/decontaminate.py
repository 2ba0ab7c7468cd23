"""Benchmark decontamination by latent semantic retrieval.

Benchmark items (in pieces of at most ``PIECE`` words) are the queries, documents the
corpus, both lower-cased and without ASCII punctuation.

1. All documents as passages of hashed words, stored; document frequencies of the words, over
   all documents (one pass, partial counts).
2. Latent spaces, one per ``GROUP`` queries: randomised SVD of the TF-IDF matrix of these
   queries and all passages of the corpus, which together weigh as much as
   ``fit_documents`` passages of ``SAMPLE_WEIGHT``.  The rank starts at ``RANK`` and doubles
   until the space keeps a share ``KEEP`` of the length of every query.  The rows stay
   distributed: power iterations and the final Rayleigh-Ritz step are maps over them, and
   their parts are summed there; the driver only holds arrays bounded by ``SLOTS``, the
   block of queries and the rank.
3. Candidates: every passage of every document (``WINDOW`` words, step ``STEP``) is
   projected and compared with all queries.  The test is a cosine threshold that allows
   for what else the passage holds and for what the space keeps of the query (a passage
   that is the query itself has no more than that): cosine >= ``REACH`` * kept share *
   min(1, |query| / |passage|), that is, the passage covers that share of the query's
   weight in the latent space.
4. Candidates are checked on the words: how many of the query's words the passage and its
   surroundings have (a bound, no rule of its own), then the longest common subsequence.  A document is contaminated
   if the subsequence has at least ``SURE`` of the query's words, or at least
   ``PARAPHRASE`` of them and the answer (the item's answer column, else its last words)
   stands in the passage.  An item of fewer than ``SHORT`` words is contained in much
   unrelated text; it counts only if it stands there word for word and says enough: at least
   ``LEAST_WORDS`` different words whose idf adds up to ``EVIDENCE``, those of the answer
   included if that stands there too.  Items that cannot say so much (``no``, ``what is
   the``) match nothing.

The queries are taken in blocks of ``block`` items, each block one pass over the corpus
for every ``PASS`` latent spaces: a stated query set against all rows.  Nothing is shuffled but counts and final matches.

Defined cases: null or blank texts match nothing, as do items without words; repeated
items or documents match separately, one row per (document, item) id; a null id is
reported as null; an empty corpus or benchmark gives no rows; only the named columns are
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import ship, stored, word_hashes
from tillsight.sources.sinks import shuffles_dropped

SLOTS = 1 << 17
RANK, EXTRA, POWER = 128, 16, 2
PIECE, BLOCK_WORDS, WINDOW, STEP = 64, 16, 64, 32
GROUP, PASS, KEEP = 200, 1, 0.6
REACH, SURE, PARAPHRASE, ANSWER_WORDS = 0.33, 0.8, 0.55, 4
SAMPLE_WEIGHT = 0.5
#: Slots of a part of a basis, and passages that are worth a task with a sum of its own.
PART, TASK_ROWS = 1024, 500_000
SHORT, LEAST_WORDS, EVIDENCE = 8, 3, 5.0
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(None, _PUNCTUATION).split()


def slots_of(words: list[bytes]) -> np.ndarray:
    return (word_hashes(words) & np.uint64(SLOTS - 1)).astype(np.int64)


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, with all its passages one after the other: ``WINDOW`` words each,
    the last one what is left, as distinct slots and how often each is there."""
    for batch in batches:
        columns: list[list] = [[], [], []]
        ends: list[list[int]] = [[0], [0], [0]]
        for text in batch.column(0):
            slots = slots_of(tokens(text.as_py()))
            found = [np.unique(slots[a:a + WINDOW], return_counts=True)
                     for a in range(0, len(slots), WINDOW)]
            of = ([s for s, _ in found], [n for _, n in found],
                  [np.array([len(s) for s, _ in found], np.int64)])
            for column, end, x in zip(columns, ends, of, strict=True):
                column += x
                end.append(end[-1] + sum(map(len, x)))
        yield pa.record_batch([pa.ListArray.from_arrays(pa.array(end, pa.int32()), pa.array(
            np.concatenate(column) if column else [], t)) for column, end, t in zip(
                columns, ends, (pa.int32(), pa.int8(), pa.int8()), strict=True)],
            ["slots", "times", "lengths"])


_ROWS = "slots array<int>, times array<tinyint>, lengths array<tinyint>"


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return (flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))


def _passages_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, times) of every passage."""
    for slots, times, lengths in zip(*map(_lists, batch.columns), strict=True):
        a = 0
        for n in lengths.tolist():
            yield slots[a:a + n], times[a:a + n]
            a += n


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        for slots in _lists(batch.column(0)):
            df[np.unique(slots)] += 1
        n += batch.num_rows
    at = np.flatnonzero(df)
    yield pa.record_batch({"slot": pa.array(np.append(at, -1)),
                           "df": pa.array(np.append(df[at], n))})


def inverse_frequencies(corpus: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """idf per hashed word over all documents (an array of fixed size), and the slots that
    documents have."""
    counts = corpus.select("slots").mapInArrow(_frequencies, "slot long, df long") \
        .groupBy("slot").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(SLOTS + 1)
    df[counts["slot"].to_numpy()] = counts["df"].to_numpy()
    return np.log((1 + df[-1]) / (0.5 + df[:-1])).clip(0.05).astype(np.float32), \
        np.flatnonzero(df[:-1])


@dataclass
class Query:
    item: object
    piece: int
    words: list[bytes]
    answer: list[bytes]


def pieces(item, text: bytes | None, answer: bytes | None) -> list[Query]:
    words = tokens(text)
    count = max(1, -(-len(words) // PIECE))
    cut = [words[len(words) * k // count:len(words) * (k + 1) // count] for k in range(count)]
    return [Query(item, k, w, tokens(answer) if answer else w[-ANSWER_WORDS:])
            for k, w in enumerate(cut) if w]


# -- the latent space --------------------------------------------------------------

def _weighted(times: np.ndarray, slots: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = times * idf[slots]
    return (v / np.linalg.norm(v)).astype(np.float32)


def _unit(slots: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and unit-length TF-IDF weights of a passage."""
    s, n = np.unique(slots, return_counts=True)
    return s, _weighted(n, s, idf)


def _power(shared):
    """A task's part of (A'A) V in parts of ``PART`` slots, or of (AV)'(AV) as part -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, idf, basis, last = shared.value
        out = np.zeros((basis.shape[1],) * 2 if last else basis.shape, np.float32)
        for batch in batches:
            for slots, times in _passages_of(batch):
                rows, w = place[slots], _weighted(times, slots, idf)
                y = w @ basis[rows]
                if last:
                    out += np.outer(y, y)
                else:
                    out[rows] += w[:, None] * y  # a passage has each slot once
        for a in range(0, len(out), len(out) if last else PART):
            part = out if last else out[a:a + PART]
            yield pa.record_batch({"part": pa.array([-1 if last else a], pa.int32()),
                                   "vectors": pa.array([part.tobytes()], pa.binary())})
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of equal parts."""
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, vectors in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(vectors.as_buffer(), np.float32)
            parts[part] = parts[part] + x if part in parts else x.copy()
    for part, x in parts.items():
        yield pa.record_batch({"part": pa.array([part], pa.int32()),
                               "vectors": pa.array([x.tobytes()], pa.binary())})


def _orthonormal(y: np.ndarray) -> np.ndarray:
    """The columns of ``y`` made orthonormal in place (those that depend on others: zero)."""
    for _ in range(2):  # the second time for what rounding left
        gram = np.zeros((y.shape[1],) * 2)
        for a in range(0, len(y), PART):
            part = y[a:a + PART].astype(np.float64)
            gram += part.T @ part
        value, vectors = np.linalg.eigh(gram)
        keep = value > 1e-9 * value[-1]
        turn = np.where(keep, vectors / np.sqrt(np.where(keep, value, 1)), 0)
        for a in range(0, len(y), PART):
            y[a:a + PART] = y[a:a + PART] @ turn
    return y


def latent_basis(corpus: DataFrame, idf: np.ndarray, own: list[tuple[np.ndarray, np.ndarray]],
                 scale: float, known: np.ndarray, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Right singular vectors (``known`` slots x rank) of the distributed passages' unit vectors
    times ``scale`` and the few ``own`` ones: randomised range finder, power iterations,
    Rayleigh-Ritz."""
    spark = corpus.sparkSession
    share = spark.sparkContext.broadcast
    place = np.full(SLOTS, -1, np.int32)
    place[known] = np.arange(len(known))
    width = min(rank + EXTRA, len(known))
    basis = _orthonormal(np.random.default_rng(seed).standard_normal(
        (len(known), width), np.float32))
    for last in [False] * POWER + [True]:
        shared = share((place, idf, basis, last))
        out = np.zeros((width, width) if last else basis.shape, np.float32)
        with shuffles_dropped(spark):
            parts = corpus.mapInArrow(_power(shared), "part int, vectors binary") \
                .repartition("part").mapInArrow(_added, "part int, vectors binary").toArrow()
        for part, vectors in zip(parts["part"].to_pylist(), parts["vectors"], strict=True):
            x = np.frombuffer(vectors.as_buffer(), np.float32).reshape(-1, width)
            out[max(part, 0):max(part, 0) + len(x)] += x
        del parts
        shared.destroy()  # the driver holds a copy of its own
        out *= np.float32(scale ** 2)
        for s, v in own:
            y = v @ basis[place[s]]
            if last:
                out += np.outer(y, y)
            else:
                out[place[s]] += v[:, None] * y
        if not last:
            basis = _orthonormal(out)
    _, vectors = np.linalg.eigh(out.astype(np.float64))
    return basis @ vectors[:, ::-1][:, :rank].astype(np.float32)


# -- search and checks -------------------------------------------------------------

def longest_common(query: list[bytes], passage: list[bytes]) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    at: dict[bytes, int] = {}
    for i, w in enumerate(query):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(query)) - 1
    v = full
    for w in passage:
        u = v & at.get(w, 0)
        v = (v + u | v - u) & full
    return len(query) - v.bit_count()


def holds(passage: list[bytes], answer: list[bytes]) -> bool:
    n = len(answer)
    return n > 0 and any(passage[i:i + n] == answer for i in range(len(passage) - n + 1))


class Passages:
    """Latent vectors and lengths of the overlapping passages of one document."""

    def __init__(self, idf: np.ndarray, known: np.ndarray, basis: np.ndarray):
        zero = len(known)
        self.place = np.full(SLOTS, zero)
        self.place[known] = np.arange(zero)
        self.rows = np.zeros((zero + 1, basis.shape[1]), np.float32)
        np.multiply(basis, idf[known, None], out=self.rows[:zero])
        self.energy = idf ** 2
        self.held = np.empty((256, BLOCK_WORDS, basis.shape[1]), np.float32)

    def __call__(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step, wide = STEP // BLOCK_WORDS, WINDOW // BLOCK_WORDS
        blocks = -(-len(slots) // BLOCK_WORDS)
        count = len(range(0, max(1, blocks - wide + step), step))
        again = np.flatnonzero(slots[1:] == slots[:-1]) + 1  # counts once
        row = np.full(blocks * BLOCK_WORDS, len(self.rows) - 1)
        row[:len(slots)] = self.place[slots]
        row[again] = len(self.rows) - 1
        weight = np.zeros(blocks * BLOCK_WORDS, np.float32)
        weight[:len(slots)] = self.energy[slots]
        weight[again] = 0
        row = row.reshape(blocks, BLOCK_WORDS)
        filled = max(blocks, (count - 1) * step + wide)
        sums = np.zeros((filled, self.rows.shape[1]), np.float32)
        energy = np.zeros(filled, np.float32)
        energy[:blocks] = weight.reshape(blocks, BLOCK_WORDS).sum(1)
        for a in range(0, blocks, len(self.held)):
            part = row[a:a + len(self.held)]
            held = self.held[:len(part)]
            np.take(self.rows, part, axis=0, out=held, mode="clip")
            held.sum(1, out=sums[a:a + len(part)])
        ends = [(k, k + (count - 1) * step + 1) for k in range(wide)]
        vectors = sum(sums[a:b:step] for a, b in ends)
        total = sum(energy[a:b:step] for a, b in ends)
        return vectors, np.sqrt(np.maximum(total, 1e-9))


@dataclass
class Space:
    """A group of queries in the latent space fitted on them: unit vectors, and the share of
    each query's length that the space keeps."""
    known: np.ndarray
    basis: np.ndarray
    queries: list[Query]
    latent: np.ndarray
    keep: np.ndarray


def latent_space(corpus: DataFrame, passages: int, scale: float, present: np.ndarray,
                 queries: list[Query], idf: np.ndarray) -> Space:
    """The space of ``queries`` and the corpus's passages, of a rank that keeps the queries."""
    units = [_unit(slots_of(q.words), idf) for q in queries]
    known = np.union1d(present, np.concatenate([s for s, _ in units]))
    most, rank = min(passages + len(units), len(known)), RANK
    while True:
        basis = latent_basis(corpus, idf, units, scale, known, rank)
        latent = np.array([v @ basis[np.searchsorted(known, s)] for s, v in units], np.float32)
        keep = np.linalg.norm(latent, axis=1)
        if keep.min() >= KEEP or rank >= most:
            return Space(known, basis, queries, latent / np.maximum(keep, 1e-6)[:, None], keep)
        rank *= 2


class Search:
    """The queries of one space against the passages of one document at a time."""

    def __init__(self, idf: np.ndarray, space: Space):
        self.passages = Passages(idf, space.known, space.basis)
        self.queries, self.latent = space.queries, space.latent
        self.counts = [Counter(q.words) for q in self.queries]
        weight_of = lambda w: float(idf[slots_of([w])[0]]) ** 2
        self.heavy = [{w: weight_of(w) for w in c} for c in self.counts]
        self.mass = [sum(n * h[w] for w, n in c.items())
                     for c, h in zip(self.counts, self.heavy, strict=True)]
        self.norm = np.sqrt(self.mass).astype(np.float32)
        # an item cut into pieces is a long one
        self.short = [len(q.words) < SHORT and q.piece == 0 for q in self.queries]
        self.idf = idf
        self.reach = (REACH * space.keep).astype(np.float32)

    def __call__(self, words: list[bytes], slots: np.ndarray) -> Iterator[tuple]:
        vectors, length = self.passages(slots)
        product = vectors @ self.latent.T
        need = self.reach * np.minimum(length[:, None], self.norm[None, :])
        at = -1
        for p, q in np.argwhere(product >= need).tolist():
            if p != at:
                at, a = p, p * STEP
                near = words[max(0, a - BLOCK_WORDS):a + WINDOW + BLOCK_WORDS]
                held = Counter(near)
            query, heavy = self.queries[q], self.heavy[q]
            both = {t: min(n, held[t]) for t, n in self.counts[q].items() if t in held}
            n = len(query.words)
            if sum(both.values()) < PARAPHRASE * n:  # no subsequence is longer
                continue
            common = longest_common(query.words, near)
            answer = holds(near, query.answer)
            if self.short[q]:
                sure = holds(near, query.words) and (
                    self._telling(query.words) or answer and self._telling(
                        query.words + query.answer))
            else:
                sure = common >= SURE * n or common >= PARAPHRASE * n and answer
            if sure:
                cover = sum(k * heavy[t] for t, k in both.items()) / self.mass[q]
                yield (query.item, query.piece, float(product[p, q] / length[p]), cover,
                       common / n, answer, a)

    def _telling(self, words: list[bytes]) -> bool:
        """Whether these words are unlikely to stand together by chance."""
        different = sorted(set(words))
        return len(different) >= LEAST_WORDS \
            and float(self.idf[slots_of(different)].sum()) >= EVIDENCE


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, spaces = shared.value
        searches = [Search(idf, s) for s in spaces]
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("id", "item", "piece", "cosine", "cover",
                                                    "common", "answer", "first")}
            ids = batch.column(0).to_pylist()
            for i, text in enumerate(batch.column(1)):
                words = tokens(text.as_py())
                if not words:
                    continue
                slots = slots_of(words)
                for search in searches:
                    for hit in search(words, slots):
                        for k, v in zip(out, (ids[i], *hit), strict=True):
                            out[k].append(v)
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), (
                pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(),
                pa.bool_(), pa.int32()), strict=True)], list(out))
    return run


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text: str = "text", item_col: str = "item_id", item_text: str = "text",
                 answer: str | None = None, block: int = 2000,
                 fit_documents: int = 512) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, piece, cosine,
    weight_share, common_share, answer_found, first_word of the best passage."""
    spark = df.sparkSession
    ship(spark)
    share = spark.sparkContext.broadcast
    texts = df.select(F.col(id_col).cast("long").alias("id"),
                      F.col(text).cast("binary").alias("text"))
    found = None
    corpus = stored(texts.select("text").mapInArrow(_passage_rows, _ROWS), "corpus-passages")
    idf, present = inverse_frequencies(corpus)
    passages = corpus.agg(F.coalesce(F.sum(F.size("lengths")), F.lit(0))).first()[0]
    scale = SAMPLE_WEIGHT * min(1.0, (fit_documents / max(1, passages)) ** 0.5)
    corpus = corpus.coalesce(max(1, min(spark.sparkContext.defaultParallelism,
                                        passages // TASK_ROWS)))
    items = stored(benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("binary").alias("text"),
        (F.lit(None) if answer is None else F.col(answer)).cast("binary").alias("answer"))
        .withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(
            max(1, -(-benchmark.count() // block))))), "items")
    schema = "id long, item long, piece int, cosine double, cover double, common double, " \
        "answer boolean, first int"
    for b in sorted(r[0] for r in items.select("block").distinct().collect()):
        queries = [q for r in items.filter(F.col("block") == b).collect()
                   for q in pieces(r["item"], r["text"], r["answer"])]
        if not queries:
            continue
        groups = np.array_split(np.arange(len(queries)), -(-len(queries) // GROUP))
        for k in range(0, len(groups), PASS):
            spaces = [latent_space(corpus, passages, scale, present, [queries[i] for i in g], idf)
                      for g in groups[k:k + PASS]]
            shared = share((idf, spaces))
            hits = stored(texts.mapInArrow(_search(shared), schema), "hits")
            shared.destroy()
            found = hits if found is None else found.union(hits)
    if found is None:
        found = spark.createDataFrame([], schema)
    best = F.max_by(F.struct("piece", "cosine", "cover", "common", "answer", "first"),
                    F.struct("common", "cosine", -F.col("first")))
    return found.groupBy("id", "item").agg(best.alias("x")).select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "x.piece",
        F.col("x.cosine").alias("cosine"), F.col("x.cover").alias("weight_share"),
        F.col("x.common").alias("common_share"), F.col("x.answer").alias("answer_found"),
        F.col("x.first").alias("first_word"))
