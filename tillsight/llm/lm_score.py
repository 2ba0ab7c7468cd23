"""LM scoring with a hashed maximum-entropy model.

``P(word | history) = P(class | history) * P(word | class, history)``.  Both factors are
softmaxes over hashed features of the two words before: bias, previous word (bigram),
word before it (skip), and both (trigram).  The ``HEAD`` most frequent words of the
training part form classes of ``WIDTH`` words by frequency; all others fall into ``TAILS``
classes by their ending, inside which a word has its smoothed relative frequency (the
maximum-entropy solution when the only feature is the word); a text's end is a class.

1. *Counts* of all training tokens: partial counts per task, summed by Spark.
2. *Statistics*: (two context symbols, next target) -> count over all training tokens,
   again partial counts and one sum.  Contexts have ``SYMBOLS`` symbols, so this table
   stops growing at ``SYMBOLS**2 * targets`` rows.
3. *Training*: the observed feature counts are summed once.  Each round broadcasts the
   weights (two tables of fixed size), sums the expected feature counts of the statistics
   in parallel, and adds the difference in a clipped, diagonally scaled step.  At most
   ``PARTS`` pairs of tables of fixed size reach the driver a round.
4. *Scoring*: whole texts in numpy batches; softmaxes only of contexts that occur.  Counts
   of the ``DICTIONARY`` most frequent words are broadcast (a fixed bound); rarer words
   leave the scan as (row, word, times) and meet the count table in a join.

Defined cases: null text is the empty text (one token: the end); a null id is in the
training part; rows with equal ids are separate texts; with no training part every
probability is that of an unseen word; only id and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import mix64, ship, stored

HEAD, WIDTH, TAILS, OWN = 1024, 32, 24, 200
DICTIONARY = 1 << 17
HEAD_CLASSES = HEAD // WIDTH
CLASSES = HEAD_CLASSES + TAILS + 1
TARGETS = HEAD + TAILS + 1  # a head word, a tail class, the end
SYMBOLS = OWN + TAILS + 1  # contexts: most frequent words, tail classes, start of text
START = SYMBOLS - 1
CLASS_ROWS, WORD_ROWS = 1 << 12, 1 << 13
PARTS, ROUNDS = 16, 10
END = b""


def tail_class(word: bytes) -> int:
    return int.from_bytes(word[-2:], "little") * 40503 % 65536 * TAILS // 65536


class Targets(dict):
    """word -> target; words outside the dictionary go to their tail class."""

    def __missing__(self, word: bytes) -> int:
        return HEAD + tail_class(word)


def chunks(texts: list[bytes | None], limit: int = 1 << 21) -> Iterator[list[list[bytes]]]:
    """Token lists (with their end) of consecutive texts, about ``limit`` bytes each."""
    out, held = [], 0
    for t in texts:
        tokens = (t or b"").lower().split()
        tokens.append(END)
        out.append(tokens)
        held += len(t or b"") + 1
        if held >= limit:
            yield out
            out, held = [], 0
    if out:
        yield out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(c: Counter) -> pa.RecordBatch:
        return pa.record_batch({"word": pa.array(list(c.keys()), pa.binary()),
                                "n": pa.array(list(c.values()), pa.int64())})

    seen: Counter = Counter()
    for batch in batches:
        for part in chunks(batch.column(0).to_pylist()):
            for tokens in part:
                seen.update(tokens)
            if len(seen) > 300_000:
                yield flush(seen)
                seen = Counter()
    yield flush(seen)


def encode(part: list[list[bytes]], targets: Targets, symbol: np.ndarray):
    """(target, context key) of every token, texts one after another."""
    lengths = np.array([len(t) for t in part])
    flat = [targets[w] for tokens in part for w in tokens]
    ids = np.array(flat, np.int64)
    first = np.cumsum(lengths) - lengths
    before = np.concatenate([[START], symbol[ids[:-1]]])
    before[first] = START
    skip = np.concatenate([[START], before[:-1]])
    skip[first] = START
    return ids, skip * SYMBOLS + before, lengths


def _statistics(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets, symbol = shared.value[:2]
        for batch in batches:
            for part in chunks(batch.column(0).to_pylist(), 1 << 22):
                ids, context, _ = encode(part, targets, symbol)
                key, n = np.unique(context * TARGETS + ids, return_counts=True)
                yield pa.record_batch({"key": pa.array(key), "n": pa.array(n.astype(np.int64))})
    return run


def _rows(context: np.ndarray, salt: int | np.ndarray, size: int) -> list[np.ndarray]:
    """Hashed rows of the features of each context: bias, bigram, skip, trigram."""
    before, skip = context % SYMBOLS, context // SYMBOLS
    out = []
    for kind, value in enumerate((np.zeros_like(context), before, skip, context)):
        h = mix64((value.astype(np.uint64) << np.uint64(3) | np.uint64(kind))
                  + (np.asarray(salt, np.uint64) << np.uint64(40)))
        out.append((h % np.uint64(size)).astype(np.int64))
    return out


def _log_softmax(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    x = weights[rows[0]].copy()
    for r in rows[1:]:
        x += weights[r]
    x -= x.max(1, keepdims=True)
    x -= np.log(np.exp(x).sum(1, keepdims=True))
    return x


def class_of(target: np.ndarray) -> np.ndarray:
    return np.where(target < HEAD, target // WIDTH, HEAD_CLASSES + target - HEAD)


_STATISTICS = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def _feature_counts(shared, observed: bool):
    """Observed, else expected, counts of all features, as one row a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_class, by_word = shared.value
        got = [np.zeros_like(by_class), np.zeros_like(by_word)]
        held = pa.Table.from_batches(batches, _STATISTICS)  # a bounded share of a bounded table
        if held.num_rows:
            key, n = held["key"].to_numpy(), held["n"].to_numpy().astype(np.float32)
            context, target = key // TARGETS, key % TARGETS
            cls = class_of(target)
            unique, at = np.unique(context, return_inverse=True)
            _add(got[0], by_class, _rows(unique, 0, CLASS_ROWS), at, cls, n, observed)
            head = target < HEAD
            pair, at = np.unique(context[head] * HEAD_CLASSES + cls[head], return_inverse=True)
            for k in range(0, len(pair), 1 << 16):
                some = slice(k, k + (1 << 16))
                here = (at >= k) & (at < k + (1 << 16))
                rows = _rows(pair[some] // HEAD_CLASSES, 1 + pair[some] % HEAD_CLASSES, WORD_ROWS)
                _add(got[1], by_word, rows, at[here] - k, (target[head] % WIDTH)[here],
                     n[head][here], observed)
        yield pa.record_batch({"by_class": pa.array([got[0].tobytes()], pa.binary()),
                               "by_word": pa.array([got[1].tobytes()], pa.binary())})
    return run


def _add(got, weights, rows, at, column, n, observed: bool) -> None:
    """Add the observed or expected feature counts of some statistics."""
    if not len(n):
        return
    size, width = len(rows[0]), weights.shape[1]
    if observed:
        x = np.bincount(at * width + column, n, size * width).astype(np.float32) \
            .reshape(size, width)
    else:
        x = np.exp(_log_softmax(weights, rows))
        x *= np.bincount(at, n, size).astype(np.float32)[:, None]
    for r in rows:
        order = np.argsort(r, kind="stable")
        edge = np.flatnonzero(np.diff(r[order], prepend=-1))
        got[r[order][edge]] += np.add.reduceat(x[order], edge, axis=0)


def _summed_counts(statistics: DataFrame, by_class: np.ndarray, by_word: np.ndarray,
                   observed: bool) -> list[np.ndarray]:
    weights = statistics.sparkSession.sparkContext.broadcast((by_class, by_word))
    # coalesce first: one row of counts per task, so at most PARTS rows arrive
    parts = statistics.coalesce(PARTS).mapInArrow(
        _feature_counts(weights, observed), "by_class binary, by_word binary").toArrow()
    sums = [np.zeros(by_class.shape), np.zeros(by_word.shape)]
    for total, name in zip(sums, ("by_class", "by_word"), strict=True):
        for part in parts[name]:
            total += np.frombuffer(part.as_buffer(), np.float32).reshape(total.shape)
    weights.destroy()
    return sums


@dataclass
class Model:
    """Everything scoring needs; all parts have fixed bounds."""
    targets: Targets
    symbol: np.ndarray
    by_class: np.ndarray
    by_word: np.ndarray
    counts: dict[bytes, int]  # of the dictionary
    tail_mass: np.ndarray  # per tail class: N + (V + 1) / 2
    tokens: int
    distinct: int


def _tail_totals(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets, n, v = shared.value[0], np.zeros(TARGETS), np.zeros(TARGETS)
        for batch in batches:
            at = np.array([targets[w] for w in batch.column(0).to_pylist()], np.int64)
            n += np.bincount(at, batch.column(1).to_numpy(), TARGETS)
            v += np.bincount(at, minlength=TARGETS)
        yield pa.record_batch({"target": pa.array(np.arange(TARGETS)),
                               "n": pa.array(n.astype(np.int64)),
                               "v": pa.array(v.astype(np.int64))})
    return run


def fit(training: DataFrame, text: str = "text", rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of the training texts, and the table of all word counts."""
    spark = training.sparkSession
    ship(spark)
    texts = training.select(F.col(text).cast("binary").alias("text"))
    counts = stored(texts.mapInArrow(_count_words, "word binary, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # the dictionary: words above a count, found from a logarithmic histogram
    level = F.floor(F.log2("n") * 16)
    room, least = DICTIONARY, None
    for r in sorted(counts.groupBy(level.alias("l")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r["l"]
    common = counts.filter(level >= least).toArrow() if least is not None else None
    dictionary = {} if common is None else dict(zip(
        common["word"].to_pylist(), common["n"].to_pylist(), strict=True))
    head = sorted((w for w in dictionary if w != END), key=lambda w: (-dictionary[w], w))[:HEAD]
    targets = Targets({w: HEAD + tail_class(w) for w in dictionary})
    targets.update({w: i for i, w in enumerate(head)})
    targets[END] = HEAD + TAILS
    symbol = np.full(TARGETS, START, np.int64)
    symbol[:len(head)] = [i if i < OWN else OWN + tail_class(w) for i, w in enumerate(head)]
    symbol[HEAD:HEAD + TAILS] = OWN + np.arange(TAILS)
    shared = spark.sparkContext.broadcast((targets, symbol))
    totals = np.zeros((TARGETS, 2))
    for r in counts.mapInArrow(_tail_totals(shared), "target long, n long, v long") \
            .groupBy("target").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        totals[r["target"]] = r["n"], r["v"]

    statistics = stored(texts.mapInArrow(_statistics(shared), "key long, n long")
                        .groupBy("key").agg(F.sum("n").alias("n"))
                        .repartition(PARTS, F.floor(F.col("key") / TARGETS)), "statistics")
    by_class = np.zeros((CLASS_ROWS, CLASSES), np.float32)
    by_word = np.zeros((WORD_ROWS, WIDTH), np.float32)
    # the bias rows start at the frequencies
    mass = totals[:, 0] + 0.5
    zero = np.zeros(1, np.int64)
    by_class[_rows(zero, 0, CLASS_ROWS)[0][0]] = np.log(
        np.bincount(class_of(np.arange(TARGETS)), mass, CLASSES))
    for c in range(HEAD_CLASSES):
        by_word[_rows(zero, 1 + c, WORD_ROWS)[0][0]] += np.log(mass[c * WIDTH:(c + 1) * WIDTH])
    seen = _summed_counts(statistics, by_class, by_word, True)
    for _ in range(rounds):
        expected = _summed_counts(statistics, by_class, by_word, False)
        for w, o, e in zip((by_class, by_word), seen, expected, strict=True):
            w += 0.4 * np.clip((o - e) / (e + 5.0), -1.5, 1.5)
    tail = totals[HEAD:HEAD + TAILS]
    return Model(targets, symbol, by_class, by_word, dictionary,
                 tail[:, 0] + 0.5 * (tail[:, 1] + 1), int(total[0] or 0), int(total[1])), counts


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        count, unit = m.counts, np.log10(m.tokens + 0.5 * (m.distinct + 1))
        tail_log = np.log10(m.tail_mass)
        half = {w: float(np.log10(c + 0.5)) for w, c in count.items()}
        for batch in batches:
            n_tokens, n_known, base, score, rare = [], [], [], [], []
            for part in chunks(batch.column(1).to_pylist()):
                ids, context, lengths = encode(part, m.targets, m.symbol)
                doc = np.repeat(np.arange(len(part)), lengths)
                cls = class_of(ids)
                unique, at = np.unique(context, return_inverse=True)
                logp = _log_softmax(m.by_class, _rows(unique, 0, CLASS_ROWS))[at, cls] \
                    .astype(np.float64)
                head = np.flatnonzero(ids < HEAD)
                pair, at = np.unique(context[head] * HEAD_CLASSES + cls[head], return_inverse=True)
                inside = np.zeros(len(head))
                order = np.argsort(at, kind="stable")
                for k in range(0, len(pair), 1 << 16):
                    some = pair[k:k + (1 << 16)]
                    x = _log_softmax(m.by_word, _rows(some // HEAD_CLASSES,
                                                      1 + some % HEAD_CLASSES, WORD_ROWS))
                    a, b = np.searchsorted(at[order], (k, k + (1 << 16)))
                    mine = order[a:b]
                    inside[mine] = x[at[mine] - k, ids[head[mine]] % WIDTH]
                logp[head] += inside
                logp /= np.log(10)
                # log10(c + 1/2) where the dictionary has the word, else left to the join
                known = np.array([half.get(w, np.nan) for t in part for w in t])
                tail = (ids >= HEAD) & (ids < HEAD + TAILS)
                logp[tail] -= tail_log[ids[tail] - HEAD]
                missing = np.isnan(known)
                known[missing] = 0
                logp[tail] += known[tail]
                n_tokens += lengths.tolist()
                n_known += np.bincount(doc, ~missing, len(part)).astype(int).tolist()
                base += (np.bincount(doc, known, len(part)) - lengths * unit).tolist()
                score += np.bincount(doc, logp, len(part)).tolist()
                flat = np.flatnonzero(missing)
                first = np.cumsum(lengths) - lengths
                own: list[dict] = [{} for _ in part]
                for i, d in zip(flat.tolist(), doc[flat].tolist(), strict=True):
                    w = part[d][i - first[d]]
                    own[d][w] = own[d].get(w, 0) + 1
                rare += [[{"w": w, "k": k} for w, k in x.items()] for x in own]
            yield pa.record_batch({
                "row": batch.column(0), "doc_id": batch.column(2), "held_out": batch.column(3),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "base": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
                "rare": pa.array(rare, pa.list_(pa.struct([("w", pa.binary()),
                                                           ("k", pa.int64())])))})
    return run


def score_texts(df: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id",
                text: str = "text", held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = df.select(F.monotonically_increasing_id().alias("row"),
                     F.col(text).cast("binary").alias("text"), F.col(id_col).alias("doc_id"),
                     (F.lit(False) if held_out is None else held_out).alias("held_out"))
    kind = df.schema[id_col].dataType.simpleString()
    scored = stored(rows.mapInArrow(
        _score(shared), f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
        "base double, score double, rare array<struct<w:binary,k:bigint>>"), "scored")
    rare = scored.select("row", F.explode("rare").alias("x")) \
        .select("row", F.col("x.w").alias("word"), F.col("x.k").alias("k")) \
        .join(counts, "word", "left").groupBy("row").agg(
            F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"),
            F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("known"))
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1,
                      F.lit(False))


def score_documents(docs: DataFrame) -> DataFrame:
    model, counts = fit(docs.filter(~held_out()))
    return score_texts(docs, model, counts, held_out=held_out())
