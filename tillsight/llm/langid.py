"""Language identification of mixed-language text.

Every word gets one score per language, from byte trigrams (word boundaries count as
blanks) counted in labelled documents.  The word's script (Unicode ranges) removes
languages that were never seen in that script.  A Viterbi pass per document over the
word scores, with a penalty for switching, labels spans; a document's language is the
one that holds most of its letters, and its score the share of them.

Fitting counts trigrams of at most about ``max_train_docs`` labelled documents, spread
evenly over the languages (chosen by a hash of the id), in parallel; the model is a
table of 2**16 trigram slots x languages, bounded by ``max_langs``, and is broadcast.
Scoring reads every whole text: numpy over the bytes of an Arrow batch, the Viterbi
step vectorised across the documents of a batch.

Defined cases: null text or text without a letter is ``und`` with score 0, as is
everything when nothing was learned; documents of unknown language or null text teach
nothing; a word without letters has no preference; ties go to the first language by
code point; repeated ids are separate rows; only id, text and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillsight.llm.common import ship

SLOTS = 1 << 16
#: First code point of a range, and its script (0: no letter).
SCRIPT_RANGES = [
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1),
    (0x00AB, 0), (0x00B5, 1), (0x00B6, 0), (0x00BA, 1), (0x00BB, 0), (0x00C0, 1),
    (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1), (0x0250, 11), (0x0370, 2),
    (0x0400, 3), (0x0530, 11), (0x0590, 4), (0x0600, 5), (0x0700, 11), (0x0900, 6),
    (0x0980, 11), (0x0E00, 7), (0x0E80, 11), (0x1E00, 1), (0x1F00, 2), (0x2000, 0),
    (0x3040, 8), (0x3100, 11), (0x3400, 9), (0xA000, 11), (0xAC00, 10), (0xD7B0, 11),
    (0xE000, 0), (0xF900, 9), (0xFB00, 11), (0x1F000, 0), (0x20000, 9),
]
SCRIPTS = 12
_RANGE_AT = np.array([a for a, _ in SCRIPT_RANGES])
_RANGE_IS = np.array([s for _, s in SCRIPT_RANGES], np.uint8)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ASCII_SCRIPT = _RANGE_IS[np.searchsorted(_RANGE_AT, np.arange(128), "right") - 1]


def byte_scripts(b: np.ndarray) -> np.ndarray:
    """Script of the character that starts at each byte (0 at continuation bytes)."""
    out = np.zeros(len(b), np.uint8)
    ascii_ = b < 128
    out[ascii_] = _ASCII_SCRIPT[b[ascii_]]
    at = np.flatnonzero(b >= 0xC0)
    if len(at):
        padded = np.concatenate([b, np.zeros(3, np.uint8)]).astype(np.uint32)
        lead, x = padded[at], [padded[at + k] & 0x3F for k in (1, 2, 3)]
        two = (lead & 0x1F) << 6 | x[0]
        three = (lead & 0x0F) << 12 | x[0] << 6 | x[1]
        four = (lead & 0x07) << 18 | x[0] << 12 | x[1] << 6 | x[2]
        cp = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
        out[at] = _RANGE_IS[np.searchsorted(_RANGE_AT, cp, "right") - 1]
    return out


class Words:
    """Words of a few texts: their bytes' trigram slots, scripts and letters."""

    def __init__(self, texts: list[bytes]):
        self.buf = np.frombuffer(b"\n" + b"\n".join(texts).lower() + b"\n", np.uint8)
        blank = _BLANK[self.buf]
        b = np.where(blank, np.uint8(32), self.buf).astype(np.uint32)
        inside = np.flatnonzero(~blank)
        tri = b[inside - 1] << 16 | b[inside] << 8 | b[inside + 1]
        self.slots = (tri * np.uint32(2654435761)) >> np.uint32(16)
        script = byte_scripts(self.buf)[inside]
        # one byte of every letter, its first
        self.starts = script > 0
        # continuation bytes belong to the character before them
        self.letter = (script > 0) | ((self.buf[inside] >= 0x80) & (self.buf[inside] < 0xC0))
        self.first = np.flatnonzero(blank[inside - 1])  # of each word, in ``inside``
        self.script = (np.maximum.reduceat(script, self.first) if len(self.first)
                       else np.empty(0, np.uint8))
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.per_text = np.diff(np.searchsorted(inside[self.first], np.append(1, ends + 1)))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each word."""
        if not len(self.first):
            return np.zeros((0, *values.shape[1:]), values.dtype)
        return np.add.reduceat(values, self.first, axis=0)


def _chunks(texts: list[bytes], limit: int = 1 << 21) -> Iterator[list[bytes]]:
    chunk, held = [], 0
    for t in texts:
        if chunk and held + len(t) > limit:
            yield chunk
            chunk, held = [], 0
        chunk.append(t)
        held += len(t)
    if chunk:
        yield chunk


def _texts(batch: pa.RecordBatch, k: int) -> list[bytes]:
    return [t or b"" for t in batch.column(k).to_pylist()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang_of = batch.column(0).dictionary_encode()
        names, codes = lang_of.dictionary.to_pylist(), lang_of.indices.to_numpy()
        texts = _texts(batch, 1)
        for k, name in enumerate(names):
            counts = np.zeros(SLOTS + SCRIPTS, np.int64)
            for chunk in _chunks([texts[i] for i in np.flatnonzero(codes == k)]):
                w = Words(chunk)
                counts[:SLOTS] += np.bincount(w.slots[w.letter], minlength=SLOTS)
                counts[SLOTS:] += np.bincount(w.script, minlength=SCRIPTS)
            at = np.flatnonzero(counts)
            yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()),
                                   "slot": pa.array(at, pa.int32()),
                                   "n": pa.array(counts[at], pa.int64())})


class Model:
    """Score per (slot, language), and which languages use which script."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        tri, scripts = counts[:, :SLOTS].astype(float), counts[:, SLOTS:].astype(float)
        logp = np.log((tri + 0.5) / (tri.sum(1, keepdims=True) + 0.5 * SLOTS))
        self.scores = (logp - logp.mean(0)).T.astype(np.float32).copy()
        used = scripts >= 0.005 * np.maximum(scripts[:, 1:].sum(1, keepdims=True), 1)
        used[:, 0] = True
        used[:, ~used.any(0)] = True
        self.barred = ~used.T  # (script, language)


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", id_col: str = "doc_id",
        max_train_docs: int = 20_000, max_langs: int = 256) -> Model | None:
    """Learn from documents with a label and a text; None if there are none."""
    ship(labelled.sparkSession)
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than max_langs={max_langs} languages")
    if not sizes:
        return None
    langs = sorted(sizes)
    share = F.create_map(*[F.lit(x) for name in langs for x in (
        name, int(min(1.0, max_train_docs / len(langs) / sizes[name]) * 1_000_000))])
    drawn = F.pmod(F.xxhash64(F.lit(3), id_col), F.lit(1_000_000)) < share[F.col(lang)]
    sample = rows.filter(drawn).select(F.col(lang), F.col(text).cast("binary"))
    table = sample.mapInArrow(_count, "lang string, slot int, n long") \
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(langs), SLOTS + SCRIPTS), np.int64)
    at = np.searchsorted(langs, np.array(table["lang"].to_pylist(), dtype=object))
    counts[at, table["slot"].to_numpy()] = table["n"].to_numpy()
    return Model(langs, counts)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best label per word; ``scores`` holds the documents' words one after another.

    All documents advance together, one word a step; finished ones drop out."""
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    start, n = starts[order], lengths[order]
    steps = int(n[0]) if len(n) else 0
    active = np.searchsorted(-n, -np.arange(steps), "left")  # documents longer than t
    langs = scores.shape[1]
    best = np.zeros((len(n), langs), np.float32)
    came = np.empty(scores.shape, np.uint8)
    own = np.arange(langs, dtype=np.uint8)
    for t in range(steps):
        a = active[t]
        d, at = best[:a], start[:a] + t
        top = d.argmax(1)
        switch = (d[np.arange(a), top] - penalty)[:, None]
        moved = switch > d
        came[at] = np.where(moved, top[:, None].astype(np.uint8), own)
        best[:a] = np.where(moved, switch, d) + scores[at]
    state = best.argmax(1)
    out = np.zeros(len(scores), np.uint8)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        out[at] = state[:a]
        state[:a] = came[at, state[:a]]
    return out


#: Span of words [first, last] of one language.
OUT = ("lang_pred string, score double, "
       "spans array<struct<first:int,last:int,lang:string>>")
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()),
                             ("lang", pa.string())]))


def _label_texts(texts: list[bytes], m: Model | None, penalty: float,
                 cap: float) -> Iterator[tuple[str, float, list[dict]]]:
    """(language, score, spans) of a few MB of texts."""
    if m is None:
        yield from (("und", 0.0, []) for _ in texts)
        return
    parts = []
    for chunk in _chunks(texts):
        w = Words(chunk)
        s = w.sums(m.scores[w.slots] * w.letter[:, None])
        s -= s.max(1, keepdims=True)
        np.maximum(s, -cap, out=s)
        s[m.barred[w.script]] = -2 * cap
        parts.append((s, w.per_text, w.sums(w.starts.astype(np.int64))))
    scores, lengths, letters = (np.concatenate(p) for p in zip(*parts, strict=True))
    label = viterbi(scores, lengths, penalty)
    edge = np.concatenate([[0], np.cumsum(lengths)])
    doc = np.repeat(np.arange(len(texts)), lengths)
    held = np.bincount(doc * len(m.langs) + label, letters,
                       len(texts) * len(m.langs)).reshape(len(texts), -1)
    top, total = held.argmax(1), held.sum(1)
    for i, t in enumerate(texts):
        if not any(map(str.isalpha, t.decode("utf-8", "ignore"))):
            yield "und", 0.0, []
            continue
        x = label[edge[i]:edge[i + 1]]
        cut = np.flatnonzero(np.diff(x)) + 1
        yield m.langs[top[i]], float(held[i, top[i]] / max(total[i], 1)), [
            {"first": int(f), "last": int(e) - 1, "lang": m.langs[x[f]]}
            for f, e in zip(np.append(0, cut), np.append(cut, len(x)), strict=True)]


def _label(model, penalty: float, cap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = model.value
        for batch in batches:
            texts = _texts(batch, 1)
            pred, score, spans = [], [], []
            for part in _chunks(texts, 1 << 23):
                for x, y, z in _label_texts(part, m, penalty, cap):
                    pred.append(x)
                    score.append(y)
                    spans.append(z)
            yield pa.record_batch({
                **{f: batch.column(f) for f in batch.schema.names if f != "__text"},
                "lang_pred": pa.array(pred, pa.string()),
                "score": pa.array(score, pa.float64()),
                "spans": pa.array(spans, _SPANS)})
    return run


def label_languages(df: DataFrame, model: Model | None, text: str = "text",
                    keep: dict[str, Column] | None = None, penalty: float = 8.0,
                    cap: float = 6.0) -> DataFrame:
    """``keep`` columns, lang_pred, score and spans of every row of ``df``."""
    ship(df.sparkSession)
    keep = keep or {"doc_id": F.col("doc_id")}
    rows = df.select(*[e.alias(k) for k, e in keep.items()])
    schema = StructType(rows.schema.fields + StructType.fromDDL(OUT).fields)
    first, *rest = [e.alias(k) for k, e in keep.items()]
    source = df.select(first, F.col(text).cast("binary").alias("__text"), *rest)
    shared = df.sparkSession.sparkContext.broadcast(model)
    return source.mapInArrow(_label(shared, penalty, cap), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2,
                      F.lit(False))


def identify_documents(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, label all of them."""
    model = fit(docs.filter(~held_out()))
    return label_languages(docs, model, keep={"doc_id": F.col("doc_id"),
                                              "held_out": held_out()})
