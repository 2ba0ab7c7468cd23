"""Spelling variants of a corpus's words by asymmetric q-chunks.

Two words are near if one insertion, deletion or replacement of a code point turns one
into the other.  The signatures of the two sides of the join differ:

* a word w as *chunk side* contributes two disjoint chunks, its halves.  One edit of w
  touches only one of them, so the other stands whole in any near word, at the same place
  if it lies left of the edit and shifted by the difference of the lengths (one at most)
  if it lies right of it;
* a word v as *gram side* contributes, for every length a near w can have, its positional
  grams of that w's chunk lengths at all shifts within one at which such a chunk can stand.

A short chunk alone is shared by many words, so the principle is applied again inside the
touched chunk: of its two halves one also stays whole.  A signature is therefore a chunk
with a half of the other chunk, each with its place: the word without one of four pieces
(:func:`chunk_side`; :func:`gram_side` for each length).  Signatures are compared by equality,
and words that meet are verified by their edit distance.

Signatures that more than ``LARGE`` words contribute as grams are not joined: their words
are signed anew with pieces a fourth as long, and so on down to single code points, where
what meets differs in that point alone.  Every pair is met at one of these levels, so
this is exact; no group is collected, and words of any length take part.

``form`` is the near word with the largest count (ties: smallest in code-point order),
if it is at least ``ratio`` times as frequent as the word.  Counts at least double from a word
to its form, so following forms ends; roots come from pointer doubling.

Defined cases: null or empty texts have no words; a null id counts as an empty string
where ids are hashed; repeated rows count repeatedly; empty tables give no rows; only the
id and the text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import ship, stored

#: Letters of a run, after A-Z are lowered.
RUN = re.compile("[a-zÀ-ÿ]+")
#: Runs whose hash this number divides lose a code point.
SLIP = 97
#: Words of a signature up to which they are compared.  Comparing a word with so many others
#: costs about what signing it anew does; both ways find the same pairs.
LARGE = 1000
_FLUSH = 200_000


def slipped(run: str, doc_id: str) -> str:
    """The run, without one code point where its hash says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def runs(text: bytes) -> Iterator[str]:
    """The lowered runs of letters, found one by one."""
    return map(re.Match.group, RUN.finditer(text.lower().decode("utf-8", "replace")))


def _words(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                doc_id = "" if not key.is_valid else str(key)
                for word, n in Counter(runs(text.as_py() or b"")).items():
                    word = slipped(word, doc_id)
                    if len(word) >= shortest:
                        total[word] += n
            if len(total) > _FLUSH:
                yield _counts(total)
                total.clear()
        yield _counts(total)
    return run


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.record_batch({"word": pa.array(total.keys(), pa.string()),
                            "n": pa.array(total.values(), pa.int64())})


def word_counts(df: DataFrame, shortest: int = 5, least: int = 3, id_col: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(word, n) of the words with at least ``shortest`` code points and ``least``
    occurrences.  Tasks count before the shuffle, in a dictionary of bounded size."""
    ship(df.sparkSession)
    parts = df.select(F.col(id_col).cast("long"), F.col(text).cast("binary")) \
        .mapInArrow(_words(shortest), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _signatures(word: Column, length: Column, shift: Column, pieces: int) -> Column:
    """Signatures of ``word`` for a chunk-side word of ``length`` code points, which is cut into
    ``pieces`` pieces.  Signature k leaves out piece k: what is left of it stands at its own
    place, what is right of it is ``shift`` further on."""
    cuts = [F.floor(length * k / pieces).cast("int") for k in range(pieces + 1)]

    def part(a: Column, b: Column) -> Column:
        return F.substring(word, a + 1, b - a)
    return F.array(*[F.struct(
        F.lit(k).alias("left_out"), length.cast("int").alias("length"),
        part(F.lit(0), cuts[k]).alias("before"),
        part(cuts[k + 1] + shift, length + shift).alias("after")) for k in range(pieces)])


def chunk_side(words: DataFrame, pieces: int = 4) -> DataFrame:
    """(sig, word, n): each of two chunks with either half of the other one."""
    sigs = _signatures(F.col("word"), F.length("word"), F.lit(0), pieces)
    return words.select(F.explode(sigs).alias("sig"), "word", "n")


def gram_side(words: DataFrame, pieces: int = 4) -> DataFrame:
    """(sig, near, near_n): the grams a chunk-side word that is one code point shorter,
    as long or one longer would share."""
    lengths = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    rows = words.select("word", "n", lengths.alias("shift"))
    sigs = _signatures(F.col("word"), F.length("word") - F.col("shift"), F.col("shift"), pieces)
    return rows.select(F.explode(sigs).alias("sig"), F.col("word").alias("near"),
                       F.col("n").alias("near_n"))


def _dealt(words: DataFrame, name: str) -> DataFrame:
    """Stored in as many files as a shuffle has partitions: a word's row is small, but
    becomes dozens when it is signed."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(words.repartition(parts, "word"), name)


def near_words(words: DataFrame, large: int = LARGE) -> DataFrame:
    """(word, n, near, near_n) of all ordered pairs at edit distance one."""
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    left = right = words
    pieces, found = 4, None
    while True:
        chunks, grams = chunk_side(left, pieces), gram_side(right, pieces)
        # pieces of one code point: what meets here are near words, nearly all
        crowded = None if pieces > longest else stored(
            grams.groupBy("sig").agg(F.count(F.lit(1)).alias("held"))
            .filter(F.col("held") > large)
            .join(chunks.select("sig").distinct().hint("merge"), "sig")
            .select("sig"), "spelling-crowded")
        more = crowded is not None and not crowded.isEmpty()
        met = grams.join(crowded, "sig", "left_anti") if more else grams
        # a word's row became dozens, which the planner's estimate does not count: no broadcast
        met = chunks.hint("merge").join(met, "sig").filter(
            (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)) \
            .select("word", "n", "near", "near_n").distinct()
        found = met if found is None else found.union(met)
        if not more:
            return found if pieces == 4 else found.distinct()
        left = _dealt(chunks.join(crowded, "sig", "left_semi").select("word", "n").distinct(),
                      "spelling-left")
        right = _dealt(grams.join(crowded, "sig", "left_semi").select(
            F.col("near").alias("word"), F.col("near_n").alias("n")).distinct(), "spelling-right")
        pieces *= 4


def spelling_forms(words: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n; distinct)."""
    words = _dealt(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
        .alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    forms = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).cast("long").alias("form_n")), "spelling-forms")
    roots = follow(forms.filter("form is not null").select("word", "form"))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling: a round replaces every target by its target's
    target, until no target has one (at most log2 of the longest chain of forms)."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = stored(now, "spelling-roots")
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(further, "root", "left_semi").isEmpty():
            return now
        now = now.join(further, "root", "left") \
            .select("word", F.coalesce("next", "root").alias("root"))


def variant_groups(df: DataFrame, shortest: int = 5, least: int = 3, ratio: int = 2,
                   id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Forms and roots of the words of whole texts."""
    return spelling_forms(word_counts(df, shortest, least, id_col, text), ratio)
