"""Spelling variants against a plain computation over all pairs of words."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DOCS, SF_SMALL
from tillsight.llm.spelling import near_words, spelling_forms, variant_groups, word_counts


def plain_counts(rows, shortest=5, least=3):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= shortest and n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def plain_forms(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def rows_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in df.collect()}


def test_whole_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counts = plain_counts([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["word"]: r["n"] for r in word_counts(docs).collect()} == counts
    want = plain_forms(counts)
    assert rows_of(variant_groups(docs)) == want
    assert sum(v[0] is not None for v in want.values()) > 10


@pytest.mark.parametrize("words", [
    # every place of an edit, at even and odd lengths, words that repeat a letter
    ["abcde", "bcde", "acde", "abcd", "xabcde", "abxcde", "abcdex", "xbcde", "abxde", "abcdx"],
    ["abcdef", "bcdef", "abdef", "abcde", "axbcdef", "abcxdef", "abcdefx", "abcdxf", "abcxef"],
    ["aaaaa", "aaaaaa", "aaaaaaa", "aaaab", "baaaa", "aabaa", "aaabaaa"],
    ["éàüöç", "éàüöc", "éàüç", "xéàüöç", "eàüöç"], ["x" * 3000, "x" * 2999, "x" * 1500 + "y" * 1500],
    ["ab", "a", "b", "abc", "bc", "ac", "c"]])
def test_every_single_edit_is_met(spark, words):
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {(r["word"], r["near"]) for r in near_words(df).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text(alphabet="abé", min_size=1, max_size=8),
                       st.integers(min_value=1, max_value=40), max_size=60))
def test_forms_and_roots(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling_forms(df)) == plain_forms(counts)


def test_a_long_chain_of_forms(spark):
    counts = {"a" * (5 + k): 2 ** k for k in range(20)}
    got = rows_of(spelling_forms(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert {v[1] for v in got.values()} == {"a" * 24}


@pytest.mark.parametrize("large", [0, 3, 100])
def test_crowded_signatures(spark, large):
    """Hundreds of words that share most of their letters: signed anew by shorter pieces."""
    words = [f"prefix{a}{b}{c}" for a in "abcdefgh" for b in "ijklmn" for c in "qrstu"]
    words += [w + "z" for w in words[:30]] + ["x" + w for w in words[:9]] + ["y" * 20, "y" * 21]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [(r["word"], r["near"]) for r in near_words(df, large).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_defined_cases(spark):
    text = "Vitae vitae VITAE vitaé vitaé vitaé x×y÷zzz x×y÷zzz x×y÷zzz"
    rows = [(1, text, *[None] * 8), (None, "vitae vitae vitae", *[None] * 8),
            (2, None, *[None] * 8), (3, "", *[None] * 8), (3, "", *[None] * 8)]
    counts = plain_counts([r[:2] for r in rows])
    assert rows_of(variant_groups(spark.createDataFrame(rows, DOCS))) == plain_forms(counts)
    assert "x×y÷zzz" in counts
