"""Operators against brute force on the smallest tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL

BY = {k.split("_")[0]: q for k, q in E.queries().items() if k.startswith("op") and k[2].isdigit()}


def rows(spark, op):
    return {r["doc_id"]: r for r in BY[op](spark, SF_SMALL).collect()}


def test_lm_base_score(spark, documents):
    tok = lambda t: [*(t or "").encode().lower().split(), b""]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in documents}
    c = collections.Counter(w for d, r in documents.items() if not held[d] for w in tok(r["text"]))
    n, v = sum(c.values()), len(c)
    got = rows(spark, "op1")
    for d, r in documents.items():
        words = tok(r["text"])
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        g = got[d]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (
            held[d], len(words), sum(c[w] > 0 for w in words), n)
        assert g["base_score"] == pytest.approx(base, rel=1e-9)
    # the model beats the base on texts it has not seen
    assert sum(g["score"] for d, g in got.items() if held[d]) > sum(
        g["base_score"] for d, g in got.items() if held[d])


def test_lm_is_a_distribution(spark, documents):
    from tillsight.llm import lm_score as m
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    model, counts = m.fit(docs, rounds=2)
    words = {bytes(r["word"]): r["n"] for r in counts.collect()}
    context = np.array([m.START * m.SYMBOLS + m.START, 3 * m.SYMBOLS + 5])
    cls = np.exp(m._log_softmax(model.by_class, m._rows(context, 0, m.CLASS_ROWS)))
    assert cls.sum(1) == pytest.approx(1, abs=1e-4)
    tail = collections.defaultdict(float)
    for w, n in words.items():
        t = model.targets[w]
        if m.HEAD <= t < m.HEAD + m.TAILS:
            tail[t - m.HEAD] += (n + 0.5) / model.tail_mass[t - m.HEAD]
    for k in range(m.TAILS):  # known words and one slot for all others
        assert tail[k] + 0.5 / model.tail_mass[k] == pytest.approx(1)


def test_warc_records(spark, tmp_path):
    from tillsight.llm import warc
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    responses = warc.page_responses(pages)
    out = warc.derive(responses, "page_id")
    found = out.collect()
    blocks = {r["page_id"]: r for r in responses.collect()}
    assert len(found) == 2 * pages.count()
    for r in found:
        source = dict((x["k"], x["v"]) for x in blocks[r["page_id"]]["headers"])
        body = bytes(blocks[r["page_id"]]["block"]).split(b"\r\n\r\n", 1)[1]
        headers = {x["k"]: x["v"] for x in r["headers"]}
        assert headers["WARC-Refers-To"] == r["refers_to"] == source["WARC-Record-ID"]
        assert headers["WARC-Target-URI"] == source["WARC-Target-URI"]
        assert r["source_payload_digest"] == warc.digest(body) \
            == headers["WARC-Refers-To-Payload-Digest"]
        assert r["block_digest"] == warc.digest(r["block"].encode()) \
            == headers["WARC-Payload-Digest"]
        assert "<p>" not in r["block"] or r["record_type"] == "metadata"
    warc.write_warc(out, str(tmp_path / "w"))
    back = warc.read_warc(spark, f"{tmp_path}/w/*.txt").collect()
    text = lambda hs: {h["k"]: h["v"] for h in hs}["WARC-Record-ID"]
    assert {text(r["headers"]): bytes(r["block"]).decode() for r in back} == {
        text(r["headers"]): r["block"] for r in found}


def test_plain_text():
    from tillsight.llm.warc import plain_text
    assert plain_text("<title>A &amp; B</title><p>x <b>y</b><!-- c --><script>v='</p>'</script>z"
                      "<br>q<a href='a>b'>w</a>") == "A & B\nx yz\nqw"


def test_decontamination(spark, documents):
    from tillsight.llm.decontaminate import longest_common, tokens
    items = {r["item_id"]: tokens(r["text"].encode())
             for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    expected = set()
    for d, r in documents.items():
        words = tokens((r["text"] or "").encode())
        for i, q in items.items():
            if any(longest_common(q, words[k:k + len(q) + 4]) >= 0.8 * len(q)
                   for k in range(0, len(words), 2)):
                expected.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in BY["op3"](spark, SF_SMALL).collect()}
    assert len(expected & got) >= 0.9 * len(expected)
    assert got <= expected or len(got - expected) <= 1


def test_longest_common_subsequence():
    from tillsight.llm.decontaminate import longest_common
    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(0, 9))] for _ in "ab")
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(
                table[i, j + 1], table[i + 1, j])
        assert longest_common(a, b) == table[-1, -1]


def test_language_accuracy(spark, documents):
    got = rows(spark, "op4")
    held = [d for d, g in got.items() if g["held_out"]]
    assert held and all(0 <= got[d]["score"] <= 1 for d in got)
    assert sum(got[d]["lang_pred"] == documents[d]["lang"] for d in held) >= 0.95 * len(held)


def test_viterbi():
    from tillsight.llm.langid import viterbi
    rng = np.random.default_rng(2)
    lengths = np.array([3, 0, 5, 1])
    scores = rng.normal(size=(9, 3)).astype(np.float32)
    got = viterbi(scores, lengths, 0.7)
    value = lambda s, path: sum(s[i, p] for i, p in enumerate(path)) - 0.7 * sum(
        a != b for a, b in itertools.pairwise(path))
    at = 0
    for n in lengths:
        s = scores[at:at + n]
        best = max(value(s, p) for p in itertools.product(range(3), repeat=int(n)))
        assert value(s, got[at:at + n]) == pytest.approx(best, abs=1e-5)
        at += n


def test_mixed_language_spans(spark):
    from tillsight.llm import langid
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.fit(docs)
    some = {r["lang"]: r["text"] for r in docs.filter(F.length("text") > 600)
            .select("lang", "text").collect()}
    en, de = some["en"][:500], some["de"][:500]
    one = spark.createDataFrame([(1, f"{en} {de}")], "doc_id long, text string")
    spans = langid.label_languages(one, model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"]


def test_mix(spark, documents):
    got = rows(spark, "op5")
    size = {d: len((r["text"] or "").encode().split()) for d, r in documents.items()}
    total = collections.Counter()
    for d, r in documents.items():
        total[r["source"]] += size[d]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left, open_ = {}, sum(total.values()), list(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > 3 * total[s]]
        for s in full or open_:
            target[s] = 3.0 * total[s] if full else weight[s] * unit
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    taken = collections.Counter()
    for d, r in documents.items():
        g = got[d]
        assert (g["size"], g["source_size"]) == (size[d], total[r["source"]])
        assert g["target"] == pytest.approx(target[r["source"]])
        assert 0 <= g["taken"] <= 3 * size[d] and (not size[d] or g["taken"] % size[d] == 0)
        taken[r["source"]] += g["taken"]
    for s in order:
        largest = max(size[d] for d, r in documents.items() if r["source"] == s)
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], largest / 2)
    assert {d: g["taken"] for d, g in rows(spark, "op5").items()} == {
        d: g["taken"] for d, g in got.items()}


def test_min_cost_flow():
    from tillsight.llm.mixing import components, min_cost_flow, plan_mix
    patterns = [("a",), ("a", "b"), ("b",), ("c",)]
    assert sorted(map(sorted, components(patterns))) == [[0, 1, 2], [3]]
    flow = min_cost_flow([10, 10, 10], patterns[:3], {"a": 15, "b": 20})
    assert sum(w for (_, s), w in flow.items() if s == "a") == 15
    assert sum(w for (_, s), w in flow.items() if s == "b") == 20
    used = [sum(w for (i, _), w in flow.items() if i == k) for k in range(3)]
    # convex costs: all first copies before second ones
    assert all(10 <= u <= 20 for u in used) and sum(used) == 35
    targets, _ = plan_mix([("a",), ("b",)], [100, 1], {"a": 1.0, "b": 3.0}, 101)
    assert targets == {"a": 98.0, "b": 3.0}


def test_quality_statistics(spark, documents):
    word, got = re.compile(r"[^\x20\x09-\x0D]+"), rows(spark, "op6")
    for d, r in documents.items():
        text = r["text"] or ""
        words = word.findall(text)
        lines = [x for x in text.split("\n") if word.search(x)]
        at = collections.defaultdict(list)
        for i in range(len(words) - 7):
            at[tuple(words[i:i + 8])].append(i)
        covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        g = got[d]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"],
                g["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))
        assert g["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (g["base_failed"] and g["kept"])


def test_learned_rules(spark):
    from tillsight.llm import quality_rules as q
    stats = spark.range(4000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 400 + 20).alias("n_words"),
        (F.col("id") % 400 * 5 + 100).alias("word_chars"),
        F.when(F.col("id") % 5 == 0, F.col("id") % 400 + 20).otherwise(F.col("id") % 3)
        .alias("n_symbols"), F.lit(0).cast("long").alias("n_dup_lines"),
        F.lit(0).cast("long").alias("n_repeat_words"), F.lit(5).cast("long").alias("n_lines"),
        F.lit(3).cast("long").alias("n_upper"), F.lit(0).cast("long").alias("n_digits"),
        (F.col("id") % 5 == 0).alias("bad"))
    rules = q.learn_rules(stats, "bad")
    assert [[t.feature for t in r] for r in rules] == [["symbols_per_word"]]
    judged = stats.withColumns({f: e for f, e in q.rule_features().items() if f != "n_words"})
    wrong = judged.filter(q.keep_expression(rules) == F.col("bad")).count()
    assert wrong <= 80
    assert q.learn_rules(stats.filter("not bad"), "bad") == []


def test_substring_dedup(spark, documents):
    got, first = rows(spark, "op7"), {}
    for d in sorted(documents):
        words = (documents[d]["text"] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - 12):
            if first.setdefault(tuple(words[i:i + 13]), d) < d:
                gone[i:i + 13] = [True] * 13
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_sha256"]) == (
            len(words), sum(gone), hashlib.sha256(kept).hexdigest())


def test_hot_fingerprints(spark, monkeypatch):
    """A passage in every document, each with its own surroundings, cut into windows."""
    from tillsight.llm import substring_dedup as s
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(d, f"l{d} m{d % 7} {passage} r{d} s{d % 3}") for d in range(60)],
        "doc_id long, text string")
    expected = {r["doc_id"]: r["kept_text"] for r in s.drop_repeated_windows(docs).collect()}
    assert expected[0] == f"l0 m0 {passage} r0 s0" and expected[9] == "l9 r9 s0"
    monkeypatch.setattr(s, "SHARD_WORDS", 50)
    assert {r["doc_id"]: r["kept_text"] for r in s.drop_repeated_windows(docs).collect()} \
        == expected


def test_fm_index():
    from tillsight.llm.fm_index import FMIndex
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 3, n).astype(np.uint32) for n in rng.integers(3, 12, 80)]
    index = FMIndex(np.concatenate(sequences), np.array([len(s) for s in sequences]), 3)
    windows = [[tuple(s[i:i + 3]) for i in range(len(s) - 2)] for s in sequences]
    for pattern in itertools.product(range(4), repeat=3):
        assert index.count(np.array(pattern, np.uint32)) == sum(
            w == pattern for ws in windows for w in ws)
    ids = rng.permutation(80) + 100
    least = collections.defaultdict(lambda: 10**9)
    for i, ws in zip(ids, windows, strict=True):
        for w in ws:
            least[w] = min(least[w], i)
    got = {(r, o): m for r, o, m in zip(*index.matches(ids), strict=True)}
    assert got == {(r, o): least[w] for r, ws in enumerate(windows) for o, w in enumerate(ws)}


def test_shards(spark, documents):
    got = rows(spark, "op8")
    held = collections.defaultdict(list)
    for d, g in got.items():
        data = None if documents[d]["text"] is None else documents[d]["text"].encode()
        assert g["size"] == len(data or b"") + 1
        assert g["text_crc32"] == (None if data is None else zlib.crc32(data))
        held[g["shard"]].append(g["slot"])
    assert set(held) == set(range(16))
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    counts = [len(v) for v in held.values()]
    assert max(counts) - min(counts) <= 1
    # runs of the curve: indices do not fall from one shard to the next
    span = sorted((s, min(g["curve_index"] for g in got.values() if g["shard"] == s),
                   max(g["curve_index"] for g in got.values() if g["shard"] == s)) for s in held)
    assert all(a[2] <= b[1] for a, b in itertools.pairwise(span))


def test_hilbert_curve(spark):
    from tillsight.llm.sharding import hilbert_steps
    for bits, n in ((3, 2), (2, 3), (2, 4)):
        axes = [f"a{i}" for i in range(n)]
        cells = spark.range(1 << bits * n).select("id", *[
            F.shiftright(F.col("id"), bits * i).bitwiseAND((1 << bits) - 1).cast("int").alias(a)
            for i, a in enumerate(axes)])
        got = hilbert_steps(cells, axes, bits, "h").select("id", "h").collect()
        place = {r["h"]: [(r["id"] >> bits * i) & ((1 << bits) - 1) for i in range(n)] for r in got}
        assert sorted(place) == list(range(1 << bits * n))
        for k in range(len(place) - 1):  # neighbours on the curve are neighbours in space
            assert sum(abs(a - b) for a, b in zip(place[k], place[k + 1], strict=True)) == 1


def _sets(documents, n):
    out = {}
    for d, r in documents.items():
        w = (r["text"] or "").encode().lower().split()
        k = min(n, len(w))
        out[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    return out


def _components(sets):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}


def test_near_duplicates(spark, documents):
    got, sets = rows(spark, "op9"), _sets(documents, 2)
    for d, c in _components(sets).items():
        assert (got[d]["n_shingles"], got[d]["component_id"], got[d]["kept"]) == (
            len(sets[d]), c, d == c)


def test_links_off_the_hub(spark):
    """Variants of one text that are linked to each other, but not to the smallest id."""
    from tillsight.llm.near_dedup import near_duplicates
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for d in range(80):
        far = [f"x{d // 4}_{i}" if i % 9 == d // 4 % 9 else w for i, w in enumerate(base)]
        texts[d] = " ".join(f"y{d}" if rng.random() < 0.03 else w for w in far)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, shingle=2).collect()}
    sets = {d: set(zip(t.split(), t.split()[1:], strict=False)) for d, t in texts.items()}
    expected = _components(sets)
    assert len(set(expected.values())) > 2
    assert got == expected


def test_components(spark):
    from tillsight.llm.graph import connected_components
    edges = [(1, 2), (3, 2), (3, 9), (5, 6), (7, 7)] + [(20 + i, 21 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5} | {20 + i: 20 for i in range(41)}


def test_line_chunks(spark, documents):
    from tillsight.llm.line_dedup import chunks
    got, seen = rows(spark, "op10"), set()
    for d in sorted(documents):
        text = documents[d]["text"].encode()
        lines, drop = text.split(b"\n"), set()
        for start, n, body in chunks(text):
            if body in seen:
                drop.update(range(start, start + n))
            seen.add(body)
        kept = b"\n".join(x for i, x in enumerate(lines) if i not in drop)
        assert (got[d]["n_lines"], got[d]["n_removed"], got[d]["kept_sha256"]) == (
            len(lines), len(drop), hashlib.sha256(kept).hexdigest())


def test_chunk_boundaries_resist_shifts():
    from tillsight.llm.line_dedup import chunk_ends
    lines = [b"line %d" % i for i in range(300)]
    whole, moved = set(chunk_ends(lines)), {e - 2 for e in chunk_ends([b"new", b"two", *lines])}
    assert len(whole & moved) >= 0.8 * len(whole)


def test_rules_are_learnt_from_few_labels(spark):
    """The small test tables are enough for a rule that spares every good document."""
    from tests.conftest import SF_MID
    from tillsight.llm import quality_rules as q
    rows = {r["doc_id"]: r for r in q.judge_documents(
        spark.read.parquet(f"{SF_MID}/documents.parquet"),
        spark.read.parquet(f"{SF_MID}/labels.parquet")).collect()}
    labels = [r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
              if r["quality"] is not None and not rows[r["doc_id"]]["base_failed"]]
    bad = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    good = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1]
    assert len(bad) > 20 and sum(bad) < 0.2 * len(bad) and sum(good) > 0.98 * len(good)
