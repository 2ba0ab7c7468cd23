"""Planted cases: what the operators must find however many there are."""

import random

from pyspark.sql import functions as F

from tests.conftest import SF_MID


def test_large_benchmark(spark):
    """Verbatim and paraphrased copies of 2000 items, inside other text."""
    from tillsight.llm.decontaminate import contaminated
    rng = random.Random(4)
    texts = [r["text"].split() for r in spark.read.parquet(f"{SF_MID}/documents.parquet")
             .filter(F.length("text") > 600).orderBy("doc_id").select("text").collect()]
    other, source = texts[:len(texts) // 2], texts[len(texts) // 2:]

    def cut(t, n):
        a = rng.randrange(len(t) - n + 1)
        return t[a:a + n]

    items, docs, plants = [], [], {"verbatim": set(), "paraphrase": set()}
    for i in range(2000):
        item = cut(rng.choice(source), rng.randint(15, 40))
        items.append((i, " ".join(item)))
        if i % 4:
            continue
        kind = "paraphrase" if i % 8 else "verbatim"
        if kind == "paraphrase":
            n, around = len(item), rng.choice(other)
            kept = {*rng.sample(range(n - 4), max(0, int(n * rng.uniform(0.6, 0.8)) - 4)),
                    *range(n - 4, n)}
            item = [w if k in kept else rng.choice(around) for k, w in enumerate(item)]
        before, after = cut(rng.choice(other), 64), cut(rng.choice(other), 64)
        docs.append((i, " ".join(before[:rng.randint(0, 64)] + item + after)))
        plants[kind].add((i, i))
    docs += [(5000 + i, " ".join(t)) for i, t in enumerate(other)]
    schema = "{} long, text string"
    found = contaminated(spark.createDataFrame(docs, schema.format("doc_id")),
                         spark.createDataFrame(items, schema.format("item_id")))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    share = {k: len(p & got) / len(p) for k, p in plants.items()}
    assert min(share.values()) >= 0.9, share


def test_every_repeated_run_of_lines(spark):
    """All runs of two or more lines that stand before, against brute force."""
    from tillsight.llm.line_dedup import drop_repeated_chunks
    rng = random.Random(8)
    line = lambda: " ".join(rng.choices("abcdefghijklmnop", k=6))
    passages = [[line() for _ in range(n)] for n in (2, 2, 2, 3, 3, 4, 5, 10, 20)]
    docs = []
    for i in range(120):
        lines = [line() for _ in range(rng.randint(0, 6))] + rng.choice(passages)
        docs.append((i, "\n".join(lines + [line() for _ in range(rng.randint(0, 6))])))
    docs += [(200, "x y\nx y\nx y"), (201, "q\nx y\nx y"), (202, "q\n\n\nr\n\n")]
    first, expected = {}, {}
    for d, text in docs:
        lines, drop = text.split("\n"), set()
        for i, pair in enumerate(zip(lines, lines[1:], strict=False)):
            at = first.setdefault(pair, (d, i))
            if at < (d, i) and any(pair):
                drop |= {i, i + 1}
        expected[d] = "\n".join(x for i, x in enumerate(lines) if i not in drop)
    found = drop_repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r["doc_id"]: r["kept_text"] for r in found.collect()}
    assert got == expected
    assert sum(t != expected[d] for d, t in docs) > 100


def test_copies_of_a_hot_window_are_merged(spark, monkeypatch):
    """No index task gets equal windows of a passage with different surroundings."""
    from tillsight.llm import substring_dedup as m
    real = m.search_shard

    def strict(table):
        words = table["words"].to_pylist()
        assert len(set(words)) == len(words)
        return real(table)

    monkeypatch.setattr(m, "search_shard", strict)
    monkeypatch.setattr(m, "SHARD_WORDS", 100)
    shared = " ".join(f"w{i}" for i in range(40))
    docs = [(i, f"a{i} b{i} {shared} c{i} d{i}") for i in range(300)]
    found = m.drop_repeated_windows(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r["doc_id"]: r["kept_text"] for r in found.collect()}
    assert got == dict(docs[:1]) | {i: f"a{i} b{i} c{i} d{i}" for i in range(1, 300)}
