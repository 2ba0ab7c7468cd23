"""SimHash groups against a plain computation of every pair."""

import random

import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DOCS, SF_SMALL
from tillsight.llm.simhash import ball, links, segments, simhash_groups


def plain_fingerprint(text, n=4):
    words = (text or "").translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))}))
    for c in "\t\n\x0b\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    n = min(n, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i:i + n]).encode(), 42).intdigest()
              for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, near):
    """Smallest node reachable, by repeated relaxation over all pairs."""
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def test_whole_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    want = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = {r["doc_id"]: r for r in simhash_groups(docs).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert {k: int(r["fingerprint"], 16) for k, r in got.items()} == prints
    assert all(len(r["fingerprint"]) == 16 for r in got.values())
    assert len(set(want.values())) < len(want)


def test_every_ball_of_a_segment():
    assert len(ball(64, 2)) == 1 + 64 + 64 * 63 // 2 and len(set(ball(64, 2))) == 2081
    for count in (10, 2 ** 34):
        for distance in range(1, 7):
            layout = segments(count, distance)
            at = [b for shift, width, _ in layout for b in range(shift, shift + width)]
            assert len(at) == len(set(at))
            # a pair no segment catches differs in more than the distance
            assert sum(radius + 1 for _, _, radius in layout) > distance
    assert len(segments(10, 4)) == 3 and len(segments(2 ** 34, 4)) == 2


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance,large", [(4, 256), (4, 1), (3, 1), (3, 2), (2, 1), (1, 256),
                                            (5, 256)])
def test_links_of_crowded_entries(spark, distance, large):
    """A cloud around one value and chains at the very distance: direct comparison, midpoints
    and a mixture of both find the same components."""
    rnd = random.Random(distance)
    base = rnd.getrandbits(64)
    cloud = [base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 7)))
             for _ in range(150)]
    chain = [rnd.getrandbits(64)]
    for _ in range(40):
        chain.append(chain[-1] ^ sum(1 << b for b in rnd.sample(
            range(64), rnd.choice([distance, distance, distance + 1]))))
    nodes = sorted(set(map(signed, cloud + chain + [rnd.getrandbits(64) for _ in range(60)])))
    want = components(nodes, lambda a, b: ((a ^ b) & (2 ** 64 - 1)).bit_count() <= distance)
    df = spark.createDataFrame([(x,) for x in nodes], "fp long")
    from tillsight.llm.graph import connected_components
    got = {r["node"]: r["component"] for r in connected_components(
        links(df, len(nodes), distance, large)).collect()}
    assert {x: got.get(x, x) for x in nodes} == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aB é\n", max_size=12), max_size=12))
def test_short_texts(spark, texts):
    rows = [(i, t, None, None, 0, 0, 0, 0, "k", 0) for i, t in enumerate(texts)]
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    want = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = simhash_groups(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c d e"), (3, "q r s t"), (None, "A b C d e"), (None, "z"),
            (7, "q r s t")]
    got = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    by = sorted((str(r["doc_id"]), str(r["component_id"])) for r in got)
    # rows of one id follow their texts; a null id lends its links but names nothing
    assert by == [("1", "1"), ("2", "1"), ("3", "3"), ("3", "3"), ("7", "3"), ("None", "3"),
                  ("None", "None")]
    assert {r["fingerprint"] for r in got if r["doc_id"] in (1, 2)} == {"0" * 16}
