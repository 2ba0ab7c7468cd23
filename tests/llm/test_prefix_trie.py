"""The prefix trie against nested dictionaries, with blocks of any size."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF_SMALL
from tillsight.llm.prefix_trie import RangeMin, conversation_trie, regrafted, sequences, trie


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + ts[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)

    def leaves(p):
        return sum(map(leaves, kids[p])) if kids[p] else 1

    def saved(p):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        return own + sum(map(saved, kids[p]))
    return sorted((ms[0], len(p), members[p[:-1]][0] if p else None, len(ms), len(kids[p]), leaves(p),
                   saved(p), hashlib.sha256(",".join(
                       str(c) for c in ms if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, ms in members.items())


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_whole_conversations(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    want = plain_trie(plain_rebuilt([tuple(r) for r in turns.select(
        "conv_id", "turn", "role", "text").collect()]))
    assert rows_of(conversation_trie(turns)) == want
    assert any(r[3] > 1 and r[1] > 1 for r in want)


def table(spark, convs):
    return spark.createDataFrame([(c, [(hashlib.sha256(repr(t).encode()).hexdigest()[:32],
                                        len(t[1].encode())) for t in ts])
                                  for c, ts in convs.items()],
                                 "conv_id long, turns array<struct<digest:string,bytes:long>>")


def tree(seed, n):
    """Conversations that share long beginnings, with many copies and some without turns."""
    rnd = random.Random(seed)
    made = [[]]
    for _ in range(n):
        start = rnd.choice(made)[:rnd.randint(0, 9)]
        made.append(start + [("u", rnd.choice("ab") * rnd.randint(0, 3))
                             for _ in range(rnd.choice([0, 0, 1, 2, 5]))])
    ids = rnd.sample(range(-50, 5 * n), n)
    return dict(zip(ids, made[1:]))


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 16_384])
@pytest.mark.parametrize("seed", [1, 2])
def test_extents_over_blocks(spark, rows, seed):
    """Nodes and runs of copies that span one, some or all blocks."""
    convs = tree(seed, 60)
    assert rows_of(trie(table(spark, convs), rows)) == plain_trie(convs)


def test_all_copies(spark):
    convs = {c: [("u", "x"), ("a", "yy")] for c in range(40)}
    convs |= {c: [("u", "x")] for c in range(100, 120)}
    for rows in (1, 4, 16_384):
        assert rows_of(trie(table(spark, convs), rows)) == plain_trie(convs)
    turnless = {c: [] for c in range(9)}
    assert rows_of(trie(table(spark, turnless), 2)) == plain_trie(turnless)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(-20, 60), st.lists(st.sampled_from(
    [("u", ""), ("u", "a"), ("a", "é")]), max_size=6), max_size=25), st.integers(1, 5))
def test_any_conversations(spark, convs, rows):
    assert rows_of(trie(table(spark, convs), rows)) == plain_trie(convs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1, 4), min_size=1, max_size=40), st.data())
def test_range_minima(values, data):
    table, n = RangeMin(np.array(values)), len(values)
    i = data.draw(st.integers(0, n - 1))
    d = data.draw(st.integers(-2, 5))
    at, depth = np.array([i]), np.array([d])
    below = [k for k in range(n) if values[k] < d]
    assert table.right(at, depth)[0] == min([k for k in below if k >= i], default=n)
    assert table.left(at, depth)[0] == max([k for k in below if k <= i], default=-1)
    z = data.draw(st.integers(i, n))
    assert table.least(at, np.array([z]))[0] == min(values[i:z], default=np.iinfo(np.int64).max)


def test_defined_cases(spark):
    rows = [(0, 0, "u", "hi"), (0, None, None, None), (0, 0, "u", "hi"), (3, 1, "u", None),
            (3, 0, None, ""), (None, 0, "u", "lost"), (7, 5, "u", "hi"), (-3, 0, "u", "x"), (-3, 1, "", "y")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, "
                               "role string, text string, n long, at string")
    assert rows_of(conversation_trie(df)) == plain_trie(plain_rebuilt(rows))
    got = {r["conv_id"]: len(r["turns"]) for r in regrafted(sequences(df)).collect()}
    assert got == {c: len(ts) for c, ts in plain_rebuilt(rows).items()}
    assert conversation_trie(df.filter("false")).collect() == []
